"""corvid: batch analytics operators written as Spark DataFrame plans.

Three families, each a set of functions that take DataFrames and return
DataFrames (no session creation, no ``collect`` inside an operator):

* ``corvid.operators.words``    word counting over document lines
* ``corvid.operators.sales``    product popularity over transactions
* ``corvid.operators.geometry`` distance, ball and objective operators
* ``corvid.operators.kcenter``  k-center with outliers via per-partition
  coresets and a bounded weighted solve

``corvid.sources`` adapts files and the driver's parquet tables to the
row shapes these operators expect.
"""

import sys as _sys

# Functions that run inside Python workers (the k-center kernels) are shipped
# by value, so executors need neither this package installed nor it on
# their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass

__all__ = ["functions", "operators", "plans", "sources"]
