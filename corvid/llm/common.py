"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import sys
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(col, F.lit("")), UPPER, UPPER.lower())


def staged(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet (by the session's codec or another) into the
    shared folder and read it back: cuts the lineage, and a lost executor costs
    no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``staged`` that no later step reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def parts_for(total: float, per_part: float) -> int:
    """How many parts of about ``per_part`` units hold ``total`` units."""
    return max(1, math.ceil(total / per_part))


BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000  # texts that go to Python in one Arrow batch


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``BATCH_ROWS`` rows for the jobs that run inside;
    a task and its Python worker each hold a batch or two outside the heap. A
    smaller setting stays, and the session's own one is set again."""
    before = spark.conf.get(BATCH_CONF, None)
    if before is None or not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
        else:
            spark.conf.set(BATCH_CONF, before)


def text_total(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(rows, characters) of all texts: one aggregate over the table."""
    row = docs.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("b")
    ).first()
    return row["n"], row["b"]


def once_a_process(key: Any, make: Callable[[], Any]) -> Any:
    """``make()``, kept as long as the Python worker lives or until another key
    is asked for: a worker that goes on to the next stage holds no vocabulary or
    table of the last. Tasks get this package's functions by value, each with
    globals of its own, so what tasks share is kept in a module made for it."""
    kept = sys.modules.setdefault("_corvid_kept", types.ModuleType("_corvid_kept")).__dict__
    if key not in kept:
        kept.clear()
        pa.default_memory_pool().release_unused()
        kept[key] = make()
    return kept[key]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices: Python objects of some rows at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
