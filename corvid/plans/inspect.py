"""Plan inspection: the physical plan as text, and checks used by tests."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

EXCHANGE_KINDS = (
    "Exchange hashpartitioning",
    "Exchange rangepartitioning",
    "Exchange SinglePartition",
    "Exchange RoundRobinPartitioning",
)
PYTHON_OPERATORS = (
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInArrow",
    "FlatMapGroupsInPandas",
    "MapInArrow",
    "MapInPandas",
)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the (initial) physical plan."""
    lines = plan_text(df, "simple").splitlines()
    return sum(1 for line in lines if any(kind in line for kind in EXCHANGE_KINDS))


def has_partial_aggregate(df: DataFrame) -> bool:
    """True if a map-side (partial) aggregate feeds an exchange."""
    text = plan_text(df, "simple")
    return "partial_" in text and "Exchange" in text


def uses_python_udf(df: DataFrame) -> bool:
    """True if any operator of the plan runs Python."""
    text = plan_text(df, "simple")
    return any(op in text for op in PYTHON_OPERATORS)
