"""Sources: file readers and adapters over the driver's parquet tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.sources.files import read_lines, read_points, read_transactions
from corvid.sources.points import checked_points, with_unit_weight
from corvid.sources.tables import (
    document_lines,
    embedding_points,
    lineitem_points,
    table,
    transactions,
)


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows as a one-row DataFrame ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


__all__ = [
    "checked_points",
    "document_lines",
    "embedding_points",
    "lineitem_points",
    "read_lines",
    "read_points",
    "read_transactions",
    "row_count",
    "table",
    "transactions",
    "with_unit_weight",
]
