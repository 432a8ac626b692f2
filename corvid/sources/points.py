"""Point-set shape shared by the geometry and k-center operators.

A point set is a DataFrame ``point_id: long, v: array<double>`` with an
optional ``w: long`` weight. ``point_id`` is unique and orders the points
(ties of the original list order are broken by it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checked_points(points: DataFrame, dim: int | None = None) -> DataFrame:
    """Reject null/NaN coordinates and points of another dimension.

    The checks are lazy ``assert_true`` projections: they cost one pass that
    the consumer makes anyway and fail the job on the first bad row. Without
    ``dim`` every row is held to the size of one row read by a ``limit(1)``
    scalar subquery.
    """
    ok = (F.col("v").isNotNull()) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x))
    if dim is None:
        expected = points.select(F.size("v")).limit(1).scalar()
    else:
        expected = F.lit(dim)
    ok = ok & (F.size("v") == expected)
    return points.select(
        "point_id",
        F.when(F.assert_true(ok, "point with a null/NaN coordinate or another dimension").isNull(), F.col("v")).alias("v"),
        *[c for c in points.columns if c not in ("point_id", "v")],
    )


def with_unit_weight(points: DataFrame) -> DataFrame:
    """Add ``w = 1`` unless the point set already carries weights."""
    if "w" in points.columns:
        return points
    return points.withColumn("w", F.lit(1).cast("long"))
