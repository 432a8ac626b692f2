"""File sources: text lines, comma-separated transactions, comma-separated points.

Every reader declares its schema up front (no inference) and fails fast on a
malformed row, as the original programs do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.sources.points import checked_points

# The eight comma-separated fields of a transaction line, in
# file order.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_ts", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        # Kept as text here: it is only parsed for rows that pass the filter.
        T.StructField("customer", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their number -> ``line_id, value``.

    Lines count from 0 through the files in path order, whatever the splits
    and the cores: each block of a file counts its lines, and the counts of
    the blocks before it (one row per block) are its offset. That is a second
    pass over the files that reads no more than line ends.
    """
    block = ["__path", "__start"]
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__row"),
        "value",
    )
    counts = raw.groupBy(*block).agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*block, (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    return raw.join(offsets, block).select((F.col("__row") + F.col("__shift")).alias("line_id"), "value")


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """S1 for files: one document per line -> ``doc_id, line_no, line``.

    ``doc_id`` is the line's number (``numbered_lines``). ``partitions``
    deals the documents over that many partitions by ``doc_id`` (the
    original's ``repartition(K)``, made deterministic).
    """
    df = numbered_lines(spark, path).select(
        F.col("line_id").alias("doc_id"), F.lit(0).alias("line_no"), F.col("value").alias("line")
    )
    return df.repartition(partitions, "doc_id") if partitions else df


def read_transactions(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Comma file -> transactions, no quoting, fail on a bad row.

    Short lines and unparsable numbers fail (``FAILFAST``). The CSV reader
    turns empty fields into NULL, so the rules of the original line parser
    are restated: an empty quantity or a missing country fails the job
    (both are read on every row), and an empty product is the empty string.
    ``partitions`` spreads the rows by ``transaction_id`` (the original's
    ``repartition(K)``, made deterministic).
    """
    raw = (
        spark.read.schema(TRANSACTION_SCHEMA)
        .option("quote", "")
        .option("escape", "")
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    ok = F.col("quantity").isNotNull() & F.col("country").isNotNull()
    guard = F.assert_true(ok, "transaction with an empty quantity or no country field").isNull()
    df = raw.select(
        "transaction_id",
        F.coalesce(F.col("product"), F.lit("")).alias("product"),
        "description",
        F.when(guard, F.col("quantity")).alias("quantity"),
        "invoice_ts",
        "unit_price",
        "customer",
        F.when(guard, F.col("country")).alias("country"),
    )
    return df.repartition(partitions, "transaction_id") if partitions else df


def read_points(
    spark: SparkSession, path: str, dim: int | None = None, partitions: int | None = None
) -> DataFrame:
    """S3: comma file of coordinates -> ``point_id, v: array<double>``.

    Any number of coordinates per line, the same on every line (``dim``, if
    given, is enforced). NaN or unparsable coordinates fail the job.
    ``point_id`` is the line's number (``numbered_lines``), so parts do not
    depend on file splits. ``partitions`` deals the points by ``point_id``.
    """
    # Trailing empty fields are dropped, as a plain comma split does; an
    # empty field anywhere else fails the job (the ANSI cast rejects it).
    fields = F.split(F.regexp_replace("value", r",+\z", ""), ",")
    raw = numbered_lines(spark, path).select(
        F.col("line_id").alias("point_id"),
        F.transform(fields, lambda s: F.trim(s).cast("double")).alias("v"),
    )
    pts = checked_points(raw, dim)
    return pts.repartition(partitions, "point_id") if partitions else pts
