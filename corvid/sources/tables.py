"""Adapters from the driver's parquet tables to the operators' row shapes.

Each adapter selects only the columns it needs, so the parquet scans read
just those (``ReadSchema`` in the plan), and leaves filters to the caller so
that Catalyst pushes them into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.text import text_lines
from corvid.sources.points import checked_points

# The table names the driver generates.
TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dealt(df: DataFrame, partitions: int | None, key: str) -> DataFrame:
    """``df`` dealt over that many partitions, where the caller asks for it (a
    table stored as one row group scans in one task). Rows do not change."""
    return df.repartition(partitions, key) if partitions else df


def document_lines(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """S1 over ``documents``: each text body is a small text file.

    -> ``doc_id: long, line_no: int, line: string``. A narrow projection:
    no shuffle, one output row per line.
    """
    docs = _dealt(table(spark, sf_dir, "documents").select("doc_id", "text"), partitions, "doc_id")
    return docs.select("doc_id", F.posexplode(text_lines(F.col("text"))).alias("line_no", "line"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 over the order tables: one transaction per line item whose order,
    customer and nation are all there.

    -> ``transaction_id, product, quantity, customer, country``.

    The joins are written from the dimension side outwards
    (nation -> customer -> orders -> lineitem) so a country filter placed on
    top reaches the nation scan and shrinks every later join; Spark picks
    broadcast for sides its size statistics prove small and sort-merge joins
    (with AQE skew splitting) otherwise. ``product`` is text so that ties
    order as text.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    buyers = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", F.col("n_name").alias("country")
    )
    sales_orders = orders.join(buyers, orders.o_custkey == buyers.c_custkey).select(
        "o_orderkey", F.col("o_custkey").alias("customer"), "country"
    )
    return lineitem.join(sales_orders, lineitem.l_orderkey == sales_orders.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("l_partkey").cast("string").alias("product"),
        F.col("l_quantity").alias("quantity"),
        "customer",
        "country",
    )


def embedding_points(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Points from ``embeddings``: ``point_id = vec_id``, ``v`` as doubles."""
    emb = _dealt(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), partitions, "vec_id")
    return checked_points(
        emb.select(F.col("vec_id").alias("point_id"), F.col("embedding").cast("array<double>").alias("v"))
    )


def lineitem_points(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """4-d points from ``lineitem`` (quantity, price, discount, tax).

    The id is the row's key, ``l_orderkey * 8 + l_linenumber``. The generated
    data repeats some keys; wherever order matters, such rows are ordered by
    their coordinates.
    """
    coords = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = _dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *coords), partitions, "l_orderkey")
    return checked_points(
        li.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("point_id"),
            F.array(*[F.col(c).cast("double") for c in coords]).alias("v"),
        ),
        dim=len(coords),
    )
