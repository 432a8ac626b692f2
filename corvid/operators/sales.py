"""Product popularity over transactions.

Input: ``transactions`` with at least ``product: string, quantity,
customer, country``. Popularity of a product is the number of distinct
customers who bought it (quantity above a threshold, optionally in one
country).

Plan shape of ``popularity_reduced`` (checked with ``explain``): partial
aggregate on ``(product, customer)``, exchange on that pair, merge, partial
count, exchange on ``product``, final count. A product that holds a third of
all rows is spread over reducers by its customers in the first exchange and
reaches the second one as one partial count per task, so no reducer ever
sees the hot product's raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL_COUNTRIES = "all"


def sales_filtered(
    transactions: DataFrame, country: str = ALL_COUNTRIES, min_quantity: float = 0
) -> DataFrame:
    """Rows with ``quantity > min_quantity`` in ``country`` (or all).

    The country term is left out entirely for ``all`` (no constant-true
    predicate in the plan). ``customer`` is parsed to a long only after the
    filter, so a bad value on a dropped row does no harm.
    """
    cond = F.col("quantity") > F.lit(min_quantity)
    if country != ALL_COUNTRIES:
        cond = cond & (F.col("country") == F.lit(country))
    kept = transactions.where(cond)
    customer = F.col("customer").cast("long")
    return kept.select(
        "product",
        F.when(
            F.assert_true(customer.isNotNull(), "transaction without customer").isNull(), customer
        ).alias("customer"),
        "quantity",
        "country",
    )


def product_customer(filtered: DataFrame) -> DataFrame:
    """R2: distinct ``(product, customer)`` pairs."""
    return filtered.select("product", "customer").distinct()


def product_customer_count(filtered: DataFrame) -> DataFrame:
    """Number of distinct pairs -> one row ``pairs``."""
    return product_customer(filtered).agg(F.count(F.lit(1)).alias("pairs"))


def popularity_grouped(filtered: DataFrame) -> DataFrame:
    """Pairs grouped by product, ones summed -> ``product, popularity``."""
    pairs = product_customer(filtered)
    return pairs.groupBy("product").agg(F.sum(F.lit(1)).cast("long").alias("popularity"))


def popularity_reduced(filtered: DataFrame) -> DataFrame:
    """The same result as one distinct-count aggregation."""
    return filtered.groupBy("product").agg(F.count_distinct("customer").alias("popularity"))


def top_products(popularity: DataFrame, H: int) -> DataFrame:
    """The ``H`` most popular products; ties by product descending.

    ``orderBy(...).limit(H)`` plans as ``TakeOrderedAndProject``: each task
    keeps an ``H``-row heap, so only ``H`` rows per task reach the merge.
    ``H = 0`` gives the full listing (R7), as the original does.
    """
    if H < 0:
        raise ValueError("H must be >= 0")
    if H == 0:
        return products_listing(popularity)
    return popularity.orderBy(F.desc("popularity"), F.desc("product")).limit(H)


def products_listing(popularity: DataFrame) -> DataFrame:
    """Every product with its popularity, by product ascending."""
    return popularity.orderBy(F.asc("product"))


def top_products_by_country(
    transactions: DataFrame, country: str, H: int, min_quantity: float = 0
) -> DataFrame:
    """Filter -> distinct pairs -> popularity -> top ``H``."""
    return top_products(popularity_reduced(sales_filtered(transactions, country, min_quantity)), H)
