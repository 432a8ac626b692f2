"""Shuffle budget of each operator, read from the physical plan.

The counts are the operators' own.
"""

import pytest

import __spark_entry__ as se
from conftest import SF_SMALL, fixture
from corvid.operators import geometry as geo
from corvid.operators import sales, words
from corvid.plans.inspect import count_exchanges, plan_text, uses_python_udf
from corvid.session import cut_lineage
from corvid.sources import read_lines, read_points, read_transactions


@pytest.fixture(scope="module")
def lines(spark):
    return cut_lineage(read_lines(spark, fixture("brooks.txt")))


@pytest.fixture(scope="module")
def tx(spark):
    return sales.sales_filtered(read_transactions(spark, fixture("sales.csv")), "all")


@pytest.mark.parametrize(
    "op,expected",
    [
        (words.tokens, 0),
        (words.doc_term_counts, 0),
        (words.word_count, 1),
        (words.word_count_partition, 1),
        (lambda l: words.word_count_salted(l, 4), 2),
        (lambda l: words.word_count_rand_group(l, 4), 2),
        (words.distinct_words, 2),
        (words.avg_word_length, 2),
    ],
)
def test_word_shuffles(lines, op, expected):
    assert count_exchanges(op(lines)) == expected


@pytest.mark.parametrize(
    "op,expected",
    [
        (sales.product_customer, 1),
        (sales.popularity_reduced, 2),
        (sales.popularity_grouped, 2),
        (lambda t: sales.top_products(sales.popularity_reduced(t), 3), 2),
    ],
)
def test_sales_shuffles(tx, op, expected):
    assert count_exchanges(op(tx)) == expected


def test_distance_operators_do_not_shuffle_points(spark):
    from pyspark.sql import functions as F

    pts = cut_lineage(read_points(spark, fixture("scatter.csv")))
    cs = pts.limit(4).select(F.col("point_id").alias("id"), "v")
    for df in (
        geo.point_distances(pts, cs),
        geo.uncovered_after(pts, cs, 0.01),
        geo.nearest_center_distance(pts, cs),
        geo.nearest_distance(pts, cs),
    ):
        # The exchange of the bounded center subquery, which its uses share.
        assert "Exchange" not in plan_text(df, "simple").split("Subquery")[0]
        assert not uses_python_udf(df)


@pytest.mark.parametrize(
    "name", [n for n in se.queries() if n in se.oracle_sql() and n in (
        "doc_lines", "tokens", "doc_term_counts", "word_count", "word_count_salted",
        "word_count_rand_group", "word_count_partition", "distinct_words", "avg_word_length",
        "transactions", "sales_filtered", "product_customer", "product_customer_count",
        "popularity_grouped", "popularity_reduced", "top_products", "products_listing",
        "top_products_by_country", "points")]
)
def test_no_python_outside_kcenter_kernels(spark, name):
    assert not uses_python_udf(se.queries()[name](spark, SF_SMALL))
