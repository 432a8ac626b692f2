"""Registered queries: one per operator, each over the driver's tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE_SQL[name]``
(where present) is DuckDB SQL for the same rows. Parameters are fixed here so
that the Spark side and the oracle agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators import geometry, kcenter, sales, words
from corvid.plans import oracle_sql
from corvid.sources import document_lines, embedding_points, lineitem_points, row_count, transactions

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
SALT_K = 16
RAND_SEED = 42
TOP_H = 10
COUNTRY = "NATION_7"
MIN_QUANTITY = 10.0
# Geometry: centers are the farthest-first centers of the embeddings
# (FFT_M per part of about EMB_PART_ROWS points); balls use BALL_RADIUS; the objective drops
# OUTLIERS_Z points; K2 looks at the first KZ_K + KZ_Z + 1 points.
FFT_M = 4
EMB_PART_ROWS = 125
BALL_RADIUS = 1.3
OUTLIERS_Z = 10
# k-center job on the embeddings.
KZ_K = 8
KZ_Z = 10
KZ_ALPHA = 2
GREEDY_RADIUS = 0.1
# k-center job on lineitem: several guesses and centers. Parts of about
# LI_PART_ROWS points, so their number follows the table.
LI_K = 10
LI_Z = 50
LI_ALPHA = 0
LI_PART_ROWS = 4000


def _words() -> dict[str, Query]:
    def lines(spark, d):
        return document_lines(spark, d)

    return {
        "doc_lines": lines,
        "row_count": lambda s, d: row_count(lines(s, d)),
        "tokens": lambda s, d: words.tokens(lines(s, d)),
        "doc_term_counts": lambda s, d: words.doc_term_counts(lines(s, d)),
        "word_count": lambda s, d: words.word_count(lines(s, d)),
        "word_count_salted": lambda s, d: words.word_count_salted(lines(s, d), SALT_K),
        "word_count_rand_group": lambda s, d: words.word_count_rand_group(
            lines(s, d), SALT_K, RAND_SEED
        ),
        "word_count_partition": lambda s, d: words.word_count_partition(lines(s, d)),
        "distinct_words": lambda s, d: words.distinct_words(lines(s, d)),
        "avg_word_length": lambda s, d: words.avg_word_length(lines(s, d)),
    }


def _sales() -> dict[str, Query]:
    def every(spark, d):
        return sales.sales_filtered(transactions(spark, d), "all", MIN_QUANTITY)

    return {
        "transactions": lambda s, d: transactions(s, d),
        "sales_filtered": lambda s, d: sales.sales_filtered(transactions(s, d), COUNTRY, MIN_QUANTITY),
        "product_customer": lambda s, d: sales.product_customer(every(s, d)),
        "product_customer_count": lambda s, d: sales.product_customer_count(every(s, d)),
        "popularity_grouped": lambda s, d: sales.popularity_grouped(every(s, d)),
        "popularity_reduced": lambda s, d: sales.popularity_reduced(every(s, d)),
        "top_products": lambda s, d: sales.top_products(sales.popularity_reduced(every(s, d)), TOP_H),
        "products_listing": lambda s, d: sales.products_listing(sales.popularity_grouped(every(s, d))),
        "top_products_by_country": lambda s, d: sales.top_products_by_country(
            transactions(s, d), COUNTRY, TOP_H, MIN_QUANTITY
        ),
    }


def _geometry() -> dict[str, Query]:
    def pts(spark, d):
        return embedding_points(spark, d)

    def centers(spark, d):
        fft = kcenter.fft_centers(pts(spark, d), FFT_M, None, EMB_PART_ROWS)
        return fft.select(F.col("point_id").alias("id"), "v")

    def dists(spark, d):
        return geometry.nearest_center_distance(pts(spark, d), centers(spark, d), None)

    def ball(op):
        return lambda s, d: op(pts(s, d), centers(s, d), BALL_RADIUS)

    return {
        "points": pts,
        "fft_centers": lambda s, d: kcenter.fft_centers(pts(s, d), FFT_M, None, EMB_PART_ROWS).select(
            "part", "c", "point_id"
        ),
        "center_weights": lambda s, d: kcenter.center_weights(
            pts(s, d), kcenter.fft_centers(pts(s, d), FFT_M, None, EMB_PART_ROWS), None, FFT_M
        ),
        "coreset": lambda s, d: kcenter.coreset(pts(s, d), FFT_M, None, 1, EMB_PART_ROWS).select(
            "part", "c", "ord", "point_id", "w"
        ),
        "point_distances": lambda s, d: geometry.point_distances(pts(s, d), centers(s, d), None),
        "initial_radius": lambda s, d: geometry.initial_radius(pts(s, d), KZ_K + KZ_Z + 1),
        "ball_members": ball(geometry.ball_members),
        "ball_weights": ball(geometry.ball_weights),
        "heaviest_ball": ball(geometry.heaviest_ball),
        "uncovered_after": lambda s, d: geometry.uncovered_after(
            pts(s, d), centers(s, d), BALL_RADIUS
        ).select("point_id"),
        "nearest_center_distance": dists,
        "farthest_points": lambda s, d: geometry.farthest_points(
            geometry.nearest_distance(pts(s, d), centers(s, d), None), OUTLIERS_Z
        ),
        "objective": lambda s, d: geometry.objective(
            geometry.nearest_distance(pts(s, d), centers(s, d), None), OUTLIERS_Z
        ),
    }


def _kcenter() -> dict[str, Query]:
    def pts(spark, d):
        return embedding_points(spark, d)

    def core(spark, d):
        return kcenter.coreset(pts(spark, d), KZ_K + KZ_Z + 1, None, 1, EMB_PART_ROWS)

    def lineitem(op):
        return lambda s, d: op(lineitem_points(s, d), LI_K, LI_Z, None, LI_ALPHA, 1, LI_PART_ROWS)

    return {
        "greedy_cover": lambda s, d: kcenter.solution_rows(
            kcenter.greedy_cover(core(s, d), KZ_K, GREEDY_RADIUS, KZ_ALPHA, KZ_Z)
        ),
        "weighted_kcenter": lambda s, d: kcenter.solution_rows(
            kcenter.weighted_kcenter(core(s, d), KZ_K, KZ_Z, 0)
        ),
        "guess_trace": lambda s, d: kcenter.guess_trace(
            kcenter.kcenter_outliers(pts(s, d), KZ_K, KZ_Z, None, KZ_ALPHA, 1, EMB_PART_ROWS)
        ),
        "kcenter_outliers": lambda s, d: kcenter.solution_centers(
            kcenter.kcenter_outliers(pts(s, d), KZ_K, KZ_Z, None, KZ_ALPHA, 1, EMB_PART_ROWS)
        ).select("center_no", "point_id"),
        "coreset_lineitem": lambda s, d: kcenter.coreset(
            lineitem_points(s, d), LI_K + LI_Z + 1, None, 1, LI_PART_ROWS
        ).select("part", "c", "ord", "point_id", "v", "w"),
        "fft_centers_lineitem": lambda s, d: kcenter.fft_centers(
            lineitem_points(s, d), LI_K + LI_Z + 1, None, LI_PART_ROWS
        ).select("part", "c", "point_id", "v"),
        "center_weights_lineitem": lambda s, d: kcenter.center_weights(
            lineitem_points(s, d), kcenter.fft_centers(lineitem_points(s, d), LI_K + LI_Z + 1, None, LI_PART_ROWS)
        ),
        "guess_trace_lineitem": lambda s, d: kcenter.guess_trace(lineitem(kcenter.kcenter_outliers)(s, d)),
        "kcenter_outliers_lineitem": lambda s, d: kcenter.solution_centers(lineitem(kcenter.kcenter_outliers)(s, d)),
        "kcenter_report_lineitem": lineitem(kcenter.kcenter_report),
        "kcenter_report": lambda s, d: kcenter.kcenter_report(pts(s, d), KZ_K, KZ_Z, None, KZ_ALPHA, 1, EMB_PART_ROWS),
    }


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(_words())
    out.update(_sales())
    out.update(_geometry())
    out.update(_kcenter())
    return out


def oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(oracle_sql.words_sql())
    out.update(oracle_sql.sales_sql(COUNTRY, TOP_H, MIN_QUANTITY))
    out.update(oracle_sql.geometry_sql(FFT_M, EMB_PART_ROWS, KZ_K + KZ_Z + 1, BALL_RADIUS, OUTLIERS_Z))
    out.update(oracle_sql.kcenter_sql(KZ_K, KZ_Z, oracle_sql.parts_sql(KZ_K + KZ_Z + 1, EMB_PART_ROWS), KZ_ALPHA, GREEDY_RADIUS))
    out.update(oracle_sql.lineitem_sql(LI_K, LI_Z, LI_ALPHA, LI_PART_ROWS))
    return out
