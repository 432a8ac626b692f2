"""Word counting over document lines (one document = one line).

Input: ``lines`` with ``doc_id, line_no, line``. Every operator returns a
DataFrame; the counting ones return ``word: string, cnt: long``.

All four word-count plans give the same rows. In Spark they differ only in
how many shuffles they take:

* ``word_count`` / ``word_count_partition``: explode, partial aggregate in
  each task (the per-partition combine), one exchange on ``word``, final
  aggregate. A hot word costs one row per task before the shuffle.
* ``word_count_salted`` / ``word_count_rand_group``: a first aggregation on
  ``(salt, word)`` with the salt in ``[0, K)`` spreads a word over K reducers,
  then a second, tiny aggregation on ``word``.

``doc_term_counts`` needs no exchange at all: a document is one row, so its
counts are built inside the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.text import split_on_blank, term_counts


def tokens(lines: DataFrame) -> DataFrame:
    """One row per token -> ``doc_id, line_no, token_no, word``."""
    return lines.select(
        "doc_id",
        "line_no",
        F.posexplode(split_on_blank(F.col("line"))).alias("token_no", "word"),
    )


def _words(lines: DataFrame) -> DataFrame:
    return lines.select("doc_id", "line_no", F.explode(split_on_blank(F.col("line"))).alias("word"))


def doc_term_counts(lines: DataFrame) -> DataFrame:
    """Per-document word counts -> ``doc_id, line_no, word, cnt``.

    A document is one row, so its counts are computed inside the row
    (``term_counts``): the in-mapper combine, with no exchange at all. A
    ``groupBy(doc_id, line_no, word)`` would shuffle every distinct
    (document, word) pair across the cluster to rebuild groups that never
    left their row.
    """
    tokens = lines.select("doc_id", "line_no", split_on_blank(F.col("line")).alias("t"))
    return term_counts(tokens, "t", ["doc_id", "line_no"])


def word_count(lines: DataFrame) -> DataFrame:
    """Word counts in one aggregation round."""
    return _words(lines).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def _two_round(salted: DataFrame) -> DataFrame:
    partial = salted.groupBy("salt", "word").agg(F.count(F.lit(1)).alias("part_cnt"))
    return partial.groupBy("word").agg(F.sum("part_cnt").cast("long").alias("cnt"))


def word_count_salted(lines: DataFrame, K: int) -> DataFrame:
    """Salt given in the map, per (document, word) pair, in ``[0, K)``.

    The salt is a hash of the document and the word instead of a random draw:
    the final sums never depend on it, and a retried task then writes exactly
    the rows it wrote before.
    """
    if K < 1:
        raise ValueError("K must be >= 1")
    words = _words(lines)
    salt = F.pmod(F.xxhash64("doc_id", "line_no", "word"), F.lit(K)).cast("int")
    return _two_round(words.select(salt.alias("salt"), "word"))


def word_count_rand_group(lines: DataFrame, K: int, seed: int = 0) -> DataFrame:
    """Salt drawn in ``[0, K)`` for every token by the grouping step.

    The draw is a hash of the token's place and the seed, so a retried task
    puts every token under the salt it had before.
    """
    if K < 1:
        raise ValueError("K must be >= 1")
    salt = F.pmod(F.xxhash64("doc_id", "line_no", "token_no", F.lit(seed)), F.lit(K)).cast("int")
    return _two_round(tokens(lines).select(salt.alias("salt"), "word"))


def word_count_partition(lines: DataFrame) -> DataFrame:
    """Pre-sum inside each partition, then group and sum.

    The per-partition pre-sum is Catalyst's partial ``HashAggregate`` below
    the exchange (see ``corvid.plans.inspect.has_partial_aggregate``); it is
    the same physical plan as ``word_count``.
    """
    ones = _words(lines).select("word", F.lit(1).cast("long").alias("one"))
    return ones.groupBy("word").agg(F.sum("one").alias("cnt"))


def distinct_words(lines: DataFrame) -> DataFrame:
    """Exact number of distinct words -> one row ``distinct_words``."""
    return _words(lines).agg(F.count_distinct("word").alias("distinct_words"))


def avg_word_length(lines: DataFrame) -> DataFrame:
    """Truncated mean length of the distinct words -> ``avg_word_length``.

    Lengths are in characters (code points); the sum is a long; an input
    without words gives NULL.
    """
    distinct = _words(lines).select("word").distinct()
    stats = distinct.agg(
        F.sum(F.length("word").cast("long")).alias("len_sum"),
        F.count(F.lit(1)).alias("n"),
    )
    return stats.select(
        F.when(F.col("n") > 0, F.expr("len_sum div n")).alias("avg_word_length")
    )
