from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import fixture
from corvid.functions import split_on_blank
from corvid.operators import words
from corvid.plans.inspect import has_partial_aggregate, plan_text, uses_python_udf
from corvid.session import cut_lineage
from corvid.sources import read_lines, row_count


@pytest.fixture(scope="module")
def lines(spark):
    return cut_lineage(read_lines(spark, fixture("brooks.txt")))


def counts(df):
    return {r.word: r.cnt for r in df.collect()}


@pytest.mark.parametrize(
    "line,expected",
    [("", [""]), ("  ", []), ("a  b ", ["a", "", "b"]), (" a", ["", "a"]), ("x", ["x"])],
)
def test_token_edges(spark, line, expected):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(split_on_blank(F.col("line")).alias("t")).first().t == expected


def test_counts_of_a_file(lines):
    with open(fixture("brooks.txt")) as f:
        raw = f.read().split("\n")
    want = Counter()
    for line in raw:
        tokens = line.split(" ")
        while len(tokens) > 1 and not tokens[-1]:
            tokens.pop()
        want.update(tokens if line.strip(" ") or not line else [])
    assert row_count(lines).first().n == len(raw) == 44
    assert counts(words.word_count(lines)) == want
    assert words.distinct_words(lines).first().distinct_words == len(want)
    assert words.avg_word_length(lines).first().avg_word_length == sum(map(len, want)) // len(want)


@pytest.mark.parametrize("K", [1, 3, 16])
def test_word_count_plans_agree(lines, K):
    base = counts(words.word_count(lines))
    assert counts(words.word_count_salted(lines, K)) == base
    assert counts(words.word_count_rand_group(lines, K, seed=7)) == base
    assert counts(words.word_count_partition(lines)) == base


def test_doc_term_counts_sum_to_word_count(lines):
    dtc = words.doc_term_counts(lines).groupBy("word").agg(F.sum("cnt").alias("cnt"))
    assert counts(dtc) == counts(words.word_count(lines))


def test_tokens_positions(spark):
    df = spark.createDataFrame([(1, 0, "b a b"), (2, 0, " ")], "doc_id long, line_no int, line string")
    rows = sorted((r.doc_id, r.token_no, r.word) for r in words.tokens(df).collect())
    assert rows == [(1, 0, "b"), (1, 1, "a"), (1, 2, "b")]
    dtc = {(r.doc_id, r.word): r.cnt for r in words.doc_term_counts(df).collect()}
    assert dtc == {(1, "b"): 2, (1, "a"): 1}


def test_empty_input_average_is_null(spark):
    df = spark.createDataFrame([], "doc_id long, line_no int, line string")
    assert words.avg_word_length(df).first().avg_word_length is None


def test_partition_plan_has_map_side_combine(lines):
    df = words.word_count_partition(lines)
    assert has_partial_aggregate(df)
    assert not uses_python_udf(df)


def test_salted_plan_has_two_aggregation_rounds(lines):
    text = plan_text(words.word_count_salted(lines, 4), "simple")
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize(
    "text,expected",
    [
        ("", []),
        ("\n", [""]),
        ("a\nb\n", ["a", "b"]),
        ("a\n\nb", ["a", "", "b"]),
        ("a\r\nb\r\n", ["a", "b"]),
        ("a\rb\r", ["a", "b"]),
        ("a\r\n\r\nb", ["a", "", "b"]),
    ],
)
def test_text_lines_edges(spark, text, expected):
    from corvid.functions import text_lines

    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(text_lines(F.col("text")).alias("l")).first().l == expected


def test_doc_term_counts_has_no_exchange(lines):
    df = words.doc_term_counts(lines)
    assert "Exchange" not in plan_text(df, "simple")


@pytest.mark.parametrize("toks", [[], [""], ["b", "a", "b", "", "b"], ["x"] * 5])
def test_term_counts(spark, toks):
    from collections import Counter

    from corvid.functions import term_counts

    df = spark.createDataFrame([(1, toks)], "k int, t array<string>")
    got = {r.word: r.cnt for r in term_counts(df, "t", ["k"]).collect()}
    assert got == dict(Counter(toks))


def test_partitioned_reader_gives_same_counts(spark):
    a = counts(words.word_count(read_lines(spark, fixture("brooks.txt"))))
    df = read_lines(spark, fixture("brooks.txt"), partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert counts(words.word_count(df)) == a


def test_argument_rules(lines):
    from corvid.operators import sales

    with pytest.raises(ValueError):
        words.word_count_salted(lines, 0)
    with pytest.raises(ValueError):
        words.word_count_rand_group(lines, 0)
    with pytest.raises(ValueError):
        sales.top_products(lines, -1)
