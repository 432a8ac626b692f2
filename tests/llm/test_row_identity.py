"""Results do not depend on how often or in which splits a table is scanned,
and words are equal only when their characters are."""

import pytest

from cases import make_docs
from corvid.llm import exact_dedup, fingerprints, lpf_dedup, near_dedup, suffix_tree
from corvid.llm import repeats as rp


@pytest.fixture
def split_files(spark, tmp_path):
    """A table in many files, and a switch of its scans between two numbers of
    splits for every job."""
    texts = [f"text {i % 37}. Some more of it.\n" * (1 + i % 5) for i in range(160)]
    make_docs(spark, texts, partitions=16).write.parquet(str(tmp_path / "d"))
    names = {"spark.sql.leafNodeDefaultParallelism": "2", "spark.sql.files.openCostInBytes": "64"}
    old = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield spark.read.parquet(str(tmp_path / "d"))
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_copies_are_dropped_alike_after_a_change_of_cores(spark, split_files):
    want = {r["doc_id"] for r in exact_dedup.find_copies(split_files).filter("doc_id = keep_id").collect()}
    kept = exact_dedup.drop_copies(split_files)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "16")
    got = [r["doc_id"] for r in kept.collect()]
    assert len(got) == len(want) and set(got) == want


def test_edits_are_alike_after_a_change_of_cores(spark, split_files):
    rows = lambda df: sorted((r["id"], r["edited"]) for r in df.collect())
    want = rows(fingerprints.with_edits(split_files))
    edits = fingerprints.with_edits(split_files)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "16")
    assert rows(edits) == want and len(want) == 160


def test_columns_of_any_name_pass_the_drops(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 1), (2, "a b", "y", 2)], "doc_id long, text string, `a.b` string, __row int")
    for drop in (exact_dedup.drop_copies, suffix_tree.drop_repeats, near_dedup.drop_near):
        out = drop(docs)
        assert out.columns == docs.columns and {r["__row"] for r in out.collect()} <= {1, 2}


def thue_morse(n, flip):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_words_that_polynomials_confuse(spark, n):
    shared = " ".join(f"w{i}" for i in range(12))
    texts = [f"{shared} {thue_morse(n, 0)}", f"{shared} {thue_morse(n, 1)}"]
    assert [r["n_removed"] for r in suffix_tree.cut_repeats(make_docs(spark, texts)).collect()] == [0, 0]
    alone = make_docs(spark, [thue_morse(n, 0), thue_morse(n, 1)])
    got = near_dedup.near_groups(alone, 85).collect()
    assert {r["component_id"] for r in got} == {0, 1}


def test_known_repeats_leave_as_runs():
    runs = [(1, 5, 0, 3, None), (2, 5, 3, 1, None), (3, 5, 4, 1, None), (4, 5, 6, 1, None), (5, 5, 7, 1, b"x"), (6, 5, 8, 2, None), (7, 6, 10, 1, None)]
    assert rp._joined(runs) == [(1, 5, 0, 5, None), runs[3], runs[4], runs[5], runs[6]]


@pytest.mark.parametrize("size", [300, 900])
def test_runs_of_a_shared_passage_do_not_follow_its_length(spark, size):
    passage = "".join(f"{i * 7919 % 997:x}" for i in range(size))
    docs = make_docs(spark, [f"{i} {passage} {i}" for i in range(60)], partitions=2)
    runs = lpf_dedup._spans(docs, "doc_id", "text", 100, 20, 10, None).selectExpr("size(spans) AS n").collect()
    n = sorted(r["n"] or 0 for r in runs)
    assert sum(k > 0 for k in n) >= 59 and n[len(n) // 2] <= 4
