"""The registered queries: SQL where there is some, and the pipeline as a whole."""

import pytest

import __spark_entry__ as se
import corpus_pipeline
from cases import SMALL
from corvid.llm import queries
from corvid.plans.compare import compare_frames, duckdb_connection


def test_names():
    names = [*queries.queries()]
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert {*names, "pipeline"} <= se.queries().keys()


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_query_matches_sql(spark, name):
    got = queries.queries()[name](spark, SMALL).toPandas()
    ok, msg = compare_frames(got, duckdb_connection(SMALL).execute(queries.oracles()[name]).df())
    assert ok, msg


def test_pipeline_stages(spark):
    """Each stage against a plain computation on its own input."""
    import re

    from test_op4_op8_repeats import words_cut
    from test_op9_near_dedup import groups

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    seen = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SMALL), "test")
        seen.append(docs.toPandas())
        if name != "best-fit packing":
            assert docs.columns == columns
    start, good, exact, near, cut, packed = seen
    rows = lambda pdf: sorted(zip(pdf["doc_id"], pdf["text"], strict=True))
    assert set(rows(good)) <= set(rows(start)) and len(good) >= len(start) / 2
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    keep = {low(t): i for i, t in rows(good)}
    assert {i for i, _ in rows(exact)} == set(keep.values())
    want = groups(rows(exact), corpus_pipeline.NEAR_PERCENT)
    assert {i for i, _ in rows(near)} == {i for i, (_, c) in want.items() if i == c}
    removed = words_cut(rows(near), 13)
    texts = dict(rows(near))
    for i, t in rows(cut):
        assert len(t.split()) == removed[i][0] - removed[i][1] or t == texts[i]
        assert (t == texts[i]) == (removed[i][1] == 0)
    assert set(packed["doc_id"]) == set(cut["doc_id"])


def test_whole_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SMALL).toPandas()
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(out.columns)
    assert out.groupby("sequence_id")["length"].sum().max() <= 1024
