from collections import defaultdict

import pytest

from cases import awkward, make_docs
from corvid.llm import exact_dedup as ed

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(ids, texts):
    groups = defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        groups[(t or "").translate(AZ)].append(i)
    return {
        (i, max((x for x in g if x is not None), default=None), len(g))
        for g in groups.values()
        for i in g
    }


@pytest.mark.parametrize("bits", [64, 3])
def test_against_grouping_whole_texts(spark, bits):
    texts = awkward() + ["É", "é", "A\nB. " * 700, "a\nb. " * 700, "a\nb. " * 699 + "x"]
    ids = list(range(len(texts)))
    got = ed.find_copies(make_docs(spark, texts), bits=bits).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == expected(ids, texts)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


def test_chunks_rebuild_the_text(spark):
    for t in (t for t in awkward() if t):
        df = spark.createDataFrame([(t,)], "t string")
        cut = df.select(ed.chunks(df["t"]).alias("c")).first()["c"]
        assert "".join(cut) == t
        assert all(len(c) <= ed.MAX_CHUNK for c in cut)


def test_repeated_rows_null_ids_and_empty_table(spark):
    got = ed.find_copies(make_docs(spark, ["a", "a", "A", "b"], [1, 1, None, None])).collect()
    assert sum(r["kept"] for r in got) == 2 and all(r["group_size"] in (1, 3) for r in got)
    assert {r["keep_id"] for r in got} == {1, None}
    assert ed.find_copies(make_docs(spark, [])).count() == 0


def test_drop_copies_keeps_columns_and_one_row_of_each(spark, tmp_path):
    make_docs(spark, ["a", "a", "A", "b", None, ""], [1, 1, 3, 4, 5, 6]).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = ed.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 6]
