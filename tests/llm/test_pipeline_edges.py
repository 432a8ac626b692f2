"""Every pipeline stage with awkward rows and empty tables."""

import os
import random

import pyarrow as pa
import pytest

import corpus_pipeline as cp
from cases import awkward
from corvid.llm import common
from corvid.plans.inspect import uses_python_udf

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, row long, __row string, spans int"


def table(spark, rows):
    full = [(i, t, a, b, len(t or ""), 1, 2, "r", None) for i, t, a, b in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(3)


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with labels of both kinds; documents are given to the stages."""

    def write(labels):
        path = str(tmp_path / f"labels{len(labels)}")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        return path

    return write


def rows():
    texts = awkward()
    out = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None) for i, t in enumerate(texts)]
    out += [out[4], out[4], (None, texts[4], "en", "s"), (None, None, None, None), (3, "other text of id three", "en", "s")]
    return out


@pytest.mark.parametrize("labels", [[], [(i, i % 2, 0) for i in range(12)] + [(None, 1, 1), (3, None, None)]])
def test_awkward_rows_pass_every_stage(spark, tables, labels):
    path = tables(labels)
    docs = table(spark, rows())
    for name, stage in cp.STAGES:
        out = stage(spark, docs, path)
        if name != "best-fit packing":
            assert out.columns == docs.columns, name
        out = cp.staged(out, "edge")
        before, after = docs.count(), out.count()
        if name == "quality classifier" and not labels:
            assert after == before
        if name == "exact dedup":
            texts = [r["text"] or "" for r in out.collect()]
            assert len({t.lower() for t in texts if t.isascii()}) == len([t for t in texts if t.isascii()])
        if name == "substring dedup":
            assert after == before
        if name == "best-fit packing":
            assert out.filter("piece = 0").count() == before
        docs = out


def test_empty_tables_pass_every_stage(spark, tables):
    path = tables([])
    docs = table(spark, rows()).limit(0)
    for _, stage in cp.STAGES:
        docs = cp.staged(stage(spark, docs, path), "empty")
        assert docs.count() == 0


@pytest.mark.parametrize("own", [None, "7", "5000", "0"])
def test_stages_send_few_rows_at_a_time(spark, own):
    """Whoever reads a stage's result, its texts went to Python in small batches."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    stage = cp.written(lambda s, docs, d: docs.mapInArrow(sizes, "n long"))
    if own:
        spark.conf.set(common.BATCH_CONF, own)
    try:
        found = [r["n"] for r in stage(spark, spark.range(0, 3000, 1, 1), "").collect()]
        assert spark.conf.get(common.BATCH_CONF, None) == own
    finally:
        spark.conf.unset(common.BATCH_CONF)
    assert sum(found) == 3000 and max(found) == (7 if own == "7" else common.BATCH_ROWS)


def shared_bytes(spark) -> dict[str, int]:
    """Bytes of each table in the shared folder."""
    top = common.shared_dir(spark).removeprefix("file:")
    os.makedirs(top, exist_ok=True)
    return {t: sum(os.path.getsize(f"{top}/{t}/{f}") for f in os.listdir(f"{top}/{t}")) for t in os.listdir(top) if os.path.isdir(f"{top}/{t}")}


def long_rows(n=60):
    r = random.Random(5)
    return [(i, " ".join(f"{r.getrandbits(48):x}" for _ in range(1500)), "en", "s") for i in range(n)]


def test_exact_and_near_stages_keep_no_copy_of_the_texts(spark, tables):
    """Their results are plans without Python; what they keep is small."""
    path, docs = tables([]), table(spark, long_rows())
    size = sum(len(t) for _, t, _, _ in long_rows())
    stages = dict(cp.STAGES)
    for name in ("exact dedup", "MinHash near-dedup"):
        before = shared_bytes(spark)
        out = stages[name](spark, docs, path)
        assert not uses_python_udf(out), name
        assert out.count() == 60
        assert sum(n for t, n in shared_bytes(spark).items() if t not in before) < size / 5, name


def test_run_keeps_only_the_last_result(spark, tables):
    path = tables([])
    table(spark, rows()).write.parquet(f"{path}/documents.parquet")
    before = shared_bytes(spark)
    out = cp.run(spark, path)
    kept = [t.split("-")[0] for t in shared_bytes(spark) if t not in before and "_stage-" in t]
    assert kept == ["packing_stage"]
    assert out.filter("piece = 0").count() > 0
