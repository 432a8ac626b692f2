import hashlib
import re

import pytest

from cases import awkward, make_docs
from corvid.llm import fingerprints as fp


def paragraphs(t):
    return set(re.findall(r"(?s).{1,200}?(?:\n|[.!?]\s|\Z)|.{1,200}", t)) if t else set()


def expected(ids, texts):
    order = sorted(range(len(ids)), key=lambda k: -ids[k])
    out = {}
    for at, k in enumerate(order):
        t, nxt = texts[k] or "", texts[order[(at + 1) % len(order)]] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        a, e, n = paragraphs(t), paragraphs(edited), paragraphs(nxt)
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        out[ids[k]] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), like(a, e), like(a, n))
    return out


@pytest.mark.parametrize(("cells", "sweeps"), [(8, 6), (1, 1)])
def test_against_sets_of_paragraphs(spark, cells, sweeps):
    texts = [*awkward(), "A. B. C. D.\nE", "A. B. C. D.\nF"]
    ids = [3 * i + 1 for i in range(len(texts))]
    want = expected(ids, texts)
    got = fp.fingerprint_edits(make_docs(spark, texts, ids), cells=cells, sweeps=sweeps).collect()
    assert len(got) == len(ids)
    by_text = {}
    for r in got:
        n, sha, edited, nxt = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        assert r["near_edited"] == pytest.approx(edited) and r["near_next"] == pytest.approx(nxt)
        text = texts[ids.index(r["doc_id"])] or ""
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]


def test_one_row_repeated_rows_null_ids_and_empty_table(spark):
    (r,) = fp.fingerprint_edits(make_docs(spark, ["one. two. three."])).collect()
    assert r["near_next"] == 1.0
    got = fp.fingerprint_edits(make_docs(spark, ["a. b.", "a. b.", None, "c"], [1, 1, None, 2])).collect()
    assert len(got) == 4 and len({r["fingerprint"] for r in got}) == 3
    assert fp.fingerprint_edits(make_docs(spark, [])).count() == 0


def test_successors_cross_ranges(spark):
    rows = spark.range(500).selectExpr("id AS row", "(id * 7919) % 100003 AS id")
    got = {r["row"]: r["next_row"] for r in fp.successors(rows).collect()}
    order = [r for r, _ in sorted(((k, k * 7919 % 100003) for k in range(500)), key=lambda x: -x[1])]
    assert got == {a: b for a, b in zip(order, order[1:] + order[:1], strict=True)}


def test_no_table_is_left_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    out = fp.fingerprint_edits(make_docs(spark, ["one. two.", "three. four.\nfive"]))
    assert out.count() == 2
    assert {t.name for t in spark.catalog.listTables()} == before
