import hashlib
import random
import re

import numpy as np
import pytest

from cases import awkward, make_docs, sample
from corvid.llm import lpf_dedup, repeats, suffix_tree
from corvid.llm.shingles import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_cut(rows, width):
    first, out = {}, {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), i)
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def bytes_cut(rows, width):
    seen, out = set(), {}
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - width + 1):
            s = raw[k : k + width]
            if s in seen:
                gone[k : k + width] = True
            seen.add(s)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[i] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def check_words(df, rows, width):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}
    assert got == words_cut(rows, width)


def check_bytes(df, rows, width):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["removed"]), r["kept_sha256"]) for r in df.collect()}
    assert got == bytes_cut(rows, width)


def cases():
    return list(enumerate([*awkward(), "a" * 300, "ab" * 30 + "c" + "ab" * 80]))


@pytest.mark.parametrize(("frequent", "tasks"), [(repeats.FREQUENT, None), (2, 5)])
def test_words_against_brute_force(spark, frequent, tasks):
    rows = cases()
    docs = make_docs(spark, [t for _, t in rows])
    check_words(suffix_tree.cut_repeats(docs, frequent=frequent, tasks=tasks), rows, 13)


@pytest.mark.parametrize(("frequent", "tasks"), [(repeats.FREQUENT, None), (2, 5)])
def test_bytes_against_brute_force(spark, frequent, tasks):
    rows = cases()
    docs = make_docs(spark, [t for _, t in rows])
    check_bytes(lpf_dedup.cut_copies(docs, frequent=frequent, tasks=tasks), rows, 100)


def alike_words():
    """Two words whose 64-bit hashes share their upper 32 bits."""
    names = [f"id{k}" for k in range(400_000)]
    upper = Words([" ".join(names)]).hashes >> np.uint64(32)
    order = np.argsort(upper, kind="stable")
    at = int(np.flatnonzero(np.diff(upper[order]) == 0)[0])
    return names[order[at]], names[order[at + 1]]


@pytest.mark.parametrize("frequent", [repeats.FREQUENT, 1])
def test_words_that_share_half_a_hash_are_different(spark, frequent):
    a, b = alike_words()
    rows = []
    for k in range(12):  # in some of these the anchor does not hold the word
        template = [f"t{k}x{j}" for j in range(12)]
        rows += [(2 * k + n, " ".join([*template, w])) for n, w in enumerate((a, b))]
    docs = make_docs(spark, [t for _, t in rows])
    check_words(suffix_tree.cut_repeats(docs, frequent=frequent), rows, 13)


@pytest.mark.parametrize(("module", "dtype"), [(suffix_tree, np.uint64), (lpf_dedup, np.uint8)])
def test_a_shared_passage_is_no_hot_task(spark, module, dtype, monkeypatch):
    """Each document has one passage: its repeats spread over all tasks, and a
    key has contexts with items from few batches only."""
    method = module._method(13, 5) if module is suffix_tree else repeats.Method(100, 20, module._items(20), True, None)
    passage = " ".join(f"passage{k}" for k in range(40))
    values = next(method.items([passage]))[2]
    cand = [{"value": int(v), "frequent": True} for v in repeats.anchors(values, method.width, method.gram)[1].view(np.int64)]
    n = 3000
    rows = spark.createDataFrame(
        [(i, (passage,), cand) for i in range(n)],
        "id long, row struct<text:string>, cand array<struct<value:long,frequent:boolean>>",
    ).coalesce(1)
    monkeypatch.setattr(repeats, "TOGETHER", 100, raising=False)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 500)
    try:
        packs = repeats._contexts(rows, method, 20).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    size, seen = [0] * 20, 0
    windows = len(values.codes) - method.width + 1
    keys = []
    for p in packs:
        size[p["task"]] += int.from_bytes(p["packed"][:8], "little")
        live, *_, counts, _, known = repeats._unpacked(p["packed"], method.width, np.dtype(dtype).itemsize)
        keys += live
        seen += sum(counts) + int(known[2].sum())
    # Every window arrives; a document's known ones are a single run.
    assert seen == n * windows and sum(size) == windows + n - 1 and max(size) < sum(size) / 4
    assert len(keys) == len(set(keys)) == windows


@pytest.mark.parametrize("batch", [1, 7])
def test_small_batches_in_any_order(spark, batch):
    rows = cases() + [(100 + i, t) for i, t in cases()]
    r = random.Random(8)
    r.shuffle(rows)
    docs = make_docs(spark, [t for _, t in rows], [i for i, _ in rows], partitions=1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        check_words(suffix_tree.cut_repeats(docs, frequent=2, tasks=5), sorted(rows), 13)
        check_bytes(lpf_dedup.cut_copies(docs, frequent=2, tasks=5), sorted(rows), 100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_tables_sample(spark):
    rows = sample()
    docs = make_docs(spark, [t for _, t in rows], [i for i, _ in rows])
    check_words(suffix_tree.cut_repeats(docs), rows, 13)
    check_bytes(lpf_dedup.cut_copies(docs), rows, 100)


def test_small_alphabets_at_random(spark):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randrange(60)))) for i in range(40)]
    docs = make_docs(spark, [t for _, t in rows])
    check_words(suffix_tree.cut_repeats(docs, width=4, gram=2), rows, 4)
    check_bytes(lpf_dedup.cut_copies(docs, width=9, gram=4), rows, 9)


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = " ".join(f"w{k}" for k in range(40))
    docs = make_docs(spark, [t, t, t, None], [5, 5, None, 6])
    for df in (suffix_tree.cut_repeats(docs), lpf_dedup.cut_copies(docs)):
        assert [r["n_removed"] for r in df.collect()] == [0, 0, 0, 0]
    assert suffix_tree.cut_repeats(make_docs(spark, [])).count() == 0
    assert lpf_dedup.cut_copies(make_docs(spark, [])).count() == 0


def test_drop_repeats_keeps_rows_and_columns(spark):
    t = " ".join(f"w{k}" for k in range(40))
    docs = make_docs(spark, [t, "x  y " + t, "a  b", None])
    out = suffix_tree.drop_repeats(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["rest"], r["id"]) for r in out.collect()}
    assert got[0] == (t, len(t), "r", 7) and got[1] == ("x y", 3, "r", 7)
    assert got[2] == ("a  b", 4, "r", 7) and got[3] == (None, 0, "r", 7)


def test_smaller_before_and_sliding():
    r = np.random.default_rng(1)
    for n in (1, 2, 50, 400):
        v = r.integers(0, 9, n)
        want = [max([j for j in range(i) if v[j] < v[i]], default=-1) for i in range(n)]
        assert lpf_dedup.smaller_before(v).tolist() == want
        for w in (1, 3, 7):
            if n >= w:
                assert repeats.sliding(v, w, np.minimum).tolist() == [v[i : i + w].min() for i in range(n - w + 1)]
