import collections
import random
import re

import numpy as np
import pytest

from cases import awkward
from corvid.llm import divergence, term_runs

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, least_docs, top):
    """(lang, source, text) rows -> the audit's rows, from the definition."""
    rows = [(a or "", b or "", TERM.findall(low(t))) for a, b, t in rows]
    out = []
    for lang in {a for a, _, _ in rows}:
        mine = [(s, ws) for a, s, ws in rows if a == lang]
        df = collections.Counter(w for _, ws in mine for w in set(ws))
        kept = {w for w, n in df.items() if n >= least_docs}
        sources = {s for s, _ in mine}
        counts = {s: collections.Counter(w for x, ws in mine if x == s for w in ws if w in kept) for s in sources}
        every = sum(counts.values(), collections.Counter())

        def share(c, w, kept=kept):
            return 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept))

        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            c = counts[s]
            pairs = [(sum(f(share(c, w), share(counts[o], w)) for w in kept), o) for o in sources - {s}]
            terms = [(f(share(c, w), share(every, w)), w) for w in kept if c[w] and share(c, w) > share(every, w)]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(found[:limit], 1)]
    return sorted(out)


def table(spark, rows, partitions=4):
    full = [(i, t, a, s, 1, "clash", 2, 3) for i, (a, s, t) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, term int, `a.b` string, n int, number int"
    return spark.createDataFrame(full, schema).repartition(partitions)


def audit(spark, rows, **kw):
    got = divergence.diverging(table(spark, rows), **kw).collect()
    return sorted(tuple(r) for r in got)


def made(seed, n, sources=4):
    r = random.Random(seed)
    words = ["a", "Zz", "été", "longer-word", "x" * 9, "Sixteenbyteslong", "x" * 40, "日本語", "y" * 17, "the", "The", "b2c"]
    rows = []
    for _ in range(n):
        text = " ".join(r.choice(words) for _ in range(r.randrange(40)))
        rows.append((r.choice(["en", "fr", None]), r.choice([f"s{i}" for i in range(sources)] + [None]), r.choice([text, text, text, None, ""])))
    return rows


def test_equals_brute_force(spark):
    rows = made(1, 120) + [("de", "only", "wort wort"), ("it", "x", "raro"), ("it", "y", None)]
    assert audit(spark, rows, least_docs=3, top=4) == brute(rows, 3, 4)


def test_awkward_texts_and_hot_source(spark):
    rows = [("en", "hot" if i % 3 else "s", t) for i, t in enumerate(awkward() * 2)]
    assert audit(spark, rows, least_docs=2, top=5) == brute(rows, 2, 5)


def test_lots_and_blocks_change_nothing(spark, monkeypatch):
    rows = made(2, 150, sources=7)
    want = brute(rows, 2, 10)
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "LOT_TERMS", 2)
    assert audit(spark, rows, least_docs=2, top=10) == want


def test_empty_table(spark):
    assert divergence.diverging(table(spark, made(1, 3)).limit(0)).collect() == []


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_slices_cut_no_term(chunk, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "CHUNK", chunk)
    texts = ["one two one", "", "Two! " * 30 + "é" * 50, "two", "x" * 200]
    codes = np.array([0, 0, 1, 1, 2])
    got, docs = collections.Counter(), collections.Counter()
    for b in divergence._counts(codes, pa.array(texts)):
        for g, w, n, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
            got[g, w] += n
            docs[g, w] += d
    want = collections.Counter((g, w) for g, t in zip(codes.tolist(), texts, strict=True) for w in TERM.findall(low(t)))
    seen = collections.Counter((g, w) for g, t in zip(codes.tolist(), texts, strict=True) for w in set(TERM.findall(low(t))))
    assert got == want and docs == seen


def test_radix_order_groups_equal_words():
    r = np.random.default_rng(3)
    words = r.integers(0, 2**63, (50, 2)).astype(np.uint64)[r.integers(0, 50, 2000)]
    order = term_runs.radix_order(words)
    moved = words[order]
    heads = np.flatnonzero(np.r_[True, (moved[1:] != moved[:-1]).any(axis=1)])
    assert len(heads) == len(np.unique(words, axis=0))
    for at in np.split(order, heads[1:]):
        assert (np.diff(at) > 0).all()  # stable
