import random
import re
from itertools import permutations

import pytest

from cases import awkward
from corvid.llm import filter_audit as fa

DOCS = "doc_id long, text string, lang string, mask int, digest string, `a.b` int, n long"
LABELS = "doc_id long, quality int, toxic int, part string"


def brute_mask(rows, i):
    ident, text = rows[i][0], rows[i][1] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    copy = ident is not None and any(o is not None and o < ident and (t or "") == text for o, t, _ in rows)
    return (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        bool(re.search(r"[#$%&*|]", text)), copy,
    )


def brute(rows, labels):
    """Every order applied document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = []
    for part in {lang or "" for *_, lang in rows}:
        docs = [(rows[i][0], brute_mask(rows, i)) for i in range(len(rows)) if (rows[i][2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, 1):
                k = "ABCDE".index(name)
                gone = [d for d in left if d[1][k]]
                left = [d for d in left if not d[1][k]]
                shapley[name] += len(gone)
                found.append((
                    "".join(order), step, len(left), len(gone), sum(d[1][k] for d in docs) - len(gone),
                    sum(d[1][k] and sum(d[1]) == 1 for d in docs), sum(d[0] in good for d in gone),
                    sum(d[0] in toxic for d in gone), name,
                ))
        out += [(part, *f[:-1], shapley[f[-1]]) for f in found]
    return sorted(out)


def audit(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, a, 1, "d", 2, 3) for i, t, a in rows], DOCS).repartition(4)
    marks = spark.createDataFrame([(*r, "p") for r in labels], LABELS)
    return sorted(tuple(r) for r in fa.audit(docs, marks).collect())


def test_equals_brute_force(spark):
    r = random.Random(4)
    some = ["word " * 250, " ".join(f"w{i}" for i in range(230)), "SHOUT " * 3, "a # b", "", None, "AB|", "Same#text"]
    texts = [r.choice(some) for _ in range(60)] + awkward()
    rows = [(i * 3 % 101, t, r.choice(["en", "fr", None])) for i, t in enumerate(texts)]
    rows += [(None, "a # b", "en"), (7, "a # b", "en"), (7, "a # b", "fr"), (None, None, None)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 90, 2)] + [(7, 0, 0), (7, 1, 1), (None, 1, 1)]
    assert audit(spark, rows, labels) == brute(rows, labels)


def test_hot_text(spark):
    rows = [(i, "copy $ copy" if i % 3 else f"text {i}", "en") for i in range(300)]
    assert audit(spark, rows, [(1, 1, 0), (2, 1, 1)]) == brute(rows, [(1, 1, 0), (2, 1, 1)])


def test_empty_tables(spark):
    assert audit(spark, [], []) == []
    assert len(audit(spark, [(1, "x", "en")], [])) == 600


def test_gray_walk_visits_every_subset():
    r = random.Random(1)
    counts = [(mask, (r.randrange(9), r.randrange(9))) for mask in range(16)]
    states = fa.gray_walk(counts, 4)
    for subset in range(16):
        left = [n for mask, n in counts if not mask & subset]
        assert states[subset] == tuple(sum(c) for c in zip(*left, strict=True)) if left else (0, 0)


@pytest.mark.parametrize("size", [1, 10, 1000])
def test_slices_cut_no_word(size, monkeypatch):
    texts = [(t or "").encode() for t in awkward()]
    want = [fa.failures(t) for t in texts]
    monkeypatch.setattr(fa, "SLICE", size)
    assert [fa.failures(t) for t in texts] == want
    assert all(b"".join(fa._slices(t)) == t for t in texts)
