import random

import numpy as np
import pytest

from cases import VOCABULARY, make_docs
from corvid.llm import quality as q


def corpus(n, seed):
    """Clean, toxic and junk texts with their labels."""
    r = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [r.choice(VOCABULARY) + r.choice("abcdefgh") * r.randrange(3) for _ in range(r.randrange(20, 120))]
        kind = r.choice(["clean", "clean", "clean", "toxic", "junk"])
        if kind == "toxic":
            words[r.randrange(len(words))] = r.choice(["vilex", "grosst", "nastyo"])
        if kind == "junk":
            words = [w.upper() + "!!" for w in words]
        texts.append(" ".join(words))
        labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    return texts, labels


@pytest.fixture(scope="module")
def fitted(spark):
    texts, labels = corpus(900, 1)
    docs = make_docs(spark, texts)
    table = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int, toxic int")
    return docs, labels, table, q.train(docs, table)


def test_held_out_accuracy(fitted):
    docs, labels, _, model = fitted
    kept = {r["doc_id"]: r["kept"] for r in q.score(docs, model).collect()}
    held = [(i, good and not toxic) for i, good, toxic in labels if i % 3 == 0]
    assert np.mean([kept[i] == bool(want) for i, want in held]) >= 0.97
    assert np.mean([kept[i] for i, want in held if want]) >= 0.97


def test_views_and_scores(fitted):
    docs, _, _, model = fitted
    rows = q.score(docs, model).collect()
    assert all(0 <= r[c] <= 1 for r in rows for c in ("p_text", "p_meta", "score"))
    junk, clean = model.scores("OVER RIVER!! STONE!!" * 9, "en", "s"), model.scores("the river over a stone " * 9, "en", "s")
    assert junk[1] < 0.3 < clean[1]
    toxic = model.scores("the river vilex stone over a paper house", "en", "s")
    assert toxic[0] < 0.3 and toxic[2] < q.KEEP


def test_keep_good_drops_what_score_rejects(fitted):
    docs, _, table, model = fitted
    kept = q.keep_good(docs, table)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    want = {r["doc_id"] for r in q.score(docs, model).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_nulls_repeats_and_nothing_to_learn(spark, fitted):
    model = fitted[3]
    docs = make_docs(spark, [None, "", "x " * 50_000, "same", "same"], [1, 2, 3, 4, 4])
    docs = docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "CAST(NULL AS string) AS source")
    rows = q.score(docs, model).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(rows) == 5 and by[1] == by[2] and len(by[4]) == 1
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["kept"] for r in q.score(docs, q.train(docs, none)).collect()] == [True] * 5
    one = spark.createDataFrame([(1, 1, 0), (2, 1, None), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert q.train(docs, one).constant == 1.0
    assert q.score(make_docs(spark, []), model).count() == 0
    assert q.keep_good(make_docs(spark, []), fitted[2]).count() == 0


def test_sure_needs_precision():
    z, y = np.arange(100.0), (np.arange(100) >= 50).astype(float)
    low, high = q._sure(z, y)
    assert 45 <= low <= 51 and 48 <= high <= 54
    assert q._sure(z, np.tile([0.0, 1.0], 50)) == (-np.inf, np.inf)
