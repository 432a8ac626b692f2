import random
import re

import pytest

from cases import VOCABULARY, awkward, make_docs, sample
from corvid.llm import near_dedup as nd
from corvid.llm.components import components


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def groups(rows, percent):
    """Components over all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in sets.items():
        for j in {j for g in s for j in holders[g] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def chained(n, seed=1):
    """Texts that drift: neighbours are near, ends are not."""
    r = random.Random(seed)
    words = [r.choice(VOCABULARY) + str(r.randrange(999)) for _ in range(90)]
    out = []
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("percent", "node", "block"), [(85, 200, 1 << 21), (80, 3, 1500)])
def test_against_all_pairs(spark, percent, node, block):
    rows = list(enumerate([*awkward(), *chained(40), *(t for _, t in sample())]))
    docs = make_docs(spark, [t for _, t in rows])
    got = {r["doc_id"]: r for r in nd.near_groups(docs, percent, node=node, block=block).collect()}
    want = groups(rows, percent)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = "a b c d e f g h"
    got = nd.near_groups(make_docs(spark, [t, t, t, None, ""], [5, 5, None, 7, 8])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in got) == [
        (0, None, True), (5, 5, True), (5, 5, True), (7, 7, True), (8, 8, True)
    ]
    assert nd.near_groups(make_docs(spark, [])).count() == 0


def test_drop_near_keeps_columns(spark):
    texts = chained(6)[:2] + ["other words entirely stand here alone", None]
    docs = make_docs(spark, texts)
    kept = nd.drop_near(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 203), (203, 202), (202, 201)]
    df = spark.createDataFrame([*edges, *edges[:5]], "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    want = {i: 0 for i in range(1, 51)} | {100 + i: 100 for i in range(1, 30)} | {202: 201, 203: 201}
    assert {k: v for k, v in got.items() if k != v} == want
    assert components(df.limit(0)).count() == 0
