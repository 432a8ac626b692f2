import itertools
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cases import awkward, make_docs
from corvid.llm import packing as pk
from corvid.llm.queries import vocabulary


@pytest.fixture(scope="module")
def path():
    return vocabulary("byte_bpe_50k.json")


def test_words_encode_as_whole_texts_do(path):
    lib, mine = Tokenizer.from_file(path), pk.WordTokenizer(path)
    r = np.random.default_rng(2)
    alphabet = list(" \n\tab.,'s1é日🎉\x1c\x85 ") + ["<|endoftext|>", "don't", "  "]
    texts = ["".join(r.choice(alphabet, r.integers(0, 30))) for _ in range(2000)] + [t for t in awkward() if t]
    for t, got in zip(texts, mine.encode_all(texts), strict=True):
        assert np.frombuffer(got, np.uint32).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t[:60])


def test_cache_limit_changes_nothing(path, monkeypatch):
    texts = [t for t in awkward() if t]
    want = pk.WordTokenizer(path).encode_all(texts)
    monkeypatch.setattr(pk, "CACHE_WORDS", 5)
    assert pk.WordTokenizer(path).encode_all(texts) == want


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 2048, 5000])
def test_piece_bounds(n):
    cut = pk.piece_bounds(n, 1024)
    assert [s for s, _ in cut] == [0, *itertools.accumulate(x for _, x in cut[:-1])]
    assert sum(x for _, x in cut) == n and all(x == 1024 for _, x in cut[1:]) and 1 <= cut[0][1] <= 1024


def least_bins(sizes, capacity):
    """Exact bin count by trying every bin for every item."""
    best = len(sizes)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= sizes[k]:
                rooms[i] -= sizes[k]
                place(k + 1, rooms)
                rooms[i] += sizes[k]
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best


def test_bound_never_exceeds_the_best_packing():
    r = np.random.default_rng(4)
    for _ in range(60):
        sizes = r.integers(1, 21, r.integers(1, 9))
        bins, offsets, made = pk.best_fit_decreasing(sizes, 20)
        best = least_bins(sorted(sizes.tolist(), reverse=True), 20)
        assert pk.lower_bound(sizes, 20) <= best <= made
        for b in range(made):
            at = sorted((int(offsets[i]), int(sizes[i])) for i in np.flatnonzero(bins == b))
            assert at[0][0] == 0 and all(x + n == y for (x, n), (y, _) in itertools.pairwise(at))
            assert at[-1][0] + at[-1][1] <= 20


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for at in by.values():
        end = 0
        for o, n in sorted(at):
            assert o == end
            end += n
        assert end <= capacity
    return len(by)


def test_packing_of_awkward_texts(spark, path):
    texts = [*awkward(), None]
    docs = make_docs(spark, texts, [*range(len(texts) - 1), None])
    cut = pk.pieces(docs, path, with_ids=True)
    rows = pk.pack(cut, per_part=4, fan_in=2).collect()
    lib = Tokenizer.from_file(path)
    want = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts[:-1])} | {None: [2]}
    got = {}
    for r in sorted(rows, key=lambda r: r["piece"]):
        ids = r["ids"]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and r["length"] == len(ids)
        assert r["start"] == len(got.setdefault(r["doc_id"], []))
        got[r["doc_id"]] += ids
    assert got == want
    check(rows, 1024)
    made = check(pk.pack(cut).collect(), 1024)
    assert made <= pk.lower_bound(np.array([r["length"] for r in rows]), 1024) + 2


def test_exchange_closes_gaps(spark):
    r = np.random.default_rng(8)
    sizes = r.integers(20, 70, 3000)
    cut = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "doc_id long, length long")
    few = check(pk.pack(cut, capacity=100, per_part=100, rounds=0).collect(), 100)
    more = check(pk.pack(cut, capacity=100, per_part=100, rounds=3).collect(), 100)
    assert pk.lower_bound(sizes, 100) <= more <= few
    assert len(pk.pack(cut, capacity=100, per_part=100).collect()) == 3000


def test_full_pieces_and_empty_table(spark, path):
    cut = spark.createDataFrame([(1, 10), (2, 10)], "doc_id long, length long")
    assert check(pk.pack(cut, capacity=10).collect(), 10) == 2
    assert pk.pack(pk.pieces(make_docs(spark, []), path)).count() == 0
