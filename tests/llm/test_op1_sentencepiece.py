"""Encoding against the library's own best path over a unigram model."""

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from cases import awkward, make_docs, sample
from corvid.llm import sentencepiece_viterbi as sp
from corvid.llm.queries import vocabulary


@pytest.fixture(scope="module")
def path():
    return vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram(path, tmp_path_factory):
    """The same pieces declared a unigram model, with scores that 32-bit sums
    keep apart (the library sums in single precision)."""
    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.type == 1:
            p.score = max(p.score, -40000.0)
    out = tmp_path_factory.mktemp("model") / "unigram.model"
    out.write_bytes(m.SerializeToString())
    return str(out)


def ids(m, text):
    return np.frombuffer(m.encode(text), np.int32).tolist()


def test_best_paths_are_the_librarys(unigram):
    m, lib = sp.PieceModel(unigram), sentencepiece.SentencePieceProcessor(model_file=unigram)
    texts = [t[:3000] for _, t in sample() if t] + [t[:2000] for t in awkward() if t] + ["\x00", "  a ", "▁▁a ▁"]
    for t in texts:
        assert ids(m, t) == lib.encode(t), t[:80]


def test_words_and_whole_texts_have_one_best_path(path):
    m = sp.PieceModel(path)
    for _, t in sample()[:40]:
        norm = m.lib.normalize(t[:1500])
        assert ids(m, t[:1500]) == m.viterbi(norm)


def test_brute_force_over_all_segmentations(path):
    m = sp.PieceModel(path)
    score = {p: m.lib.get_score(i) for i, p in enumerate(m.pieces) if not m.lib.is_control(i) and not m.lib.is_byte(i)}

    def best(s):
        if not s:
            return 0.0
        return max(score.get(s[:k], m.unknown_score if k == 1 else -1e18) + best(s[k:]) for k in range(1, len(s) + 1))

    for word in ["▁the", "▁hello", "▁ofthe", "▁q\nz", "▁▁x"]:
        got = m.viterbi(word)
        if any(m.lib.is_byte(i) for i in got):
            continue
        assert sum(m.lib.get_score(i) for i in got) == best(word)


def test_awkward_rows_round_trip(spark, path):
    docs = make_docs(spark, [*awkward(), "same same"])
    rows = sp.decode(sp.encode(docs, path), path).collect()
    assert len(rows) == len(awkward()) + 1
    for r in rows:
        assert r["decoded"] == r["text"]
    by = {r["doc_id"]: r["ids"] for r in rows}
    assert by[0] == [] and by[1] == [] and by[4] == by[5]


def test_marks_nulls_and_empty_tables(spark, path):
    m = sp.PieceModel(path)
    assert m.decode(ids(m, "a▁b")) == "a b"
    assert m.decode([m.byte_id[0xFF]]) == "�"
    assert sp.decode(sp.encode(make_docs(spark, []), path), path).count() == 0
    df = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert sp.decode(df, path).first()["decoded"] == ""


def test_ids_of_the_shipped_model_are_its_own(spark, path):
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t for _, t in sample() if t] + [t for t in awkward() if t]
    texts += ["\x00", "  a ", "▁▁a ▁", "<0x41> <s> </s> <unk>", "ab" * 3000, "日本語" * 2000, "x\ny\tz  🎉e\u0301"]
    rows = sp.encode(make_docs(spark, texts), path).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == lib.encode(texts[r["doc_id"]]), r["text"][:80]


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_merges_with_user_defined_and_unused_pieces(path, tmp_path, byte_fallback):
    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.byte_fallback = byte_fallback
    if not byte_fallback:
        kept = [p for p in m.pieces if p.type != p.BYTE]
        del m.pieces[:]
        m.pieces.extend(kept)
    words = [p for p in m.pieces if p.type == p.NORMAL and len(p.piece) > 3]
    for p in words[::3]:
        p.type = p.UNUSED
    for p in words[1::50]:
        p.type = p.USER_DEFINED
    out = tmp_path / "marked.model"
    out.write_bytes(m.SerializeToString())
    got, lib = sp.model(str(out)), sentencepiece.SentencePieceProcessor(model_file=str(out))
    for t in [t[:2000] for _, t in sample() if t] + [t[:2000] for t in awkward() if t] + ["日本語🎉🎉 x"]:
        assert ids(got, t) == lib.encode(t), t[:80]
