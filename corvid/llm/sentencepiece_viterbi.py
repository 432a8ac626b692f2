"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces drives a single-pass Viterbi: at
each end position it yields, along its output links, every piece that ends
there (longest first), and each relaxes the best score of that position. A
character that no piece covers costs ``least score - 10`` and falls back to
its UTF-8 bytes. Ties go to the earlier start, that is the longer last piece.

That is the encoding of a unigram model. The scores of a BPE model are the
ranks of its merges, not costs to be summed: there (``MergeModel``) the ids are
those of the merges in their order, as the library's ``encode`` gives them.

When no piece holds a space mark after another character (checked when the
model is loaded), no piece spans a word start, so the encoding of a text is
the concatenation of the encodings of its words; each task then solves a
distinct word once and keeps at most ``CACHE_WORDS`` of them. Otherwise texts
are solved whole.

The work is one narrow pass over the rows; nothing is shuffled.

Defined results: null text is empty, an empty text has no ids; a literal space
mark (U+2581) in a text decodes to a space; null ids decode to an empty text,
bytes that are not UTF-8 to U+FFFD; repeated rows are encoded alike; an empty
table gives no rows; further columns are dropped.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import once_a_process

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 350_000
CACHE_UNITS = 100_000
CHUNK_CHARS = 1 << 22
SHORT = 40  # characters of words whose merges need no heap


class PieceModel:
    """Pieces, scores and kinds of a model file, with its automaton."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        self.pieces = [self.lib.id_to_piece(i) for i in range(n)]
        self.byte_id = [self.lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        byte_ids = {i for i in self.byte_id if self.lib.is_byte(i)}
        self.has_bytes = len(byte_ids) == 256
        special = {
            i
            for i in range(n)
            if i in byte_ids or self.lib.is_control(i) or self.lib.is_unknown(i) or self.lib.is_unused(i)
        }
        scores = [self.lib.get_score(i) for i in range(n)]
        normal = [i for i in range(n) if i not in special]
        self.unknown_score = min((scores[i] for i in normal), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            self.automaton.add_word(self.pieces[i], (len(self.pieces[i]), scores[i], i))
        self.automaton.make_automaton()
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", self.pieces[i]) for i in normal)
        blank = {i for i in range(n) if self.lib.is_control(i)}
        self.raw = [
            b"" if i in blank else bytes([self.byte_id.index(i)]) if i in byte_ids else self.pieces[i].encode()
            for i in range(n)
        ]
        self.unknown_id = self.lib.unk_id()
        self.dummy_prefix = self.lib.normalize("a").startswith(SPACE)
        self.cache: dict[str, bytes] = {}

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best path over the normalised ``text``."""
        n = len(text)
        best = [-np.inf] * (n + 1)
        best[0] = 0.0
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)  # (start, id)
        single = [False] * n
        at = 0
        unknown = self.unknown_score

        def close(end: int) -> None:
            """Positions up to ``end`` that no piece of one character covers."""
            nonlocal at
            while at < end:
                if not single[at]:
                    s = best[at] + unknown
                    if s > best[at + 1]:
                        best[at + 1], back[at + 1] = s, (at, -1)
                at += 1

        for end, (length, score, i) in self.automaton.iter(text):
            close(end)
            start = end + 1 - length
            if length == 1:
                single[end] = True
            s = best[start] + score
            if s > best[end + 1]:
                best[end + 1], back[end + 1] = s, (start, i)
        close(n)
        out: list[int] = []
        end = n
        while end:
            start, i = back[end]
            if i >= 0:
                out.append(i)
            elif self.has_bytes:
                out.extend(self.byte_id[b] for b in reversed(text[start:end].encode()))
            elif not out or out[-1] != self.unknown_id:
                out.append(self.unknown_id)
            end = start
        out.reverse()
        return out

    solve = viterbi

    def encode(self, text: str) -> bytes:
        """Ids of a raw text as 32-bit integers; a word is solved once while it
        is kept."""
        norm = self.lib.normalize(text) if text else ""
        if not norm:
            return b""
        if not self.by_word:
            return array("i", self.solve(norm)).tobytes()
        words = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", norm)
        known = self.cache
        new = {w: array("i", self.solve(w)).tobytes() for w in set(words).difference(known)}
        if len(known) + len(new) <= CACHE_WORDS:
            known.update(new)
            return b"".join(map(known.__getitem__, words))
        return b"".join([known[w] if w in known else new[w] for w in words])

    def decode(self, ids) -> str:
        out = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return out[1:] if self.dummy_prefix and out.startswith(" ") else out


class MergeModel(PieceModel):
    """A BPE model: neighbours whose join is a piece are merged, best score
    first and the leftmost of equals, until none are left. User-defined pieces
    stand from the start and are not merged; pieces marked unused are taken
    apart again."""

    def __init__(self, path: str):
        super().__init__(path)
        proto = _proto(self.lib)
        joined = [i for i, p in enumerate(proto.pieces) if p.type in (p.NORMAL, p.USER_DEFINED, p.UNUSED)]
        self.price = {self.pieces[i]: -self.lib.get_score(i) for i in joined}
        self.ids = {self.pieces[i]: i for i in joined}
        self.unused = {p.piece for p in proto.pieces if p.type == p.UNUSED}
        own = sorted((p.piece for p in proto.pieces if p.type == p.USER_DEFINED), key=len, reverse=True)
        self.whole = frozenset(own)
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.units: dict[str, list[int]] = {}
        self.begin = re.compile("|".join([*map(re.escape, own), "."]), re.DOTALL).findall if own else list
        self.by_word = self.by_word and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.unused)

    def solve(self, text: str) -> list[int]:
        """Ids of the normalised ``text``. No merge crosses two neighbours that
        no piece has side by side, so a text is cut there first."""
        if self.whole or self.unused:
            return self._ids(*self._long(text))
        inside, units, out = self.inside, self.units, []
        cuts = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in inside]
        start = 0
        for end in (*cuts, len(text)):
            unit = text[start:end]
            start = end
            found = units.get(unit)
            if found is None:
                found = self._ids(self._short(unit) if len(unit) <= SHORT else self._long(unit)[0], {})
                if len(units) < CACHE_UNITS:
                    units[unit] = found
            if len(found) == 1 and found[0] == self.unknown_id and out[-1:] == found:
                continue  # neighbouring unknowns are one
            out += found
        return out

    def _short(self, text: str) -> list[str]:
        """The merged parts, by looking through all neighbours each time."""
        price, none = self.price.get, np.inf
        at = list(range(len(text) + 1))  # where parts begin, and the end
        costs = [price(text[i : i + 2], none) for i in range(len(text) - 1)]
        while costs and (least := min(costs)) < none:
            i = costs.index(least)
            del at[i + 1], costs[i]
            if i < len(costs):
                costs[i] = price(text[at[i] : at[i + 2]], none)
            if i:
                costs[i - 1] = price(text[at[i - 1] : at[i + 1]], none)
        return [text[a:b] for a, b in zip(at, at[1:])]  # noqa: B905

    def _long(self, text: str) -> tuple[list[str], dict[str, tuple[str, str]]]:
        """The merged parts, by a heap of neighbours; unused pieces, and what
        they were made of."""
        price, whole = self.price, self.whole
        parts = self.begin(text)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple] = []
        made: dict[str, tuple[str, str]] = {}

        def offer(i: int, j: int) -> None:
            a, b = parts[i], parts[j]
            if whole and (a in whole or b in whole):
                return
            cost = price.get(a + b)
            if cost is not None:
                heappush(heap, (cost, i, j, len(a) + len(b)))
                if a + b in self.unused:
                    made[a + b] = (a, b)

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, size = heappop(heap)
            if not parts[i] or not parts[j] or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p], made

    def _ids(self, parts: list[str], made: dict[str, tuple[str, str]]) -> list[int]:
        out: list[int] = []
        rest = parts[::-1]
        while rest:
            p = rest.pop()
            if p in made:
                rest.extend(reversed(made[p]))
            elif p in self.ids:
                out.append(self.ids[p])
            elif self.has_bytes:
                out.extend(self.byte_id[b] for b in p.encode())
            elif not out or out[-1] != self.unknown_id:
                out.append(self.unknown_id)
        return out


def _proto(lib):
    from sentencepiece import sentencepiece_model_pb2

    return sentencepiece_model_pb2.ModelProto.FromString(lib.serialized_model_proto())


def _load(path: str) -> PieceModel:
    import sentencepiece

    spec = _proto(sentencepiece.SentencePieceProcessor(model_file=path)).trainer_spec
    return MergeModel(path) if spec.model_type == spec.BPE else PieceModel(path)


def model(path: str) -> PieceModel:
    """The model of a file, encoding as its type says."""
    return once_a_process(("pieces", path), lambda: _load(path))


def _slices(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Cuts of a batch with about ``CHUNK_CHARS`` each (or one row)."""
    at, total = 0, 0
    for i, s in enumerate(sizes):
        if total and total + s > CHUNK_CHARS:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += int(s)
    if at < batch.num_rows:
        yield batch.slice(at)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``<id_col>, <text_col>`` (null as empty), ``ids array<int>``."""

    def run(batches):
        m = model(model_path)
        for whole in batches:
            for batch in _slices(whole, np.diff(_offsets(whole.column(1)))):
                ids = [m.encode(t) for t in batch.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]) // 4
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[id_col, text_col, "ids"])

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    kind = dict(rows.dtypes)[id_col]
    return rows.mapInArrow(run, f"`{id_col}` {kind}, `{text_col}` string, ids array<int>")


def decode(encoded: DataFrame, model_path: str, out_col: str = "decoded") -> DataFrame:
    """``encoded`` (with a column ``ids``) plus the decoded text."""

    def run(batches):
        m = model(model_path)
        for whole in batches:
            k = whole.schema.get_field_index("ids")
            sizes = pc.fill_null(pc.list_value_length(whole.column(k)), 0).to_numpy(zero_copy_only=False) * 4
            for batch in _slices(whole, sizes):
                column = batch.column(k)
                ids = column.flatten().to_numpy().tolist()
                size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                ends = np.cumsum(size).tolist()
                texts = [m.decode(ids[a:b]) for a, b in zip([0, *ends], ends)]  # noqa: B905
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out_col]
                )

    fields = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{fields}, `{out_col}` string")


def _offsets(column: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1]
