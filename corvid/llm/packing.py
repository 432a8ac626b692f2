"""Best-fit packing with certified bin counts.

Documents become token pieces of at most ``capacity`` ids. Pieces are dealt
evenly over partitions by row number; each partition packs its pieces best-fit
decreasing and computes a lower bound of its bin count from dual feasible
functions of the lengths. A partition that meets its bound is certified: no
packing of its pieces uses fewer sequences. The partitions with a gap exchange
documents: what they hold in sequences that are not full is merged with other
partitions' and packed again, keeping the earlier packing where the new one is
not smaller. Pieces of full length are sequences of their own and never move.

A partition holds about ``per_part`` pieces (some 40 bytes each), so memory is
bounded at any corpus size; token ids are not shuffled, only lengths and
checksums.

Defined results: null and empty texts are one piece of the end id alone;
repeated rows are packed as documents of their own; null ids are kept; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import once_a_process, parts_for, staged
from corvid.llm.word_ids import byte_letters

END_ID = 2
CAPACITY = 1024
PER_PART = 60_000
FAN_IN = 4
ROUNDS = 2
CACHE_WORDS = 200_000


class WordTokenizer:
    """Ids of a byte-level BPE tokenizer file, by word.

    Its pattern starts a new token at each single space between two
    characters that are not white space, so a text can be cut there and each
    distinct piece encoded once (at most ``CACHE_WORDS`` are kept, some 200 bytes
    each). Pieces of Latin letters go straight to the merges: the pattern would
    leave them whole, and costs more than the merges do. Texts with other spacing
    are encoded whole, and so are texts with special tokens.
    """

    LAST_LATIN = "\u024f"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.merges = self.lib.model.tokenize
        self.letters = byte_letters()
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.after_space: dict[str, bytes] = {}
        self.marks = {m: self._whole(m) for m in ".,"}
        self.line_end = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return array("I", self.lib.encode(text, add_special_tokens=False).ids).tobytes()

    def _made(self, word: str, space: str) -> bytes:
        """Ids of a word behind ``space`` (one or none)."""
        if word.isalpha() and max(word) <= self.LAST_LATIN:
            spelt = (space + word).encode().decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.merges(spelt)]).tobytes()
        # A letter run and a mark behind it are tokens of their own, and so is
        # one line end between characters that are not white space.
        if word[-1:] in self.marks and word[:-1].isalpha():
            return self._one(word[:-1], space) + self.marks[word[-1]]
        head, end, tail = word.partition("\n")
        if end and head and tail and not (head[-1].isspace() or tail[0].isspace()):
            return self._one(head, space) + self.line_end + self._one(tail, "")
        return self._whole(space + word)

    def _one(self, word: str, space: str) -> bytes:
        found = self.after_space.get(word) if space else None
        return self._made(word, space) if found is None else found

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self._whole(text)
        first, *words = text.split(" ")
        known = self.after_space
        new = set(words).difference(known)
        # Pieces that cannot stand by themselves: empty ones and such as begin
        # with white space.
        if not first or any(not w or w[0].isspace() for w in new):
            return self._whole(text)
        ids = {w: self._made(w, " ") for w in new}
        if len(known) + len(ids) <= CACHE_WORDS:
            known.update(ids)
            return self._one(first, "") + b"".join(map(known.__getitem__, words))
        # The cache is full: these are not kept.
        found = known.get
        return self._one(first, "") + b"".join([found(w) or ids[w] for w in words])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return [self.encode(t) for t in texts]


def tokenizer(path: str) -> WordTokenizer:
    return once_a_process(("words", path), lambda: WordTokenizer(path))


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: full pieces,
    the first one holding the remainder."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


PIECES = "piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """-> ``<id_col>, piece, start, length, ids_crc32`` (and ``ids``)."""
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = array("I", [end_id]).tobytes()

    def run(batches):
        t = tokenizer(tokenizer_path)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                owner, out, ids = [], [], []
                for i, raw in enumerate(t.encode_all(batch.column(1).to_pylist())):
                    raw += end
                    for p, (start, length) in enumerate(piece_bounds(len(raw) // 4, capacity)):
                        cut = raw[4 * start : 4 * (start + length)]
                        owner.append(i)
                        out.append((p, start, length, zlib.crc32(cut)))
                        if with_ids:
                            ids.append(np.frombuffer(cut, np.uint32).astype(np.int32))
                columns = [batch.column(0).take(pa.array(owner, pa.int32()))]
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns += [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                names = [id_col, "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    kind = dict(rows.dtypes)[id_col]
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {PIECES}" + ", ids array<int>" * with_ids)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each item and the number of bins. Bins are kept by
    what room they have left; a bit mask of the rooms in use finds the least
    room that fits."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - room
        if room > size:
            by_room[room - size].append(b)
            rooms |= 1 << (room - size)
    return bins, offsets, made


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: the largest of the sums of dual feasible
    functions over the lengths (round large sizes up to a bin and small ones
    down to nothing; round to multiples of C / k)."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    for small in range(1, capacity // 2 + 1):
        f = np.where(size > capacity - small, capacity, np.where(size < small, 0, size))
        best = max(best, -(-int((count * f).sum()) // capacity))
    for k in range(1, 50):
        whole = (k + 1) * size % capacity == 0
        f = np.where(whole, size * k, (k + 1) * size // capacity * capacity)  # times k
        best = max(best, -(-int((count * f).sum()) // (k * capacity)))
    return best


def _round(open_pieces: DataFrame, capacity: int, number: int, last: bool) -> DataFrame:
    """Pack each ``part``; ``again`` marks what goes on to the next round."""
    fields = {f.name: f for f in open_pieces.schema}
    kinds = ", ".join(f"`{n}` {fields[n].dataType.simpleString()}" for n in fields)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy(np.int64)
        bound = lower_bound(lengths, capacity)
        bins, offsets, made = best_fit_decreasing(lengths, capacity)
        part = int(pdf["part"].iloc[0])
        pdf["gap"] = made - bound
        better = True
        if number:
            better = made < pdf["sequence_id"].nunique()
        if better:
            pdf["sequence_id"] = (np.int64(part * 8 + number) << 32) + bins
            pdf["offset"] = offsets
        filled = pdf.groupby("sequence_id")["length"].transform("sum")
        pdf["again"] = (pdf["gap"] > 0) & (filled < capacity) & (not last)
        return pdf

    return staged(
        open_pieces.groupBy("part").applyInPandas(pack, kinds + ("" if number else ", sequence_id long, offset long, gap long, again boolean")),
        "packed",
    )


def pack(
    cut: DataFrame, capacity: int = CAPACITY, per_part: int = PER_PART, fan_in: int = FAN_IN, rounds: int = ROUNDS
) -> DataFrame:
    """Pieces (any columns, with ``length`` in 1..capacity) -> the same with
    ``sequence_id, offset`` and ``gap``: the bins above the bound in the
    piece's partition when it was packed last (0: certified)."""
    cut = staged(cut, "pieces")
    columns = cut.columns
    full, rest = cut.filter(F.col("length") == capacity), cut.filter(F.col("length") != capacity)
    done = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn(
        "offset", F.lit(0).cast("long")
    ).withColumn("gap", F.lit(0).cast("long"))
    n = rest.count()
    if not n:
        return done
    parts = parts_for(n, per_part)
    row = F.monotonically_increasing_id()
    live = rest.withColumn("part", F.pmod(F.xxhash64(row), F.lit(parts)))
    for number in range(rounds + 1):
        out = _round(live, capacity, number, last=number == rounds)
        done = done.unionByName(out.filter("not again").select(*columns, "sequence_id", "offset", "gap"))
        if number < rounds:
            live = out.filter("again").withColumn("part", F.expr(f"part div {fan_in}"))
    return done
