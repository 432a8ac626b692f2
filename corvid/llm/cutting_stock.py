"""Packing as a cutting-stock problem, solved by column generation.

Documents become ids; one of over ``capacity`` ids is cut into full pieces, each
a sequence of its own, and a rest. The rests are counted by length class
(``WIDTH`` ids wide, rounded up), a histogram of at most ``capacity / WIDTH`` rows
whatever the table's size. Over it a linear program chooses how often to use
each pattern (how many pieces of each class share a sequence): the simplex
method keeps a basis of patterns, and a knapsack dynamic program over the
capacity prices the next one until no pattern has a gain. Multiples are
rounded down, then up as long as the histogram has pieces, and the rest is
solved again.

Pieces are ranked within their class (a class is dealt to buckets by hash and
the buckets' ranks are offset, so no class is one task), and each pattern takes
the next ranks of its classes. Pieces that no pattern of little room takes (what
rounding leaves, or lengths that do not combine) are laid end to end, bucket by
bucket, and cut at the capacity; a bucket's last sequence is cut into powers of
two, which need no padding.

Ids are not shuffled: pieces carry lengths and checksums. Only the documents
cut that way are read and encoded again, for the checksums of their cuts.

Defined results: null and empty texts are the end id alone; repeated rows are
documents of their own (rows equal in id, length and checksum are alike); null
ids are kept; very long texts become full pieces; ties in rank are broken by
the row number of the written table; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import once_a_process, staged
from corvid.llm.word_ids import WordIds

END_ID = 1
CAPACITY = 2048
WIDTH = 2
SPARE = 12  # patterns leave no more room: what else is left is cut
BUCKET_ROWS = 100_000
ROUNDS = 6
GAP = 0.0005  # the linear program ends this close to its bound, or after
STEPS = 4  # pivots per class

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _encoded(docs: DataFrame, path: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Pieces of every document; ``with_ids`` adds the raw ids."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    )
    end = array("I", [end_id]).tobytes()

    def run(batches):
        words = once_a_process(("word ids", path), lambda: WordIds(path))
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                owner, out, ids = [], [], []
                for i, value in enumerate(part.column(1)):
                    raw = words.encode(value.as_py()) + end
                    n = len(raw) // 4
                    for start in range(0, n, capacity):
                        cut = raw[4 * start : 4 * (start + capacity)]
                        owner.append(i)
                        out.append((start, len(cut) // 4, zlib.crc32(cut), n))
                        if with_ids:
                            ids.append(cut)
                columns = [part.column(0).take(pa.array(owner, pa.int32()))]
                columns += [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return rows.mapInArrow(run, PIECES + ", ids binary" * with_ids)


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """(value, copies of each item) of the best filling: dynamic program over
    the room used so far. ``sizes`` rise."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for room in range(int(sizes[0]), capacity + 1):
        fit = np.searchsorted(sizes, room, side="right")
        gain = best[room - sizes[:fit]] + values[:fit]
        i = int(gain.argmax())
        if gain[i] > best[room - 1]:
            best[room], took[room] = gain[i], i
        else:
            best[room] = best[room - 1]
    copies = np.zeros(len(sizes), np.int64)
    room = capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            copies[took[room]] += 1
            room -= int(sizes[took[room]])
    return float(best[capacity]), copies


def first_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, their multiples): each pattern is filled with the
    largest classes that are left and used until one of them is out. No later
    pattern has that class, so the matrix is triangular up to order."""
    left, columns, times = demand.astype(float), [], []
    open_ = np.ones(len(sizes), bool)
    while open_.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        have = np.flatnonzero(open_)
        while room:
            fit = np.searchsorted(sizes[have], room, side="right")
            if not fit:
                break
            take = have[fit - 1]
            copies = room // int(sizes[take])
            pattern[take] += copies
            room -= copies * int(sizes[take])
            have = have[: fit - 1]
        uses = np.flatnonzero(pattern)
        ratio = left[uses] / pattern[uses]
        out = uses[int(ratio.argmin())]
        times.append(ratio.min())
        left = np.maximum(left - ratio.min() * pattern, 0)
        left[out], open_[out] = 0, False
        columns.append(pattern)
    return np.array(columns).T.astype(float), np.array(times)


def generate(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(patterns as columns, their multiples, lower bound of the number of
    sequences) of the linear program's solution over sizes that rise."""
    m = len(sizes)
    basis, x = first_basis(sizes, demand, capacity)
    inverse = np.linalg.inv(basis)
    bound = float(sizes @ demand) / capacity
    if x.sum() <= bound * (1 + GAP):
        return basis.astype(np.int64), x, bound
    for step in range(STEPS * m):
        prices = inverse.sum(axis=0)
        value, pattern = knapsack(np.maximum(prices, 0), sizes, capacity)
        bound = max(bound, float(prices.clip(0) @ demand) / max(value, 1.0))
        if value <= 1 + 1e-9 or x.sum() <= bound * (1 + GAP):
            break
        uses = np.flatnonzero(pattern)
        change = (inverse[:, uses] * pattern[uses]).sum(axis=1)
        ratio = np.where(change > 1e-9, x / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        x = np.maximum(x - ratio[out] * change, 0)
        x[out] = ratio[out]
        basis[:, out] = pattern
        if step % 200 == 199:
            inverse = np.linalg.inv(basis)
        else:
            row = inverse[out] / change[out]
            inverse -= np.outer(change, row)
            inverse[out] = row
    return basis.astype(np.int64), x, bound


def patterns_for(sizes: np.ndarray, demand: np.ndarray, capacity: int, spare: int) -> list[tuple[np.ndarray, int]]:
    """(pattern, times) with whole times; no class is used beyond its demand
    and no pattern leaves more than ``spare`` room."""
    left, chosen = demand.astype(np.int64).copy(), []
    for _ in range(ROUNDS):
        have = np.flatnonzero(left)
        if not len(have):
            break
        basis, x, _ = generate(sizes[have], left[have].astype(float), capacity)
        good = np.flatnonzero(capacity - sizes[have] @ basis <= spare)
        good = good[np.argsort(np.floor(x[good]) - x[good], kind="stable")]
        before = len(chosen)
        for once_more in (False, True):  # whole multiples, then what is left of them
            for k in good.tolist():
                pattern = np.zeros_like(left)
                pattern[have] = basis[:, k]
                uses = pattern > 0
                wish = 1 if once_more else int(np.floor(x[k] + 1e-9))
                times = min(wish, int((left[uses] // pattern[uses]).min()))
                if times:
                    left -= times * pattern
                    chosen.append((pattern, times))
        if len(chosen) == before:
            break
    return chosen


PLAN = "kind int, low long, high long, each long, sequence long"
NO_RANK = 2**62


def _plan(kinds: list[int], chosen: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """Rows of ``PLAN``: the ranks of a class that a pattern takes, pieces in a
    sequence and the pattern's first sequence; -1 for the ranks left over."""
    taken = [0] * len(kinds)
    rows, sequence = [], 0
    for pattern, times in chosen:
        for c in np.flatnonzero(pattern).tolist():
            first, each = taken[c], int(pattern[c])
            taken[c] = first + each * times
            rows.append((kinds[c], first, taken[c], each, sequence))
        sequence += times
    return rows + [(kind, t, NO_RANK, 1, -1) for kind, t in zip(kinds, taken, strict=True)]


def tail_cuts(total: int, capacity: int) -> list[int]:
    """Lengths of the sequences that hold ``total`` ids without padding."""
    last = total % capacity
    return [capacity] * (total // capacity) + [1 << b for b in reversed(range(last.bit_length())) if last >> b & 1]


CUTS = "row long, at long, length long, sequence_id long, offset long"


def _lay(capacity: int):
    """Pieces end to end, cut where sequences end."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row"], ascending=[False, True])
        ends = np.cumsum(pdf["length"].to_numpy())
        walls = np.cumsum(tail_cuts(int(ends[-1]), capacity))
        first = (int(pdf["bucket"].iloc[0]) + 1) << 40  # beyond the patterns' numbers
        rows, s, at = [], 0, 0
        for row, end in zip(pdf["row"].tolist(), ends.tolist(), strict=True):
            begin = at
            while at < end:
                stop = min(end, int(walls[s]))
                low = int(walls[s - 1]) if s else 0
                rows.append((row, at - begin, stop - at, first + s, at - low))
                at = stop
                s += at == walls[s]
        return pd.DataFrame(rows, columns=["row", "at", "length", "sequence_id", "offset"])

    return run


PIECE_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
OUTPUT = (*PIECE_COLUMNS, "sequence_id", "offset")


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, width: int = WIDTH, spare: int = SPARE
) -> DataFrame:
    """-> one row a piece: ``OUTPUT``."""
    cut = _encoded(docs, path, capacity, end_id)
    pieces = staged(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    zero = F.lit(0).cast("long")
    full = pieces.filter(F.col("length") == capacity).select(
        *PIECE_COLUMNS, (-1 - F.col("row")).alias("sequence_id"), zero.alias("offset")
    )
    rests = pieces.filter(F.col("length") < capacity).withColumn("kind", F.ceil(F.col("length") / F.lit(width)).cast("int"))

    histogram = {r["kind"]: r["n"] for r in rests.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not histogram:
        return full
    kinds = sorted(histogram)
    demand = np.array([histogram[k] for k in kinds], np.int64)
    chosen = patterns_for(np.array(kinds, np.int64), demand, capacity // width, spare // width)
    # Some rows a class, whatever the table's size.
    plan = docs.sparkSession.createDataFrame(_plan(kinds, chosen), PLAN)

    buckets = int(-(-demand.sum() // BUCKET_ROWS))
    dealt = rests.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("kind").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("kind", "bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("kind", "bucket", F.coalesce(F.sum("n").over(before), zero).alias("skip"))
    place = F.row_number().over(Window.partitionBy("kind", "bucket").orderBy("row")) - 1
    ranked = dealt.withColumn("place", place).join(offsets, ["kind", "bucket"]).withColumn("rank", F.col("skip") + F.col("place"))
    in_range = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = staged(
        ranked.join(F.broadcast(plan), "kind").filter(in_range).select(
            "row", "bucket", *PIECE_COLUMNS,
            F.when(F.col("sequence") >= 0, F.col("sequence") + F.expr("(rank - low) div each")).alias("sequence_id"),
        ),
        "placed",
    )
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row").rowsBetween(Window.unboundedPreceding, -1)
    packed = placed.filter(F.col("sequence_id").isNotNull()).withColumn("offset", F.coalesce(F.sum("length").over(earlier), zero))
    rest = placed.filter(F.col("sequence_id").isNull()).drop("sequence_id")
    return full.unionByName(packed.select(*OUTPUT)).unionByName(_rest_pieces(docs, rest, path, capacity, end_id))


def _rest_pieces(docs: DataFrame, rest: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces that no pattern takes, bucket by bucket end to end."""
    laid = rest.select("row", "bucket", "length").groupBy("bucket").applyInPandas(_lay(capacity), CUTS)
    whole = staged(rest.withColumnRenamed("length", "piece_length").join(laid, "row"), "rest_cuts")
    uncut = whole.filter(F.col("length") == F.col("piece_length")).select(*OUTPUT)
    parts = whole.filter(F.col("length") < F.col("piece_length"))
    # The texts of cut documents are encoded again for the checksums.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = parts.select(F.col("doc_id").alias("cut_id")).distinct()
    again = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("cut_id")), "left_semi")
    key = ["doc_id", "start", "piece_length", "ids_crc32", "doc_tokens"]
    ids = _encoded(again, path, capacity, end_id, with_ids=True).withColumnRenamed("length", "piece_length")
    alike = reduce(and_, (F.col(f"p.{c}").eqNullSafe(F.col(f"i.{c}")) for c in key))
    joined = parts.alias("p").join(ids.dropDuplicates(key).alias("i"), alike)
    raw = F.substring(F.col("i.ids"), (F.col("p.at") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    made = joined.select(
        F.col("p.doc_id"), (F.col("p.start") + F.col("p.at")).alias("start"), F.col("p.length"),
        F.crc32(raw).alias("ids_crc32"), F.col("p.doc_tokens"), F.col("p.sequence_id"), F.col("p.offset"),
    )
    return uncut.unionByName(made)
