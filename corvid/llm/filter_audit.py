"""How document filters overlap, for every order they can be applied in.

Each document is judged once: five filters make a five-bit mask of its
failures. Documents are counted by part, mask and label, so whatever the table's
size a part is at most 32 masks x 4 label pairs. A Gray-code walk then visits
all 32 subsets of filters, toggling one filter at a time: every mask cell keeps
a counter of the active filters it fails, and the running survivors change by
the cells whose counter leaves or reaches zero. The states of the 32 subsets
are stored; a step of any order is the difference of two of them.

The filters: A under 200 words; B fewer than half of the words distinct; C more
than 3 % of the characters ``A-Z``; D holds one of ``#$%&*|``; E the text is
identical to that of a smaller document id anywhere in the table. Texts are
compared by their SHA-256. Words are maximal runs of characters other than
blanks and ``\\x09-\\x0D``, case-sensitive.

No step gathers a group: copies are counted by (digest, id), then the least id
and its rows per digest are partially aggregated, so a text that a third of all
documents share spreads by id first.

Defined results: null text is empty (it fails A only, and E after the first);
null language is the part ``''``; a null id fails no E and has no label; rows
that repeat an id are documents of their own, no copies of each other under E
(the id is not smaller), and a repeated label counts if any of its rows is 1;
null labels count as 0; very long texts are split in slices, so memory is their
distinct words; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The filters' thresholds.
FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
MARKS = re.compile(rb"[#$%&*|]")

SLICE = 1 << 20
NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
CONTINUATION = bytes(range(0x80, 0xC0))
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _slices(raw: bytes) -> Iterator[bytes]:
    """``raw`` in slices that end at a blank, so that no word is cut."""
    at = 0
    while len(raw) - at > SLICE:
        cut = BLANK.search(raw, at + SLICE)
        if not cut:
            break
        yield raw[at : cut.end()]
        at = cut.end()
    yield raw[at:] if at else raw


def failures(raw: bytes) -> int:
    """Bits 0-3: filters A-D that the UTF-8 text fails."""
    n, seen = 0, set()
    for part in _slices(raw):
        words = part.split()  # bytes split at ASCII white space: \x20, \x09-\x0D
        n += len(words)
        seen.update(words)
    upper = len(raw.translate(None, NOT_UPPER))
    chars = len(raw.translate(None, CONTINUATION))
    return (
        (n < LEAST_WORDS)
        | (100 * len(seen) < DISTINCT_PERCENT * n) << 1
        | (100 * upper > UPPER_PERCENT * chars) << 2
        | bool(MARKS.search(raw)) << 3
    )


def judged(docs: DataFrame) -> DataFrame:
    """-> ``doc_id, part, mask, digest``: one pass over the texts."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"),
    )

    def run(batches):
        for batch in batches:
            masks, digests = [], []
            for value in batch.column(2):
                raw = value.as_py()
                masks.append(failures(raw))
                digests.append(hashlib.sha256(raw).digest())
            columns = [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "mask", "digest"])

    return rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """-> ``part, mask, good, toxic, n``: documents by mask (with E) and label."""
    wanted = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    # Repeated ids are counted first: what is joined has one row a key.
    ids = judged(docs).groupBy("digest", "mask", "part", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0)
    tagged = ids.join(wanted, "doc_id", "left").withColumns(
        {"good": F.coalesce("good", none), "toxic": F.coalesce("toxic", none)}
    )
    kinds = tagged.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
    )
    # A digest has few kinds (its mask is its text's): parts x 4.
    texts = kinds.groupBy("digest").agg(
        F.min("first.doc_id").alias("least"),
        F.collect_list(F.struct("mask", "part", "good", "toxic", "n", "no_id", "first")).alias("kinds"),
    )
    each = texts.select("least", F.explode("kinds").alias("k")).select("least", "k.*")
    owns = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = each.withColumn("fresh", F.col("no_id") + owns)
    e = 1 << FILTERS.index("E")
    either = F.explode(
        F.array(
            F.struct(F.col("mask").alias("m"), F.col("fresh").alias("c")),
            F.struct((F.col("mask") + e).alias("m"), (F.col("n") - F.col("fresh")).alias("c")),
        )
    ).alias("x")
    return (
        split.select("part", "good", "toxic", either)
        .groupBy("part", F.col("x.m").alias("mask"), "good", "toxic")
        .agg(F.sum("x.c").cast("long").alias("n"))
    )


def gray_walk(counts: list[tuple[int, tuple[int, ...]]], filters: int) -> list[tuple[int, ...]]:
    """Survivors of every subset of the filters. ``counts``: per mask cell the
    numbers to add up (documents, good ones, toxic ones)."""
    kept = [sum(column) for column in zip(*(n for _, n in counts), strict=True)]
    states = [tuple(kept)] * (1 << filters)
    failing = [0] * len(counts)
    active = 0
    for step in range(1, 1 << filters):
        bit = step & -step
        active ^= bit
        sign = 1 if active & bit else -1
        for cell, (mask, numbers) in enumerate(counts):
            if mask & bit:
                before, failing[cell] = failing[cell], failing[cell] + sign
                if not before or not failing[cell]:
                    kept = [k - sign * n for k, n in zip(kept, numbers, strict=True)]
        states[active] = tuple(kept)
    return states


OUTPUT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def _orders(pdf: pd.DataFrame) -> pd.DataFrame:
    by_mask: dict[int, list[int]] = {}
    for mask, good, toxic, n in zip(pdf["mask"], pdf["good"], pdf["toxic"], pdf["n"], strict=True):
        cell = by_mask.setdefault(int(mask), [0, 0, 0])
        cell[0] += int(n)
        cell[1] += int(n) * int(good)
        cell[2] += int(n) * int(toxic)
    counts = [(mask, tuple(n)) for mask, n in by_mask.items()]
    states = gray_walk(counts, len(FILTERS))
    fails = [sum(n[0] for mask, n in counts if mask >> i & 1) for i in range(len(FILTERS))]
    alone = [by_mask.get(1 << i, [0])[0] for i in range(len(FILTERS))]
    rows, shapley = [], [0] * len(FILTERS)
    for order in permutations(range(len(FILTERS))):
        name, subset = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            before, subset = states[subset], subset | 1 << i
            removed, good, toxic = (b - a for b, a in zip(before, states[subset], strict=True))
            shapley[i] += removed
            rows.append((name, step, states[subset][0], removed, fails[i] - removed, alone[i], good, toxic, i))
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "filter"]
    out = pd.DataFrame(rows, columns=names)
    out.insert(0, "part", pdf["part"].iloc[0])
    out["shapley"] = out.pop("filter").map(shapley.__getitem__)
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """-> 600 rows a part: 120 orders of 5 steps."""
    return cells(docs, labels).groupBy("part").applyInPandas(_orders, OUTPUT)
