"""Substring dedup over bytes by longest-previous-factor arrays.

Contexts of repeated anchors are grouped (see ``repeats``); a group's bytes are
put in suffix order, and for each suffix the previous and the next one with a
smaller corpus position (document, start) are found. One of the two has the
longest match that starts earlier, so a place is a later copy when either
shares ``WIDTH`` bytes with it. The first occurrence stays.

Defined results: null text has no bytes; a text shorter than a window stays
whole; rows that repeat an id stand at the same position, so they are no
copies of each other; rows with a null id stay whole; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm import repeats
from corvid.llm.shingles import gram_hashes, text_slices

WIDTH = 100
GRAM = 20


def _items(gram: int):
    def items(texts):
        for a, b in text_slices(texts):
            parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts[a:b]]
            raw = b"".join(parts)
            first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            yield a, b, repeats.Items(np.frombuffer(raw, np.uint8), gram_hashes(raw, gram), first)

    return items


def smaller_before(position: np.ndarray) -> np.ndarray:
    """For each place of a sequence the nearest earlier place with a strictly
    smaller value, or -1: all places jump along the others' answers so far."""
    at = np.arange(len(position)) - 1
    live = np.flatnonzero(at >= 0)
    live = live[position[at[live]] >= position[live]]
    while len(live):
        at[live] = at[at[live]]
        live = live[at[live] >= 0]
        live = live[position[at[live]] >= position[live]]
    return at


def _judge(width: int):
    def judge(codes, place, key, doc, start):
        """LPF >= width, by previous and next smaller positions in suffix order."""
        rank = repeats.sequence_ranks(codes, width, place)
        docs, d = np.unique(doc, return_inverse=True)
        position = (d.astype(np.int64) << 40) + start
        order = np.lexsort((position, rank))
        p, r = position[order], rank[order]
        before = smaller_before(p)
        after = len(p) - 1 - smaller_before(p[::-1])[::-1]
        copy = (before >= 0) & (r[before] == r)
        there = after < len(p)
        copy |= there & (r[np.where(there, after, 0)] == r)
        out = np.zeros(len(order), bool)
        out[order] = copy
        return out

    return judge


def _spans(docs, id_col, text_col, width, gram, frequent, tasks):
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.struct(F.col(text_col).alias("text")).alias("row"))
    method = repeats.Method(width, gram, _items(gram), True, _judge(width))
    found = repeats.repeated_windows(rows.filter("id is not null"), method, np.uint8, frequent, tasks)
    none = rows.filter("id is null").withColumn("spans", F.lit(None).cast("array<struct<start:int,windows:int>>"))
    return found.unionByName(none).select("id", "row", "spans")


def cut_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM,
    frequent: int = repeats.FREQUENT, tasks: int | None = None,
) -> DataFrame:
    """-> ``<id_col>, n_bytes, n_removed, removed`` (maximal runs: from, to)
    ``, kept`` (the bytes that stay)``, kept_sha256``."""

    def run(batches):
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for text, spans in zip(repeats.text_of(batch.column(1)).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                gone = repeats.covered(len(raw), spans, width)
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                runs = [{"from": int(a), "to": int(b)} for a, b in zip(edge[0::2], edge[1::2], strict=True)]
                row = (len(raw), int(gone.sum()), runs, kept, hashlib.sha256(kept).hexdigest())
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            span = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
            kinds = (pa.int64(), pa.int64(), span, pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                names=[id_col, "n_bytes", "n_removed", "removed", "kept", "kept_sha256"],
            )

    return _spans(docs, id_col, text_col, width, gram, frequent, tasks).mapInArrow(
        run,
        f"`{id_col}` long, n_bytes long, n_removed long, removed array<struct<from:int,to:int>>, kept binary,"
        " kept_sha256 string",
    )
