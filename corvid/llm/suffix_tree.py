"""Substring dedup over words by prefix-partitioned suffix trees.

Suffixes (of ``WIDTH`` words, all that matters here) are sampled at anchors
and split into memory-sized groups by prefixes of variable length: the
anchor's ``GRAM`` words, or all ``WIDTH`` where those are frequent (see
``repeats``). A group's suffixes are sorted by refining their order level by
level, which is the group's suffix tree, one level per doubling of the depth;
an internal node ``WIDTH`` words deep or more is a repeat, and its least
document keeps the words.

Words compare by their whole 64-bit hashes, each of the ``WIDTH`` by itself,
within windows that agree in the 64-bit hash of ``GRAM`` words.

Defined results: null text has no words; a document shorter than a window
stays whole; repeats within one document stay; rows that repeat an id count as
one document; rows with a null id stay whole; an empty table gives no rows;
further columns are ignored by ``cut_repeats`` and kept by ``drop_repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm import repeats
from corvid.llm.common import slices
from corvid.llm.shingles import Words, run_hashes, text_slices

WIDTH = 13
GRAM = 5


def _items(gram: int):
    def items(texts):
        for a, b in text_slices(texts):
            w = Words(texts[a:b])
            first = np.append(w.first, len(w.hashes))[: b - a + 1]
            yield a, b, repeats.Items(w.hashes, run_hashes(w.hashes, gram), first)

    return items


def _judge(width: int):
    def judge(codes, place, key, doc, start):
        """A window is repeated when its node holds a smaller document."""
        node = repeats.sequence_ranks(codes, width, place)
        order = np.lexsort((doc, key, node))
        same = (np.diff(node[order]) == 0) & (np.diff(key[order]) == 0)
        head = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(order)), 0))
        out = np.zeros(len(order), bool)
        out[order] = doc[order] > doc[order][head]
        return out

    return judge


def _method(width: int, gram: int) -> repeats.Method:
    return repeats.Method(width, gram, _items(gram), False, _judge(width))


def _kept(batch, width: int):
    """(words, removed, kept text) of each row of ``id, row, spans``."""
    texts, spans = repeats.text_of(batch.column(1)).to_pylist(), batch.column(2).to_pylist()
    for a, b in text_slices(texts):
        w = Words(texts[a:b])
        first = np.append(w.first, len(w.hashes))
        for i in range(a, b):
            lo, hi = int(first[i - a]), int(first[i - a + 1])
            gone = repeats.covered(hi - lo, spans[i], width)
            stay = np.flatnonzero(~gone) + lo
            kept = b" ".join([w.raw[s:e] for s, e in zip(w.starts[stay].tolist(), w.ends[stay].tolist(), strict=True)])
            yield hi - lo, int(gone.sum()), kept


def _with_spans(rows: DataFrame, width: int, gram: int, frequent: int, tasks: int | None) -> DataFrame:
    """``id, row`` with ``spans``; rows with a null id have none."""
    found = repeats.repeated_windows(rows.filter("id is not null"), _method(width, gram), np.uint64, frequent, tasks)
    none = rows.filter("id is null").withColumn("spans", F.lit(None).cast("array<struct<start:int,windows:int>>"))
    return found.unionByName(none).select("id", "row", "spans")


def _cut(docs: DataFrame, id_col: str, text_col: str, width: int, gram: int, frequent: int, tasks) -> DataFrame:
    """-> ``id, n_words, n_removed, kept, kept_sha256, rest``: ``rest`` holds
    the whole row but the text."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.struct(
            F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest")
        ).alias("row"),
    )
    names = ["id", "n_words", "n_removed", "kept", "kept_sha256", "rest"]

    def run(batches):
        for batch in slices(batches):
            n, gone, kept, sha = [], [], [], []
            for (a, b, c), text in zip(_kept(batch, width), repeats.text_of(batch.column(1)), strict=True):
                n.append(a), gone.append(b), sha.append(hashlib.sha256(c).hexdigest())
                kept.append(c.decode("utf-8", "replace") if b else text.as_py())
            columns = [
                batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
                pa.array(sha, pa.string()), pc.struct_field(batch.column(1), "rest"),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rest = rows.schema["row"].dataType["rest"].dataType
    fields = "id long, n_words long, n_removed long, kept string, kept_sha256 string"
    schema = T.StructType.fromDDL(fields).add("rest", rest)
    return _with_spans(rows, width, gram, frequent, tasks).mapInArrow(run, schema)


def cut_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM,
    frequent: int = repeats.FREQUENT, tasks: int | None = None,
) -> DataFrame:
    """-> ``<id_col>, n_words, n_removed, kept`` (the words that stay, joined
    by one space; the text itself where all do)``, kept_sha256`` (of the words
    joined)."""
    cut = _cut(docs.select(id_col, text_col), id_col, text_col, width, gram, frequent, tasks)
    return cut.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept", "kept_sha256")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated words taken out of the texts, all rows and
    columns kept; ``n_chars``, where it is a column, counts the new text."""
    cut = _cut(docs, id_col, text_col, WIDTH, GRAM, repeats.FREQUENT, None)
    kept = lambda c: F.col("kept") if c == text_col else F.col(f"rest.`{c}`")
    count = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("rest.n_chars")) if "n_chars" in docs.columns else None
    return cut.select(
        *[(count.cast(docs.schema[c].dataType) if c == "n_chars" else kept(c)).alias(c) for c in docs.columns]
    )
