"""Term counts of many texts at once, by length-bucketed packing.

Terms are cut out of a chunk of texts with byte tables, without a loop over rows
or terms. A term of up to 8 bytes is one uint64 word, one of up to 16 bytes two;
these are radix-sorted (least significant 16-bit digits first) and equal runs
counted. Longer terms go to separate buckets, one for each power of two of their
width, sorted as bytes. UTF-8 has no zero byte inside a term, so the zeros
that fill up a word never make two terms equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Term bytes are A-Z, a-z and all of UTF-8 beyond ASCII.
TERM = np.zeros(256, bool)
TERM[65:91] = TERM[97:123] = TERM[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

WORD = 8
MASK = np.array([(1 << 8 * k) - 1 for k in range(WORD)] + [(1 << 64) - 1], np.uint64)


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the terms of the texts ``data[bounds[i]:bounds[i + 1]]``."""
    inside = TERM[data]
    before, behind = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], behind[:-1] = inside[:-1], inside[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    before[inner] = False  # no term crosses the end of a text
    behind[inner - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~behind) + 1 - starts


def radix_order(words: np.ndarray) -> np.ndarray:
    """A stable order of the rows of (n, k) uint64 ``words`` that puts equal
    rows side by side: one counting pass per 16-bit digit that varies."""
    digits = np.ascontiguousarray(words).view(np.uint16).reshape(len(words), -1)
    order = None
    for d in range(digits.shape[1]):
        digit = np.ascontiguousarray(digits[:, d])
        if len(digit) and (digit != digit[0]).any():
            if order is None:
                order = np.argsort(digit, kind="stable")
            else:
                order = order[np.argsort(digit[order], kind="stable")]
    return np.arange(len(words)) if order is None else order


def _packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, words: int) -> np.ndarray:
    """(n, words) uint64: the bytes of each term, zeros behind."""
    eights = np.ndarray((len(data) - WORD + 1,), np.uint64, buffer=data, strides=(1,))
    out = np.empty((len(starts), words), np.uint64)
    for w in range(words):
        out[:, w] = eights[starts + WORD * w] & MASK[np.clip(lengths - WORD * w, 0, WORD)]
    return out


def buckets(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of a bucket, their terms as (n, width) bytes in sorted order, the
    rows in that order). ``data`` must have 2 * ``WORD`` spare bytes behind."""
    for words in (1, 2):
        rows = np.flatnonzero((lengths > WORD * (words - 1)) & (lengths <= WORD * words))
        if len(rows):
            packed = _packed(data, starts[rows], lengths[rows], words)
            order = radix_order(packed)
            yield rows[order], packed[order].view(np.uint8).reshape(len(rows), -1)
    width = 4 * WORD
    while (lengths > width // 2).any():
        rows = np.flatnonzero((lengths > width // 2) & (lengths <= width))
        if len(rows):
            filled = np.zeros((len(rows), width), np.uint8)
            for i, r in enumerate(rows.tolist()):
                filled[i, : lengths[r]] = data[starts[r] : starts[r] + lengths[r]]
            order = np.argsort(filled.view(f"S{width}").ravel(), kind="stable")
            yield rows[order], filled[order]
        width *= 2


def _strings(filled: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Rows of zero-filled bytes as strings of the given lengths."""
    chars = filled[np.arange(filled.shape[1]) < lengths[:, None]]
    ends = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(ends), pa.py_buffer(chars))


def counted(data: np.ndarray, bounds: np.ndarray, groups: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Term counts of a chunk of texts -> batches of ``group, term, n, docs``.

    ``groups[i]`` is the group of text ``i`` and does not fall, so the texts of
    a group lie side by side and one sort by term serves both counts.
    """
    starts, lengths = spans(data, bounds)
    text = np.searchsorted(bounds[1:], starts, side="right").astype(np.int32)
    low = np.zeros(len(data) + 3 * WORD, np.uint8)
    np.take(LOWER, data, out=low[: len(data)])
    for rows, terms in buckets(low, starts, lengths):
        t, g = text[rows], groups[text[rows]]
        wide = terms.view(np.uint64)
        other = (wide[1:] != wide[:-1]).any(axis=1)
        head = np.concatenate([[True], other | (g[1:] != g[:-1])])
        first = np.concatenate([[True], other | (t[1:] != t[:-1])])
        at = np.flatnonzero(head)
        columns = [
            pa.array(g[at]),
            _strings(terms[at], lengths[rows[at]]),
            pa.array(np.diff(np.append(at, len(rows)))),
            pa.array(np.add.reduceat(first.astype(np.int64), at)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["group", "term", "n", "docs"])


def of_one_text(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The counts of the slices of one text as those of the text."""
    table = pa.Table.from_batches(batches).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "max")])
    columns = [table[c].combine_chunks() for c in ("group", "term", "n_sum", "docs_max")]
    return pa.RecordBatch.from_arrays(columns, names=["group", "term", "n", "docs"])
