"""Words and their hashes over a batch of texts, in numpy.

A word is a run of bytes other than space and 0x09-0x0D; in UTF-8 that is the
same as a run of such characters.
"""

from __future__ import annotations

import hashlib

import numpy as np

from corvid.llm.common import once_a_process

_U = np.uint64
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Odd 64-bit multipliers.
_BASE = _U(0x9E3779B97F4A7C15)
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = (x ^ (x >> _U(30))) * _MIX[0]
    x = (x ^ (x >> _U(27))) * _MIX[1]
    return x ^ (x >> _U(31))


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * _BASE)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for texts of up to ``n`` bytes
    (or more: one pair of arrays is kept, the longest asked for)."""
    kept = once_a_process("powers", dict)
    if kept.get("n", -1) < n:
        kept.clear()
        kept.update(n=n, pair=_make_powers(n))
    return kept["pair"]


def _make_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = _U(pow(int(_BASE), -1, 1 << 64))
    one = np.ones(1, _U)
    up = np.concatenate([one, np.cumprod(np.full(n, _BASE, _U))])
    down = np.concatenate([one, np.cumprod(np.full(n, inverse, _U))])
    return up, down


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``raw``."""
    word = ~_SPACES[np.frombuffer(raw, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    return edge[0::2], edge[1::2]


_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], _U)
LONG_SPAN = 256


def span_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans: equal for equal bytes wherever they
    stand. A span is folded 8 bytes at a time, each block through the finaliser
    (no polynomial, whose collisions periodic texts would meet); spans of over
    ``LONG_SPAN`` bytes are digested whole."""
    data = np.frombuffer(raw + bytes(8), np.uint8)
    eights = np.ndarray((len(data) - 7,), _U, buffer=data, strides=(1,))
    size = ends - starts
    out = mix(size.astype(_U) * _BASE + _U(1))
    short = size <= LONG_SPAN
    rows, at = np.flatnonzero(short & (size > 0)), 0
    while len(rows):
        left = size[rows] - at
        block = eights[starts[rows] + at] & _LOW_BYTES[np.minimum(left, 8)]
        out[rows] = mix((out[rows] ^ block) * _BASE + (block >> _U(32)))
        rows, at = rows[left > 8], at + 8
    for i in np.flatnonzero(~short).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def gram_hashes(raw: bytes, k: int) -> np.ndarray:
    """64-bit hashes of each ``k`` consecutive bytes, by slices (a polynomial over
    prefix sums, shifted back; what agrees in it is compared byte by byte)."""
    n = len(raw) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    up, down = _powers(1 << max(12, len(raw).bit_length()))
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(_byte_values()[np.frombuffer(raw, np.uint8)] * up[: len(raw)], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[:n]
    h ^= h >> _U(29)
    h *= _MIX[0]
    h ^= h >> _U(32)
    return h


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive items (``len - k + 1`` of them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for j in range(k):
        out = out * _BASE + hashes[j : j + n]
    return mix(out + _U(k))


class Words:
    """The words of several texts: ``hashes``, and ``first[i]:first[i + 1]``
    are those of text ``i``."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        raw = b"\n".join(parts)
        if lower:
            raw = raw.translate(LOWER)
        self.raw = raw
        lengths = np.array([len(p) + 1 for p in parts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(lengths)])[: len(parts) + 1]
        self.starts, self.ends = word_spans(raw)
        self.hashes = span_hashes(raw, self.starts, self.ends) if len(self.starts) else np.zeros(0, _U)
        self.first = np.searchsorted(self.starts, self.begin)


def text_slices(texts: list[str | None], most: int = 1 << 18):
    """(from, to) ranges of texts with about ``most`` characters (or one text)."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > most:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)
