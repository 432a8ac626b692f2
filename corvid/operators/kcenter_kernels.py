"""Numpy kernels run inside Spark tasks by the k-center operators.

Each kernel works on one group that Spark has already partitioned (one
coreset part, or one bounded coreset) and is vectorised over points. All
distances are computed exactly like the column expressions in
``corvid.functions.vectors``: squared coordinate differences summed left to
right from 0.0, then the square root, so Spark-side and task-side distances
agree bit for bit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """``list<double>`` column -> (n, d) float64 matrix; sizes must agree."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    n = len(arr)
    if n == 0:
        return np.zeros((0, 0))
    lens = pc.list_value_length(arr).to_numpy(zero_copy_only=False)
    d = int(lens[0])
    if (lens != d).any():
        raise ValueError("points of different dimensions in one group")
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    X = flat.reshape(n, d)
    if np.isnan(X).any():
        raise ValueError("NaN coordinate")
    return X


def columns(X: np.ndarray) -> np.ndarray:
    """(d, n) copy of X: each coordinate contiguous, for the distance loops."""
    return np.ascontiguousarray(X.T)


def dist_to(XT: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of every point (columns of ``XT``, see ``columns``) to c.

    One contiguous pass per coordinate, in place, summing in coordinate
    order like the column expressions.
    """
    n = XT.shape[1]
    acc = np.zeros(n)
    tmp = np.empty(n)
    for j in range(XT.shape[0]):
        np.subtract(XT[j], c[j], out=tmp)
        np.multiply(tmp, tmp, out=tmp)
        acc += tmp
    return np.sqrt(acc, out=acc)


PAIR_CELLS = 1 << 15  # of a distance matrix at a time: they stay in the cache


def pairwise(X: np.ndarray, Y: np.ndarray, block: int | None = None) -> np.ndarray:
    """(len X, len Y) distance matrix, same summation order as ``dist_to``,
    built in row blocks so temporaries stay small."""
    XT, YT = columns(X), columns(Y)
    out = np.empty((X.shape[0], Y.shape[0]))
    block = block or max(1, PAIR_CELLS // max(1, Y.shape[0]))
    tmp = np.empty((min(block, X.shape[0]), Y.shape[0]))
    for lo in range(0, X.shape[0], block):
        hi = min(lo + block, X.shape[0])
        acc = out[lo:hi]
        acc[:] = 0.0
        t = tmp[: hi - lo]
        for j in range(XT.shape[0]):
            np.subtract(XT[j, lo:hi, None], YT[j][None, :], out=t)
            np.multiply(t, t, out=t)
            acc += t
        np.sqrt(acc, out=acc)
    return out


STRIP_CELLS = 1 << 18  # of a float32 matrix at a time
MANY = 32  # of so many cells one may be left unsettled before a strip is measured whole


def some_distances(X: np.ndarray, Y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the rows ``X[i]`` to ``Y[j]``, as ``pairwise`` has them."""
    out = np.empty(len(i))
    step = max(1, STRIP_CELLS // max(1, X.shape[1]))
    for lo in range(0, len(i), step):
        a, b = X[i[lo : lo + step]], Y[j[lo : lo + step]]
        acc = np.zeros(len(a))
        for k in range(X.shape[1]):
            t = a[:, k] - b[:, k]
            acc += t * t
        out[lo : lo + len(a)] = np.sqrt(acc)
    return out


class Squares:
    """Squared distances of ``X`` to ``Y`` as float32 matrix products, and how
    far they may lie from those of ``pairwise``: what they leave open is
    measured.

    ``|x|^2 + |y|^2 - 2xy``, one product of d + 2 coordinates, is off by less
    than ``(d + 8) u (|x| + |y|)^2`` in whatever order it is summed (u: float32's
    unit roundoff; the float64 sums of ``pairwise`` are off by far less); twice
    that is allowed for. Coordinates are scaled by a power of two, which
    rounds nothing, so that none overflows; the constant is for underflow.
    """

    def __init__(self, X: np.ndarray, Y: np.ndarray):
        most = max(float(np.abs(X).max(initial=0.0)), float(np.abs(Y).max(initial=0.0)))
        self.usable = len(X) > 0 and len(Y) > 0 and 1e-100 < most < 1e100
        self.X, self.Y = X, Y
        if not self.usable:
            return
        self.scale = 2.0 ** -np.ceil(np.log2(most))
        A, B = X * self.scale, Y * self.scale
        a, b = (A * A).sum(axis=1), (B * B).sum(axis=1)
        self.error = 2.0**-24 * 2 * (X.shape[1] + 8) * (np.sqrt(a) + np.sqrt(b.max())) ** 2 + 1e-30
        self.A = np.column_stack([-2 * A, a, np.ones(len(a))]).astype(np.float32)
        self.B = np.ascontiguousarray(np.column_stack([B, np.ones(len(b)), b]).T.astype(np.float32))

    def strips(self):
        """(first row, squared scaled distances of some rows to all of ``Y``),
        each strip in the place of the last one."""
        rows = min(len(self.X), max(1, STRIP_CELLS // len(self.Y)))
        d = np.empty((rows, len(self.Y)), np.float32)
        for lo in range(0, len(self.X), rows):
            some = self.A[lo : lo + rows]
            yield lo, np.matmul(some, self.B, out=d[: len(some)])


def within(X: np.ndarray, Y: np.ndarray, radius: float):
    """(first row, flags) of strips of rows of ``X``: which rows of ``Y`` have
    ``pairwise(X, Y) <= radius``."""
    squares = Squares(X, Y)
    if not squares.usable or not radius >= 0:
        for lo in range(0, len(X), 512):
            yield lo, pairwise(X[lo : lo + 512], Y) <= radius
        return
    limit = min(radius * squares.scale, 1e15) ** 2
    for lo, d in squares.strips():
        error = squares.error[lo : lo + len(d), None]
        inside = d <= (limit - error).astype(np.float32)
        i, j = np.divmod(np.flatnonzero((d <= (limit + error).astype(np.float32)) ^ inside), len(Y))
        if len(i) * MANY > d.size:
            inside = pairwise(X[lo : lo + len(d)], Y) <= radius
        else:
            inside[i, j] = some_distances(X, Y, i + lo, j) <= radius
        yield lo, inside


def nearest_rows(X: np.ndarray, Y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least distance, first row of ``Y`` that has it) of each row of ``X``, as
    ``pairwise`` has them. ``Y`` must not be empty."""
    least, at = np.empty(len(X)), np.zeros(len(X), np.int64)
    squares = Squares(X, Y)

    def measured(lo: int, hi: int) -> None:
        for low in range(lo, hi, 512):
            d = pairwise(X[low : min(hi, low + 512)], Y)
            least[low : low + len(d)], at[low : low + len(d)] = d.min(axis=1), d.argmin(axis=1)

    if not squares.usable:
        measured(0, len(X))
        return least, at
    for lo, d in squares.strips():
        # The nearest lies within two errors of the least; a little more for
        # the roundings of this sum.
        most = d.min(axis=1) + 2.5 * squares.error[lo : lo + len(d)]
        i, j = np.divmod(np.flatnonzero(d <= most.astype(np.float32)[:, None]), len(Y))
        if len(i) * MANY > max(d.size, MANY * MANY * len(d)):
            measured(lo, lo + len(d))
            continue
        exact = some_distances(X, Y, i + lo, j)
        first = np.searchsorted(i, np.arange(len(d)))  # every row has its least
        low = np.minimum.reduceat(exact, first)
        hit = np.flatnonzero(exact == low[i])
        row, where = np.unique(i[hit], return_index=True)
        least[lo : lo + len(d)] = low
        at[lo + row] = j[hit[where]]
    return least, at


def order_rows(key: np.ndarray, X: np.ndarray) -> np.ndarray:
    """Row order by ``key``; equal keys fall back to the coordinates."""
    idx = np.argsort(key, kind="stable")
    sk = key[idx]
    if len(sk) > 1 and (sk[1:] == sk[:-1]).any():
        cols = tuple(X[:, j] for j in reversed(range(X.shape[1])))
        idx = np.lexsort(cols + (key,))
    return idx


def farthest_first(
    X: np.ndarray, w: np.ndarray, m: int, cover: np.ndarray | float = 0.0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Farthest-first traversal to ``m`` centers, their weights and covers.

    Starts at row 0; each next center is the first row of greatest distance
    to the centers so far, or row 0 again when every row is already at
    distance 0 (too few distinct rows). A row's weight goes to its nearest
    center, the earliest one on ties, so repeated centers weigh 0. One
    distance pass per center gives both the traversal and the weights. A
    center's cover is a radius that holds all it stands for: the greatest
    distance to a row of its own plus that row's ``cover``.
    """
    n = X.shape[0]
    XT = columns(X)
    min_d = np.full(n, np.inf)
    owner = np.zeros(n, dtype=np.int64)
    centers = np.zeros(m, dtype=np.int64)
    for t in range(m):
        d = dist_to(XT, X[centers[t]])
        closer = d < min_d
        min_d[closer] = d[closer]
        owner[closer] = t
        if t + 1 < m:
            best = int(np.argmax(min_d))
            centers[t + 1] = best if min_d[best] > 0 else 0
    weights = np.bincount(owner, weights=w.astype(np.float64), minlength=m).astype(np.int64)
    covers = np.zeros(m)
    np.maximum.at(covers, owner, min_d + cover)
    return centers, weights, covers


def boxes(X: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) coordinates of the runs of rows that begin at ``first``."""
    return np.minimum.reduceat(X, first, axis=0), np.maximum.reduceat(X, first, axis=0)


def box_distances(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) distances that rows of boxes can have from rows of
    others, as matrices. Differences, squares, sums and roots are rounded
    monotonically and in the order of ``pairwise``, so that no distance it gives
    lies outside of them."""
    near, far = np.zeros((len(low), len(lows))), np.zeros((len(low), len(lows)))
    for j in range(low.shape[1]):
        ahead, behind = lows[:, j] - high[:, j, None], low[:, j, None] - highs[:, j]
        gap = np.maximum(np.maximum(ahead, behind), 0.0)
        near += gap * gap
        reach = np.maximum(highs[:, j] - low[:, j, None], high[:, j, None] - lows[:, j])
        far += reach * reach
    return np.sqrt(near), np.sqrt(far)


def spatial_order(X: np.ndarray, leaf: int) -> np.ndarray:
    """Row order in which every run of ``leaf`` rows (from the first on) lies
    together: halves along the axis of the widest spread, cut at multiples of
    ``leaf``."""
    order = np.arange(len(X))
    todo = [(0, len(X))]
    while todo:
        a, b = todo.pop()
        if b - a <= leaf:
            continue
        own = X[order[a:b]]
        axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        middle = (b - a + leaf) // (2 * leaf) * leaf
        order[a:b] = order[a:b][np.argpartition(own[:, axis], middle - 1)]
        todo += [(a, a + middle), (a + middle, b)]
    return order


FULL_ROWS = 4096  # up to here the distances are kept between steps and guesses
BLOCK_CELLS = 1 << 22


class Distances:
    """Rows of the distance matrix of one bounded set, block by block; small
    sets keep the whole matrix (the same numbers either way)."""

    def __init__(self, X: np.ndarray):
        self.X, self.n = X, X.shape[0]
        self.step = max(1, BLOCK_CELLS // max(1, self.n))
        self.full = pairwise(X, X) if self.n <= FULL_ROWS else None

    def blocks(self):
        """(first row, distances of some rows to all)."""
        for lo in range(0, self.n, self.step):
            hi = min(lo + self.step, self.n)
            yield lo, pairwise(self.X[lo:hi], self.X) if self.full is None else self.full[lo:hi]

    def row(self, i: int) -> np.ndarray:
        return pairwise(self.X[i : i + 1], self.X)[0] if self.full is None else self.full[i]


def greedy_cover(D: Distances, w: np.ndarray, k: int, r: float, alpha: float) -> tuple[list[int], int]:
    """Up to k greedy balls at guess r; returns chosen rows and leftover weight.

    Every row is a candidate; a candidate's ball counts uncovered weight
    within (1+2*alpha)*r; the heaviest ball wins, earliest row on ties; then
    everything within (3+4*alpha)*r of it is covered.
    """
    # Weights are integers; float64 sums of them stay exact below 2**53.
    near, far = (1 + 2 * alpha) * r, (3 + 4 * alpha) * r
    rest = w.astype(np.float64)
    chosen: list[int] = []
    while len(chosen) < k and rest.sum() > 0:
        heavy = np.concatenate([(d <= near) @ rest for _, d in D.blocks()])
        best = int(np.argmax(heavy))
        if heavy[best] <= 0:
            break
        chosen.append(best)
        rest = np.where(D.row(best) <= far, 0.0, rest)
    return chosen, int(rest.sum())


def first_radii(D: Distances, m: int) -> tuple[float, float | None]:
    """(half the least distance among the first ``m`` rows, half the least
    positive distance among them, else among all rows; None if all are equal)."""
    head = pairwise(D.X[:m], D.X[:m])[np.triu_indices(m, 1)]
    if not head.size:
        return 0.0, None
    some = head[head > 0]
    if not some.size:
        least = [float(d[d > 0].min()) for _, d in D.blocks() if (d > 0).any()]
        return 0.0, min(least) / 2 if least else None
    return float(head.min()) / 2, float(some.min()) / 2


def search_lane(
    X: np.ndarray, w: np.ndarray, k: int, z: int, alpha: float, lane: int, lanes: int
) -> list[tuple[int, float, list[int], int]]:
    """Every ``lanes``-th guess from ``lane`` on, to the first whose leftover
    weight is <= z: (guess number, radius, chosen rows, leftover).

    Guesses are r0, 2*r0, 4*r0, ...; a zero r0 is guess 0 alone, and guess 1
    is half the least positive distance. Radii end with the doubles: a ball of
    infinite radius covers everything, so some guess is feasible.
    """
    m = k + z + 1
    if k < 1 or z < 0:
        raise ValueError("need k >= 1 and z >= 0")
    if X.shape[0] < m:
        raise ValueError(f"need at least k+z+1 = {m} points, got {X.shape[0]}")
    D = Distances(X)
    r0, positive = first_radii(D, m)
    out = []
    number = lane
    while True:
        if r0 > 0:
            r = float(np.ldexp(r0, number))
        elif number == 0:
            r = 0.0
        elif positive is None:
            return out  # all rows are equal: guess 0 covers them
        else:
            r = float(np.ldexp(positive, number - 1))
        chosen, left = greedy_cover(D, w, k, r, alpha)
        out.append((number, r, chosen, left))
        if left <= z:
            return out
        number += lanes
