"""The k-center definitions, stated over plain lists for cross-checks."""

from itertools import combinations, count
from math import inf, sqrt


def dist(a, b):
    """Squares summed left to right, then the root."""
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += (x - y) * (x - y)
    return sqrt(total)


def fft(points, m):
    """(centers, weights): each next center is the earliest of the points that
    are farthest from all centers so far; a point belongs to the earliest of
    its nearest centers."""
    table = [[dist(p, q) for q in points] for p in points]
    centers = [0]
    while len(centers) < m:
        apart = [min(table[c][i] for c in centers) for i in range(len(points))]
        centers.append(apart.index(max(apart)))
    owners = [min(range(m), key=lambda t: (table[centers[t]][i], t)) for i in range(len(points))]
    return centers, [owners.count(t) for t in range(m)]


def cover(points, w, k, r, alpha):
    """(chosen, leftover weight) of k balls, heaviest first."""
    ball = lambda c, radius: {i for i, p in enumerate(points) if dist(points[c], p) <= radius}
    weight = lambda s: sum(w[i] for i in s)
    small = [ball(c, (1 + 2 * alpha) * r) for c in range(len(points))]
    left, chosen = set(range(len(points))), []
    for _ in range(k):
        worth = [weight(b & left) for b in small]
        if max(worth) > 0:
            chosen.append(worth.index(max(worth)))
            left -= ball(chosen[-1], (3 + 4 * alpha) * r)
    return chosen, weight(left)


def search(points, w, k, z, alpha):
    """(guesses up to the first feasible, its centers, its leftover)."""
    head = points[: k + z + 1]
    start = min((dist(a, b) for a, b in combinations(head, 2)), default=inf) / 2
    tried = []
    for g in count():
        tried.append((start * 2**g, *cover(points, w, k, start * 2**g, alpha)))
        if tried[-1][2] <= z:
            return [r for r, _, _ in tried], tried[-1][1], tried[-1][2]


def objective(points, centers, z):
    """The greatest nearest distance once the z farthest points are dropped
    (never fewer than one point)."""
    near = sorted(min(dist(p, c) for c in centers) for p in points)
    return near[max(len(near) - 1 - z, 0)]
