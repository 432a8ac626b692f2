"""Greedy balls over a weighted set too large for one task.

State is kept by block (``blocks.near_packed``: rows that lie together): for
every candidate row the weight of its ball at each radius guess, and for every
row which guesses still leave it uncovered. Weights are made once from the
blocks' boxes and from pairs of blocks: a block wholly within the balls of all
rows of another adds its weight as a whole, one beyond them all adds nothing,
and only pairs that a ball's edge may cut are compared, leaf by leaf in the same
way (``_ball_weights``), then row by row. A step then takes
the heaviest candidate of each guess (a partially aggregated maximum), covers
what lies near it, and only the newly covered rows are subtracted from the
candidates; so over all steps a row is compared twice for each
guess at most. Each state is checkpointed: a lost executor costs one step.

The driver sees one row per guess and step (the center chosen) and of each block
its box and its newly covered weight, never rows of the set.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import blocks as bl
from corvid.operators import kcenter_kernels as kk
from corvid.session import materialised

STATE = bl.BLOCK + ", heavy binary, fresh binary"
PARTIAL = "block long, change binary"
STRIP_BLOCKS = 256  # blocks whose box distances the driver holds at a time


@dataclass
class Guess:
    """One radius and what was chosen for it."""

    number: int
    r: float
    left: int
    orders: list[int] = field(default_factory=list)
    ids: list[int] = field(default_factory=list)
    vectors: list[list[float]] = field(default_factory=list)
    open: bool = True


def _ball_weights(near: list[float]):
    """Per pair of blocks: weights of the right block's fresh rows within each
    left row's balls, of the pair's guesses."""

    def run(pair: dict) -> list[dict]:
        a, b = bl.block_of(pair["left"]), bl.block_of(pair["right"])
        guesses = pair["guesses"]
        fresh = np.frombuffer(pair["right"]["fresh"], bool).reshape(len(b.w), len(near))[:, guesses]
        some = np.flatnonzero(fresh.any(axis=1))
        if not len(some):
            return []
        # Weights are integers; float64 sums of them stay exact below 2**53.
        X, w = b.X[some], np.where(fresh[some], b.w[some, None], 0).astype(np.float64)
        mine, theirs = np.arange(0, len(a.w), bl.LEAF_ROWS), np.arange(0, len(some), bl.LEAF_ROWS)
        least, most = kk.box_distances(*kk.boxes(a.X, mine), *kk.boxes(X, theirs))
        radii = np.array([near[g] for g in guesses])
        inside = most[:, :, None] <= radii
        cut = (~inside & (least[:, :, None] <= radii)).any(axis=2)
        whole = np.add.reduceat(w, theirs, axis=0)
        leaf = np.arange(len(some)) // bl.LEAF_ROWS
        change = np.zeros((len(a.w), len(near)), np.int64)
        for i, low in enumerate(mine):
            rows = slice(low, low + bl.LEAF_ROWS)
            change[rows, guesses] += np.where(inside[i] & ~cut[i, :, None], whole, 0.0).sum(axis=0).astype(np.int64)
            at = np.flatnonzero(cut[i][leaf])
            if len(at):
                d, own = kk.pairwise(a.X[rows], X[at]), w[at]
                for k, g in enumerate(guesses):
                    change[rows, g] += ((d <= radii[k]) @ own[:, k]).astype(np.int64)
        return [{"block": pair["a"], "change": change.tobytes()}]

    return run


def _added(sign: int):
    """Per block: its state with the sum of its changes and what is added to
    each of its rows."""

    def run(row: dict) -> list[dict]:
        heavy = np.frombuffer(row["heavy"], np.int64).copy()
        for change in row["changes"] or ():
            heavy += sign * np.frombuffer(change, np.int64)
        if row["each"] is not None:
            heavy = (heavy.reshape(row["rows"], -1) + sign * np.frombuffer(row["each"], np.int64)).reshape(-1)
        return [{**row, "heavy": heavy.tobytes()}]

    return run


@dataclass
class Boxes:
    """Numbers and boxes of the blocks."""

    numbers: list[int]
    low: np.ndarray
    high: np.ndarray

    def met(self, near: list[float], live: list[int], fresh: np.ndarray):
        """(block, block, guesses) whose balls' edges may cut the second block,
        and per block the weights that all of its balls hold as whole blocks."""
        pairs, each = [], []
        radii = np.array([near[g] for g in live])
        some = np.flatnonzero((fresh[:, live] > 0).any(axis=1))
        for low in range(0, len(self.numbers), STRIP_BLOCKS):
            strip = slice(low, low + STRIP_BLOCKS)
            least, most = kk.box_distances(self.low[strip], self.high[strip], self.low[some], self.high[some])
            added = np.zeros((len(least), len(near)), np.int64)
            cut = np.zeros((*least.shape, len(live)), bool)
            for k, g in enumerate(live):
                inside = most <= radii[k]
                added[:, g] = (inside @ fresh[some, g].astype(np.float64)).astype(np.int64)
                cut[:, :, k] = ~inside & (least <= radii[k]) & (fresh[some, g] > 0)
            for i, j in np.argwhere(cut.any(axis=2)).tolist():
                pairs.append((self.numbers[low + i], self.numbers[some[j]], [live[k] for k in np.flatnonzero(cut[i, j])]))
            each += [(self.numbers[low + i], bytearray(a.tobytes())) for i, a in enumerate(added) if a.any()]
        return pairs, each


def _fresh_weights(state: DataFrame, boxes: Boxes, guesses: int) -> np.ndarray:
    """Weight of each block's fresh rows at each guess."""

    def run(row: dict) -> list[dict]:
        fresh = np.frombuffer(row["fresh"], bool).reshape(-1, guesses)
        w = np.frombuffer(row["w"], np.int64)
        return [{"block": row["block"], "weight": np.where(fresh, w[:, None], 0).sum(axis=0).tolist()}]

    found = bl.map_rows(state.select("block", "w", "fresh"), run, "block long, weight array<long>").collect()
    weight = {r["block"]: r["weight"] for r in found}
    return np.array([weight[b] for b in boxes.numbers], np.int64).reshape(len(boxes.numbers), guesses)


def _with_changes(state: DataFrame, boxes: Boxes, near: list[float], live: list[int], sign: int) -> DataFrame:
    pairs, each = boxes.met(near, live, _fresh_weights(state, boxes, len(near)))
    spark = state.sparkSession
    which = spark.createDataFrame(pairs, "a long, b long, guesses array<int>")
    met = bl.some_pairs(which, state.drop("heavy", "fresh", "open"), state.drop("heavy", "open"))
    changed = bl.map_rows(met, _ball_weights(near), PARTIAL)
    # A block gets one change from each block it meets: sums of them in between
    # keep a block's row small.
    lanes = F.pmod(F.xxhash64("change"), F.lit(16)).alias("lane")
    some = changed.groupBy("block", lanes).agg(F.collect_list("change").alias("changes"))
    part = bl.map_rows(some.drop("lane"), lambda r: [{"block": r["block"], "change": sum(
        (np.frombuffer(c, np.int64) for c in r["changes"]), np.int64(0)).tobytes()}], PARTIAL)
    sums = part.groupBy("block").agg(F.collect_list("change").alias("changes"))
    added = spark.createDataFrame(each, "block long, each binary")
    return bl.map_rows(state.join(sums, "block", "left").join(added, "block", "left"), _added(sign), STATE + ", open binary")


def _heaviest(live: list[int], guesses: int):
    """Per block and guess: its first heaviest row (by order key, then
    coordinates) and its open weight."""

    def run(row: dict) -> list[dict]:
        b = bl.block_of(row)
        heavy = np.frombuffer(row["heavy"], np.int64).reshape(-1, guesses)
        left = np.where(np.frombuffer(row["open"], bool).reshape(-1, guesses), b.w[:, None], 0).sum(axis=0)
        at = {}
        for g in live:
            top = np.flatnonzero(heavy[:, g] == heavy[:, g].max())
            top = top[b.order[top] == b.order[top].min()]
            at[g] = top[kk.order_rows(b.order[top], b.X[top])[0]]
        return [
            {"guess": g, "heavy": int(heavy[at[g], g]), "ord": int(b.order[at[g]]), "point_id": int(b.point_id[at[g]]),
             "v": b.X[at[g]].tolist(), "left_over": int(left[g])}
            for g in live
        ]

    return run


def _covered(centers: dict[int, tuple[list[float], float]], guesses: int):
    """Per block: rows within reach of a guess's new center are fresh."""

    def run(row: dict) -> list[dict]:
        b = bl.block_of(row)
        open_ = np.frombuffer(row["open"], bool).reshape(-1, guesses).copy()
        fresh = np.zeros_like(open_)
        for g, (center, far) in centers.items():
            fresh[:, g] = open_[:, g] & (kk.dist_to(kk.columns(b.X), np.array(center)) <= far)
        return [{**row, "fresh": fresh.tobytes(), "open": (open_ & ~fresh).tobytes()}]

    return run


def _begun(guesses: int):
    def run(row: dict) -> list[dict]:
        n = row["rows"] * guesses
        return [{**row, "heavy": bytes(8 * n), "fresh": b"\x01" * n, "open": b"\x01" * n}]

    return run


def cover(blocks: DataFrame, radii: list[float], k: int, z: int, alpha: float, total: int) -> list[Guess]:
    """Up to ``k`` greedy balls for each radius (a rising list) over a set in
    blocks of rows that lie together. Guesses beyond
    one that is already feasible are not pursued."""
    schema = STATE + ", open binary"
    near, far = [(1 + 2 * alpha) * r for r in radii], [(3 + 4 * alpha) * r for r in radii]
    found = [Guess(g, r, total) for g, r in enumerate(radii)]
    n = len(radii)
    boxes = Boxes(*bl.boxes(blocks))
    state = materialised(bl.map_rows(blocks, _begun(n), schema))
    state = materialised(_with_changes(state, boxes, near, list(range(n)), 1))
    live = [g.number for g in found]
    for step in range(k + 1):
        rows = bl.map_rows(state, _heaviest(live, n), "guess int, heavy long, ord long, point_id long, v array<double>, left_over long")
        first = F.struct((-F.col("heavy")).alias("heavy"), "ord", "v", "point_id")
        best = rows.groupBy("guess").agg(F.min(first).alias("best"), F.sum("left_over").alias("left_over"))
        centers = {}
        for row in best.collect():  # one row a guess
            guess = found[row["guess"]]
            guess.left = int(row["left_over"])
            if step < k and guess.left > 0 and row["best"]["heavy"] < 0:
                guess.orders.append(row["best"]["ord"])
                guess.ids.append(row["best"]["point_id"])
                guess.vectors.append(list(row["best"]["v"]))
                centers[guess.number] = (guess.vectors[-1], far[guess.number])
        feasible = [g.number for g in found if g.left <= z]
        live = [g for g in live if g in centers and (not feasible or g <= feasible[0])]
        if not live:
            break
        state = materialised(bl.map_rows(state, _covered({g: centers[g] for g in live}, n), schema))
        if step + 1 < k:
            state = materialised(_with_changes(state, boxes, near, live, -1))
    last = min([g.number for g in found if g.left <= z], default=n - 1)
    return found[: last + 1]
