"""k-center with z outliers: per-part coresets, then a solve over the coreset.

Round 1 (``coreset``): points are dealt to ``L`` parts by ``pmod(point_id,
L)`` (the same parts on every run and cluster, whatever the file splits and
cores) and each part runs a farthest-first traversal to ``m = k+z+1`` centers,
weighting each center by the points nearest to it. ``groupBy('part')
.applyInArrow`` gives each part to one task as an Arrow table; the kernel is
vectorised numpy, one distance pass per center. Without ``L`` the number of
parts follows the number of points (``PART_ROWS`` each); with ``L`` a table
whose parts would exceed ``MAX_PART_ROWS`` on average fails before any part is
loaded. The output has ``L*m`` rows.

Round 2 (``weighted_kcenter``): the doubling search over the weighted coreset.
Guesses do not depend on each other, and the first feasible guess is the answer
of the sequential search. The set is written once and counted. One of a single
block (``blocks.BLOCK_ROWS`` rows) is copied to ``LANES`` groups, each trying
every ``LANES``-th guess. A larger one stays in blocks (``greedy``): all guesses
share one pass over the pairs of blocks that a ball's edge may cut, then ``k``
steps of covering and subtracting. Both give the same rows, bit for bit; no group holds more than two
blocks.

``levels`` above 1 repeat round 1 on the coreset, which changes the answer and
is therefore the caller's choice; ``kcenter_report`` tells it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.operators import blocks as bl
from corvid.operators import geometry, greedy
from corvid.operators import kcenter_kernels as kk
from corvid.session import materialised
from corvid.sources.points import with_unit_weight

CORESET_SCHEMA = "part int, c int, ord long, point_id long, v array<double>, w long, cover double"
SOLUTION_SCHEMA = (
    "guess_no int, r double, feasible boolean, left_over long, total long, "
    "center_ord array<long>, center_point_id array<long>, center_v array<array<double>>"
)
PART_ROWS = 500_000
MAX_PART_ROWS = 4 * PART_ROWS
LANES = 8


def suggest_parts(n_points: int, m: int, target_part_rows: int = PART_ROWS) -> int:
    """Number of parts so that each holds about ``target_part_rows`` points."""
    return max(1, math.ceil(n_points / max(target_part_rows, 2 * m)))


def parts_column(points: DataFrame, m: int, L: int | None, part_rows: int | None = None) -> Column:
    """The number of parts as a column: ``L``, or as many as the points, counted
    by a scalar subquery, need at ``part_rows`` each. Without either a part
    holds ``sqrt(n * m)`` points (``MAX_PART_ROWS`` at most): a part and the
    coreset of all parts are then of one size. A given ``L`` is checked against
    the count. Nothing runs before the plan does."""
    n = points.agg(F.count(F.lit(1)).alias("n")).scalar()
    if L is None:
        rows = F.lit(part_rows) if part_rows else F.least(F.ceil(F.sqrt(n * F.lit(float(m)))), F.lit(MAX_PART_ROWS))
        return F.greatest(F.ceil(n / F.greatest(rows, F.lit(2 * m))), F.lit(1)).cast("int")
    ok = F.assert_true(n <= F.lit(L * MAX_PART_ROWS), f"parts of over {MAX_PART_ROWS} points: raise L").isNull()
    return F.when(ok, F.lit(L))


def part_of(key: Column, parts: Column) -> Column:
    """The part of a point: its id modulo the parts. Contiguous ids fill the
    parts evenly; see ``lineitem_points`` for ids that are not."""
    return F.pmod(key, parts).cast("int")


def _list_array(M: np.ndarray) -> pa.Array:
    n, d = M.shape
    offsets = pa.array(np.arange(0, n * d + 1, d, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(M.reshape(-1), pa.float64()))


def _fft_part(m: int):
    def run(tbl: pa.Table) -> pa.Table:
        part = tbl.column("part")[0].as_py()
        X = kk.matrix(tbl.column("v"))
        key = tbl.column("key").to_numpy()
        idx = kk.order_rows(key, X)
        X = X[idx]
        ids = tbl.column("point_id").to_numpy()[idx]
        w = tbl.column("w").to_numpy()[idx]
        cover = tbl.column("cover").to_numpy()[idx]
        centers, weights, covers = kk.farthest_first(X, w, m, cover)
        c = np.arange(m, dtype=np.int32)
        return pa.table(
            {
                "part": pa.array(np.full(m, part, dtype=np.int32)),
                "c": pa.array(c),
                "ord": pa.array(part * m + c.astype(np.int64)),
                "point_id": pa.array(ids[centers].astype(np.int64)),
                "v": _list_array(X[centers]),
                "w": pa.array(weights),
                "cover": pa.array(covers),
            }
        )

    return run


def _coreset_level(rows: DataFrame, m: int, parts) -> DataFrame:
    """One round-1 level over ``key, point_id, v, w, cover`` rows."""
    parted = rows.select(part_of(F.col("key"), parts).alias("part"), "key", "point_id", "v", "w", "cover")
    return parted.groupBy("part").applyInArrow(_fft_part(m), CORESET_SCHEMA)


def _check(m: int, L: int | None) -> None:
    if m < 1:
        raise ValueError("m must be >= 1")
    if L is not None and L < 1:
        raise ValueError("L must be >= 1")


def coreset(
    points: DataFrame, m: int, L: int | None = None, levels: int = 1, part_rows: int | None = None
) -> DataFrame:
    """Per part, ``m`` farthest-first centers with their weights.

    -> ``part, c, ord, point_id, v, w, cover``; ``ord = part*m + c`` is the coreset
    order (part by part, centers in the order chosen). Every point that a center
    stands for lies within ``cover`` of it, over all levels. The points are
    shuffled once. Each further level packs ``part_rows`` coreset rows to a part.
    """
    _check(m, L)
    if levels < 1:
        raise ValueError("levels must be >= 1")
    pts = with_unit_weight(points).select(
        F.col("point_id").alias("key"), "point_id", "v", "w", F.lit(0.0).alias("cover")
    )
    parts = parts_column(points, m, L, part_rows)
    out = _coreset_level(pts, m, parts)
    for _ in range(levels - 1):
        n = parts * F.lit(m)
        rows = F.lit(part_rows) if part_rows else F.ceil(F.sqrt(n * F.lit(float(m))))
        parts = F.ceil(n / F.greatest(rows, F.lit(2 * m))).cast("int")
        out = _coreset_level(out.select(F.col("ord").alias("key"), "point_id", "v", "w", "cover"), m, parts)
    return out


def fft_centers(points: DataFrame, m: int, L: int | None = None, part_rows: int | None = None) -> DataFrame:
    """The traversal alone -> ``part, c, point_id, v, parts`` (the number
    of parts that the points were dealt to, in every row)."""
    parts = parts_column(points, m, L, part_rows).alias("parts")
    return coreset(points, m, L, 1, part_rows).select("part", "c", "point_id", "v", parts)


def center_weights(points: DataFrame, centers: DataFrame, L: int | None = None, m: int | None = None) -> DataFrame:
    """Weights of given per-part centers, relationally.

    ``centers``: ``part, c, point_id, v, parts`` (``fft_centers``); the number of
    parts is the one that the centers carry, or ``L`` where they carry none,
    checked against every part. The centers are written once; each part's
    centers meet that part's points in one task, as in K10, and each point picks
    its nearest center (least distance, then least ``c``) in numpy
    (``_part_weights``), so a part sends a row per center. Centers that win no
    point (repeated ones) keep weight 0. With ``m`` a part must not hold more
    centers than that.
    """
    _check(1, L)
    if L is None and "parts" not in centers.columns:
        raise ValueError("centers without a column parts need L")
    count = F.lit(L) if L is not None else F.col("parts")
    given = materialised(
        centers.select("part", F.col("c").cast("long").alias("c"), F.col("point_id").alias("id"), F.col("v").alias("cv"), count.alias("parts"))
    )
    parts = F.lit(L) if L is not None else given.agg(F.max("parts")).scalar()
    pts = with_unit_weight(points).select(part_of(F.col("point_id"), parts).alias("part"), "v", "w").where("part IS NOT NULL")
    schema = "part int, c int, point_id long, w long"
    return pts.groupBy("part").cogroup(given.groupBy("part")).applyInArrow(_part_weights(m), schema)


def _part_weights(m: int | None):
    def run(points: pa.Table, centers: pa.Table) -> pa.Table:
        part, parts = centers.column("part").to_numpy(), centers.column("parts").to_numpy()
        if len(part) and not (parts == parts[0]).all() or (part < 0).any() or (part >= parts).any() or (m is not None and len(part) > m):
            raise ValueError("centers exceed m per part or parts exceed L")
        at = np.argsort(centers.column("c").to_numpy(), kind="stable")
        cs = centers.take(pa.array(at)).combine_chunks()
        c, first = np.unique(cs.column("c").to_numpy(), return_index=True)
        X, C = kk.matrix(points.column("v")), kk.matrix(cs.column("cv"))
        weight = np.zeros(len(C), np.int64)
        if len(X) and len(C):
            if X.shape[1] != C.shape[1]:
                raise ValueError("points and centers of different dimensions")
            w = points.column("w").fill_null(0).to_numpy().astype(np.int64)
            XT = kk.columns(X)
            least, owner = kk.dist_to(XT, C[0]), np.zeros(len(X), np.int64)
            for t in range(1, len(C)):
                d = kk.dist_to(XT, C[t])
                closer = d < least
                least[closer] = d[closer]
                owner[closer] = t
            np.add.at(weight, owner, w)
        ids = cs.column("id").combine_chunks().to_pylist() if len(C) else []
        ends = [*first[1:].tolist(), len(C)] if len(C) else []
        some = [[i for i in ids[a:b] if i is not None] for a, b in zip(first.tolist(), ends, strict=True)]
        return pa.table(
            {
                "part": pa.array(part[:1].repeat(len(c)), pa.int32()),
                "c": pa.array(c, pa.int32()),
                "point_id": pa.array([max(x, default=None) for x in some], pa.int64()),
                "w": pa.array(np.add.reduceat(weight, first) if len(C) else weight, pa.int64()),
            }
        )

    return run


def _lane_solver(k: int, z: int, alpha: float, lanes: int, radius: float | None):
    def run(tbl: pa.Table) -> pa.Table:
        X = kk.matrix(tbl.column("v"))
        key = tbl.column("ord").to_numpy()
        idx = kk.order_rows(key, X)
        X, ords = X[idx], key[idx]
        ids = tbl.column("point_id").to_numpy()[idx]
        w = tbl.column("w").to_numpy()[idx].astype(np.int64)
        if radius is None:
            trace = kk.search_lane(X, w, k, z, alpha, tbl.column("lane")[0].as_py(), lanes)
        else:
            trace = [(0, radius, *kk.greedy_cover(kk.Distances(X), w, k, radius, alpha))]
        rows = [
            (g, r, left <= z, left, int(w.sum()), ords[c].tolist(), ids[c].tolist(), X[c].tolist())
            for g, r, c, left in trace
        ]
        schema = pa.schema(
            [
                ("guess_no", pa.int32()),
                ("r", pa.float64()),
                ("feasible", pa.bool_()),
                ("left_over", pa.int64()),
                ("total", pa.int64()),
                ("center_ord", pa.list_(pa.int64())),
                ("center_point_id", pa.list_(pa.int64())),
                ("center_v", pa.list_(pa.list_(pa.float64()))),
            ]
        )
        columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _lanes(weighted: DataFrame, lanes: int):
    """The weighted set once per lane of guesses."""
    order = F.col("ord") if "ord" in weighted.columns else F.col("point_id")
    rows = with_unit_weight(weighted).select(order.alias("ord"), "point_id", "v", "w")
    lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))
    return rows.select(lane.alias("lane"), "ord", "point_id", "v", "w").groupBy("lane")


def _written(weighted: DataFrame) -> tuple[DataFrame, int, int]:
    """(``ord, point_id, v, w`` written once, rows, total weight)."""
    order = F.col("ord") if "ord" in weighted.columns else F.col("point_id")
    rows = materialised(with_unit_weight(weighted).select(order.alias("ord"), "point_id", "v", F.col("w").cast("long").alias("w")))
    return _counted(rows)


def _counted(rows: DataFrame) -> tuple[DataFrame, int, int]:
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    return rows, n, total


def _radii(rows: DataFrame, blocks: DataFrame, m: int, alpha: float, block_rows: int) -> list[float]:
    """The guesses that the doubling search can need: from half the least
    distance among the first ``m`` rows (after a first guess of 0, half the
    least positive one) to a ball of any row that covers all."""
    first = rows.orderBy("ord", "v").limit(m)
    count = -(-m // block_rows)
    least, positive = bl.least_distances(materialised(bl.packed(first, count)), count).first()
    if not least and positive is None:
        positive = bl.least_positive(blocks)
    start = rows.orderBy("ord", "v").select("v").first()["v"]
    # Rows within d of the first row are within 2d of each other.
    reach = 2 * rows.agg(F.max(geometry.euclidean(F.col("v"), F.lit(list(start)))).alias("d")).first()["d"]
    radii, r = ([], least / 2) if least else ([0.0], None if positive is None else positive / 2)
    while r is not None:
        radii.append(r)
        if (3 + 4 * alpha) * r >= reach:
            # One more: distances are rounded.
            radii.append(2 * r)
            break
        r = 2 * r
    return radii


def _solution(spark, found: list, z: int, total: int) -> DataFrame:
    rows = [(g.number, g.r, g.left <= z, g.left, total, g.orders, g.ids, g.vectors) for g in found]
    return spark.createDataFrame(rows, SOLUTION_SCHEMA)


def weighted_kcenter(
    weighted: DataFrame, k: int, z: int, alpha: float = 0, lanes: int = LANES, block_rows: int = bl.BLOCK_ROWS
) -> DataFrame:
    """K8: doubling search on a weighted set -> one row per guess.

    ``weighted``: ``point_id, v`` plus optional ``w`` (default 1) and
    ``ord`` (order, default ``point_id``). Output rows: ``guess_no, r,
    feasible, left_over, total`` (all weight) and the centers chosen at that
    guess; the last row is the first feasible guess.
    """
    if k < 1 or z < 0 or lanes < 1:
        raise ValueError("need k >= 1, z >= 0 and lanes >= 1")
    return _search(*_written(weighted), k, z, alpha, lanes, block_rows)


def _search(
    rows: DataFrame, n: int, total: int, k: int, z: int, alpha: float, lanes: int = LANES, block_rows: int = bl.BLOCK_ROWS
) -> DataFrame:
    """The search over a written set of ``n`` rows and ``total`` weight."""
    if n > block_rows and n >= k + z + 1:
        blocks = materialised(bl.near_packed(rows, n, block_rows))
        radii = _radii(rows, blocks, k + z + 1, alpha, block_rows)
        return _solution(rows.sparkSession, greedy.cover(blocks, radii, k, z, alpha, total), z, total)
    tried = _lanes(rows, lanes).applyInArrow(_lane_solver(k, z, alpha, lanes, None), SOLUTION_SCHEMA)
    # A row per guess: what later lanes tried beyond the first feasible goes.
    found = tried.agg(F.array_sort(F.collect_list(F.struct(*tried.columns))).alias("g"))
    first = F.array_min(F.transform(F.filter("g", lambda x: x["feasible"]), lambda x: x["guess_no"]))
    kept = found.select("g", first.alias("first")).select(F.filter("g", lambda x: x["guess_no"] <= F.col("first")).alias("g"))
    return kept.select(F.inline("g"))


def greedy_cover(
    weighted: DataFrame, k: int, radius: float, alpha: float = 0, z: int = 0, block_rows: int = bl.BLOCK_ROWS
) -> DataFrame:
    """K7: up to ``k`` greedy balls at one guess ``radius`` -> one row.

    A set of one block is solved in one task; a larger one stays in blocks,
    each step a maximum over all of them and a subtraction of what it covers.
    """
    if k < 1:
        raise ValueError("need k >= 1")
    rows, n, total = _written(weighted)
    if n <= block_rows:
        return _lanes(rows, 1).applyInArrow(_lane_solver(k, z, alpha, 1, float(radius)), SOLUTION_SCHEMA)
    blocks = materialised(bl.near_packed(rows, n, block_rows))
    return _solution(rows.sparkSession, greedy.cover(blocks, [float(radius)], k, z, alpha, total), z, total)


def guess_trace(solution: DataFrame) -> DataFrame:
    """K9: ``initial_guess, final_guess, guesses`` of a doubling search."""
    return solution.agg(
        F.min_by("r", "guess_no").alias("initial_guess"),
        F.max_by("r", "guess_no").alias("final_guess"),
        F.count(F.lit(1)).alias("guesses"),
    )


def solution_centers(solution: DataFrame) -> DataFrame:
    """Centers of the final (first feasible) guess -> ``center_no, point_id, v``."""
    final = solution.where("feasible")
    return final.select(
        F.posexplode(F.arrays_zip("center_point_id", "center_v")).alias("center_no", "x")
    ).select("center_no", F.col("x.center_point_id").alias("point_id"), F.col("x.center_v").alias("v"))


def solution_rows(solution: DataFrame) -> DataFrame:
    """One row per (guess, chosen center), vectors left out -> ``guess_no, r,
    feasible, left_over, center_no, center_ord, center_point_id``."""
    return solution.select(
        "guess_no",
        "r",
        "feasible",
        "left_over",
        F.posexplode(F.arrays_zip("center_ord", "center_point_id")).alias("center_no", "x"),
    ).select(
        "guess_no", "r", "feasible", "left_over", "center_no",
        F.col("x.center_ord").alias("center_ord"), F.col("x.center_point_id").alias("center_point_id"),
    )


def kcenter_outliers(
    points: DataFrame, k: int, z: int, L: int | None = None, alpha: float = 2, levels: int = 1,
    part_rows: int | None = None,
) -> DataFrame:
    """The two-round job -> the solution rows of ``weighted_kcenter``."""
    if k < 1 or z < 0:
        raise ValueError("need k >= 1 and z >= 0")
    return weighted_kcenter(coreset(points, k + z + 1, L, levels, part_rows), k, z, alpha)


def kcenter_report(
    points: DataFrame, k: int, z: int, L: int | None = None, alpha: float = 2, levels: int = 1,
    part_rows: int | None = None,
) -> DataFrame:
    """One row ``n, k, z, L, levels, coreset_radius, initial_guess,
    final_guess, guesses, left_over, objective``. Every point lies within
    ``coreset_radius`` of the coreset row that stands for it, so the coreset
    changes no distance by more than that.

    Two passes over the points: the coreset, and the objective against the
    final centers. The solution is one row of a scalar subquery that the
    distances and the report share, so it is found once; ``n`` is its total
    weight (every point is counted once there).
    """
    if k < 1 or z < 0:
        raise ValueError("need k >= 1 and z >= 0")
    core = materialised(coreset(points, k + z + 1, L, levels, part_rows))
    solution = _search(*_counted(core.select("ord", "point_id", "v", "w")), k, z, alpha)
    found = solution.agg(
        F.min_by("r", "guess_no").alias("initial_guess"),
        F.max_by("r", "guess_no").alias("final_guess"),
        F.count(F.lit(1)).alias("guesses"),
        F.max_by("left_over", "guess_no").alias("left_over"),
        F.max("total").alias("n"),
        F.max_by("center_v", "guess_no").alias("centers"),
    )
    one = found.select(F.struct("*").alias("s")).scalar()
    v = F.col("v")
    dists = points.select("point_id", "v", one["centers"].alias("cs")).select(
        "point_id", F.array_min(F.transform("cs", lambda c: geometry.euclidean(v, c))).alias("d")
    )
    return geometry.objective(dists, z).select(
        one["n"].alias("n"),
        F.lit(k).alias("k"),
        F.lit(z).alias("z"),
        parts_column(points, k + z + 1, L, part_rows).alias("L"),
        F.lit(levels).alias("levels"),
        core.agg(F.max("cover")).scalar().alias("coreset_radius"),
        one["initial_guess"].alias("initial_guess"),
        one["final_guess"].alias("final_guess"),
        one["guesses"].alias("guesses"),
        one["left_over"].alias("left_over"),
        "objective",
    )
