"""Sets larger than a block: the same rows as the one-task solver, and the
distance operators without a bound on centers."""

import numpy as np
import pyarrow as pa
import pytest

from corvid.operators import blocks as bl
from corvid.operators import geometry, kcenter
from corvid.operators import kcenter_kernels as kk
from corvid.plans.inspect import plan_text


def point_rows(seed, n, d=2, digits=1):
    """Points with ties in distance and repeated coordinates."""
    r = np.random.default_rng(seed)
    return [(i, [float(x) for x in np.round(r.normal(size=d), digits)], int(r.integers(1, 9))) for i in range(n)]


def frame(spark, rows, partitions=4):
    return spark.createDataFrame(rows, "point_id long, v array<double>, w long").repartition(partitions)


def distance(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += (x - y) * (x - y)
    return float(np.sqrt(total))


def greedy_by_definition(rows, k, r, alpha):
    """Chosen ids and leftover weight of one guess, by loops over sets."""
    open_, chosen = {i for i, _, _ in rows}, []
    weight, at = {i: w for i, _, w in rows}, {i: v for i, v, _ in rows}
    while len(chosen) < k and open_:
        ball = {i: sum(weight[j] for j in open_ if distance(at[i], at[j]) <= (1 + 2 * alpha) * r) for i in at}
        best = max(sorted(ball), key=lambda i: ball[i])
        if ball[best] <= 0:
            break
        chosen.append(best)
        open_ = {j for j in open_ if distance(at[best], at[j]) > (3 + 4 * alpha) * r}
    return chosen, sum(weight[j] for j in open_)


@pytest.mark.parametrize("radius, alpha", [(0.3, 0), (0.05, 2), (0.0, 0)])
def test_greedy_cover_in_blocks(spark, radius, alpha):
    rows = point_rows(1, 90)
    (got,) = kcenter.greedy_cover(frame(spark, rows), 4, radius, alpha, block_rows=16).collect()
    chosen, left = greedy_by_definition(rows, 4, radius, alpha)
    assert (got["center_point_id"], got["left_over"]) == (chosen, left)
    (one,) = kcenter.greedy_cover(frame(spark, rows), 4, radius, alpha).collect()
    assert one == got


@pytest.mark.parametrize("seed, n, k, z, alpha", [(2, 80, 3, 10, 0), (3, 60, 2, 5, 2), (4, 40, 5, 30, 0)])
def test_search_in_blocks_equals_one_task(spark, seed, n, k, z, alpha):
    rows = frame(spark, point_rows(seed, n))
    want = kcenter.weighted_kcenter(rows, k, z, alpha).collect()
    got = kcenter.weighted_kcenter(rows, k, z, alpha, block_rows=13).collect()
    assert got == want and got[-1]["feasible"] and not any(r["feasible"] for r in got[:-1])


def test_search_in_blocks_with_equal_points(spark):
    same = [(i, [1.0, 1.0], 1) for i in range(30)]
    assert [r["r"] for r in kcenter.weighted_kcenter(frame(spark, same), 1, 2, block_rows=7).collect()] == [0.0]
    # The first rows are equal: the search goes on from the least positive distance of all.
    mixed = same[:10] + [(i, [float(i), 0.0], 1) for i in range(10, 30)]
    want = kcenter.weighted_kcenter(frame(spark, mixed), 2, 3).collect()
    got = kcenter.weighted_kcenter(frame(spark, mixed), 2, 3, block_rows=7).collect()
    assert got == want and got[0]["r"] == 0.0 and len(got) > 1


def test_a_row_is_never_in_a_group_of_more_than_two_blocks(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def spy(pair, real=bl.block_of):
        rows = max(pair["left"]["rows"], pair["right"]["rows"])
        if rows > 25:
            seen.add(1)
        return []

    blocks = bl.packed(frame(spark, point_rows(5, 200)).withColumnRenamed("point_id", "ord").selectExpr("ord", "ord AS point_id", "v", "w"), 20)
    pairs = bl.pairs(blocks, blocks, 20)
    assert pairs.count() == 400
    assert pairs.agg({"a": "max"}).first()[0] == 19
    assert blocks.agg({"rows": "sum"}).first()[0] == 200
    bl.map_rows(pairs, spy, "x int").count()
    assert seen.value == 0


def test_least_distances(spark):
    rows = point_rows(6, 70, digits=2)
    df = frame(spark, rows).selectExpr("point_id AS ord", "point_id", "v", "w")
    every = [distance(a[1], b[1]) for i, a in enumerate(rows) for b in rows[:i]]
    got = bl.least_distances(bl.packed(df, 6), 6).first()
    assert got["least"] == min(every) and got["positive"] == min(d for d in every if d > 0)
    assert tuple(bl.least_distances(bl.packed(df.limit(1), 1), 1).first()) == (None, None)


@pytest.mark.parametrize("radius", [0.0, 0.1, 0.5, 3.0, 1e12])
@pytest.mark.parametrize("d", [1, 2, 5])
def test_balls_of_many_centers(spark, radius, d):
    rows = point_rows(7, 60, d)
    points = frame(spark, rows)
    centers = points.selectExpr("point_id + 1000 AS id", "v")
    inside = {(i + 1000, j) for i, a, _ in rows for j, b, _ in rows if distance(a, b) <= radius}
    got = geometry.ball_members(points, centers, radius).collect()
    assert len(got) == len(inside) and {(r["center_id"], r["point_id"]) for r in got} == inside
    weight = {i + 1000: sum(w for j, _, w in rows if (i + 1000, j) in inside) for i, _, _ in rows}
    balls = {r["center_id"]: r["ball_weight"] for r in geometry.ball_weights(points, centers, radius).collect()}
    assert balls == weight
    best = geometry.heaviest_ball(points, centers, radius).first()
    assert best["center_id"] == max(sorted(weight), key=lambda c: weight[c]) and best["ball_weight"] == max(weight.values())


def test_balls_at_closed_edges_and_large_coordinates(spark):
    xs = [k * 0.1 for k in range(-30, 30)] + [1e15, 1e15 + 0.25, -4e18]
    points = frame(spark, [(i, [x], 1) for i, x in enumerate(xs)])
    centers = points.selectExpr("point_id AS id", "v")
    for radius in (0.1, 0.30000000000000004, 0.25):
        want = {(i, j) for i, a in enumerate(xs) for j, b in enumerate(xs) if distance([a], [b]) <= radius}
        assert {(r["center_id"], r["point_id"]) for r in geometry.ball_members(points, centers, radius).collect()} == want


def test_more_centers_than_one_array_may_hold(spark):
    n = geometry.MAX_CENTERS + 500
    centers = spark.range(n).selectExpr("id", "array(cast(id AS double), 0D) AS v")
    points = spark.range(3).selectExpr("id AS point_id", "array(cast(id * 5000 AS double) + 0.5D, 0D) AS v")
    got = {(r["center_id"], r["point_id"]) for r in geometry.ball_members(points, centers, 0.5).collect()}
    assert got == {(0, 0), (1, 0), (5000, 1), (5001, 1), (10000, 2), (10001, 2)}
    assert geometry.ball_weights(points, centers, 0.5).filter("ball_weight = 0").count() == n - 6


def test_balls_have_no_center_array_and_no_cross_join(spark):
    points = frame(spark, point_rows(8, 20))
    plan = plan_text(geometry.ball_weights(points, points.selectExpr("point_id AS id", "v"), 0.5))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "collect_list" not in plan


@pytest.mark.parametrize("z", [0, 1, 7, 150, 298, 299, 300, 10**6])
def test_objective_with_many_outliers(spark, monkeypatch, z):
    r = np.random.default_rng(9)
    d = [float(x) for x in np.round(r.exponential(size=300), 1)] + [1e6]
    dists = spark.createDataFrame(list(enumerate(d)), "point_id long, d double")
    want = sorted(d, reverse=True)[min(z, len(d) - 1)]
    assert geometry.objective(dists, z).first()["objective"] == want
    monkeypatch.setattr(geometry, "FEW", 5 if z else -1)
    monkeypatch.setattr(geometry, "RANGES", 8)
    assert geometry.objective(dists, z).first()["objective"] == want


def test_objective_of_nothing(spark, monkeypatch):
    dists = spark.createDataFrame([], "point_id long, d double")
    assert geometry.objective(dists, 3).first()["objective"] is None
    monkeypatch.setattr(geometry, "FEW", 0)
    assert geometry.objective(dists, 3).first()["objective"] is None


def test_parts_are_balanced_without_a_number(spark):
    points = spark.range(10_000).selectExpr("id AS point_id", "array(cast(id % 97 AS double), cast(id % 89 AS double)) AS v")
    core = kcenter.coreset(points, 4).groupBy("part").count().collect()
    assert len(core) == 50 and all(r["count"] == 4 for r in core)  # sqrt(10000 * 4) = 200 points a part


def test_center_weights_take_the_parts_of_the_centers(spark):
    points = spark.range(500).selectExpr("id * 8 AS point_id", "array(cast(id % 31 AS double), cast(id AS double)) AS v")
    for kw in ({"L": 6}, {"part_rows": 70}, {}):
        centers = kcenter.fft_centers(points, 3, **kw)
        got = {(r["part"], r["c"]): r["w"] for r in kcenter.center_weights(points, centers).collect()}
        L = kw.get("L")
        want = {(r["part"], r["c"]): r["w"] for r in kcenter.coreset(points, 3, L, 1, kw.get("part_rows")).collect()}
        assert got == want and sum(got.values()) == 500
    with pytest.raises(ValueError):
        kcenter.center_weights(points, centers.drop("parts"))


@pytest.mark.parametrize("m", [2, 20, 55, 90])
def test_initial_radius_over_blocks(spark, m):
    rows = point_rows(11, 90, digits=3)
    points = frame(spark, rows)
    want = min(distance(a[1], b[1]) for i, a in enumerate(rows[:m]) for b in rows[:i]) / 2
    for size in (4096, 8):
        assert geometry.initial_radius(points, m, size).first()["r0"] == want


def test_covers_hold_what_centers_stand_for(spark):
    rows = [(i, v) for i, v, _ in point_rows(12, 240, digits=3)]
    points = spark.createDataFrame(rows, "point_id long, v array<double>")
    for levels in (1, 2):
        core = kcenter.coreset(points, 5, None, levels, 30).collect()
        near = [min((distance(v, c["v"]) for c in core)) for _, v in rows]
        assert max(near) <= max(c["cover"] for c in core) + 1e-12
        if levels == 1:
            own = {}
            for c in core:
                own.setdefault(c["part"], []).append(c)
            parts = max(own) + 1
            exact = [min((distance(v, c["v"]), c["c"]) for c in own[i % parts]) for i, v in rows]
            for c in core:
                mine = [d for (i, _), (d, k) in zip(rows, exact, strict=True) if i % parts == c["part"] and k == c["c"]]
                assert c["cover"] == max(mine, default=0.0)
    report = kcenter.kcenter_report(points, 3, 1, part_rows=30).first()
    assert report["coreset_radius"] == max(c["cover"] for c in kcenter.coreset(points, 5, None, 1, 30).collect())


def test_only_blocks_at_the_edge_of_a_ball_are_compared(spark):
    from corvid.operators import greedy

    rows = [(i, [float(i), float(i % 3)], 1) for i in range(1000)]
    df = frame(spark, rows).selectExpr("point_id AS ord", "point_id", "v", "w").localCheckpoint()
    blocks = bl.near_packed(df, 1000, 50).localCheckpoint()
    sizes = [r["rows"] for r in blocks.collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 50
    boxes = greedy.Boxes(*bl.boxes(blocks))
    near = [20.0, 300.0]
    fresh = np.array([[r, r] for _, r in sorted((r["block"], r["rows"]) for r in blocks.collect())])
    pairs, each = boxes.met(near, [0, 1], fresh)
    assert 0 < len(pairs) < len(sizes) ** 2 / 2 and each
    want = kcenter.weighted_kcenter(frame(spark, rows), 3, 20).collect()
    assert kcenter.weighted_kcenter(frame(spark, rows), 3, 20, block_rows=50).collect() == want


@pytest.mark.parametrize("d", [1, 5])
def test_any_number_of_centers_in_groups(spark, monkeypatch, d):
    for name in ("GROUP_POINTS", "GROUP_CENTERS", "NEAR_ROWS"):
        monkeypatch.setattr(geometry, name, 7)
    points = frame(spark, point_rows(13, 60, d))
    points = points.unionByName(points.limit(5))  # ids repeat
    centers = points.selectExpr("point_id + 1000 AS id", "v").limit(25)
    for op in (geometry.point_distances, geometry.nearest_center_distance, geometry.nearest_distance):
        want = sorted(map(tuple, op(points, centers).collect()))
        assert sorted(map(tuple, op(points, centers, None).collect())) == want
    nothing = centers.limit(0)
    assert geometry.point_distances(points, nothing, None).count() == 0
    assert {tuple(r)[1:] for r in geometry.nearest_center_distance(points, nothing, None).collect()} == {(None, None)}
    more = spark.range(geometry.MAX_CENTERS + 1).selectExpr("id", "array(cast(id AS double)) AS v")
    one = spark.range(1).selectExpr("id AS point_id", "array(1D) AS v")
    monkeypatch.undo()
    assert tuple(geometry.nearest_center_distance(one, more, None).first()) == (0, 1, 0.0)


def test_center_weights_are_found_part_by_part(spark):
    rows = [(i, v) for i, v, _ in point_rows(14, 90)]
    points = spark.createDataFrame(rows, "point_id long, v array<double>")
    centers = kcenter.fft_centers(points, 40, 3)  # parts of 30 points: centers repeat
    found = kcenter.center_weights(points, centers)
    assert "Join" not in plan_text(found, "simple") and "collect_list" not in plan_text(found, "simple")
    want = {(r["part"], r["c"]): (r["point_id"], r["w"]) for r in kcenter.coreset(points, 40, 3).collect()}
    assert {(r["part"], r["c"]): (r["point_id"], r["w"]) for r in found.collect()} == want


@pytest.mark.parametrize("d", [1, 3, 64])
@pytest.mark.parametrize("scale", [1e-160, 1e-30, 1.0, 1e6, 1e150, 1e250])
def test_matrix_products_settle_what_the_exact_distances_say(d, scale):
    r = np.random.default_rng(15)
    X, Y = r.normal(size=(300, d)), r.normal(size=(200, d))
    X[:40], Y[40:60] = Y[:40], Y[:20]  # equal rows: ties and distances of 0
    X[40:60] += 1e4  # far rows loosen the bounds of the others
    Y[100:110] = X[100:110] * (1 + 2.0**-52)
    X, Y = X * scale, Y * scale
    want = kk.pairwise(X, Y)
    least, at = kk.nearest_rows(X, Y)
    assert (least == want.min(axis=1)).all() and (at == want.argmin(axis=1)).all()
    some = [float(x) for x in want.reshape(-1)[::7001]]  # edges that some pairs lie on
    for radius in [-1.0, 0.0, float("inf"), *some, *np.nextafter(some, 0).tolist(), 2 * float(want.max())]:
        found = np.concatenate([inside for _, inside in kk.within(X, Y, radius)])
        assert (found == (want <= radius)).all()


def test_points_near_centers_are_not_all_measured_one_by_one(monkeypatch):
    """Of the pairs of unit vectors only those that rounding leaves open are."""
    r = np.random.default_rng(16)
    X = r.normal(size=(2000, 64))
    X /= np.linalg.norm(X, axis=1)[:, None]
    measured, some, every = [], kk.some_distances, kk.pairwise
    monkeypatch.setattr(kk, "some_distances", lambda A, B, i, j: measured.append(len(i)) or some(A, B, i, j))
    monkeypatch.setattr(kk, "pairwise", lambda A, B, *a: measured.append(len(A) * len(B)) or every(A, B, *a))
    kk.nearest_rows(X, X[:500])
    list(kk.within(X, X[:500], 1.3))
    assert 0 < sum(measured) < len(X) * 500 / 100


def test_groups_hold_few_coordinates_of_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(geometry, "GROUP_VALUES", 64)
    points = frame(spark, point_rows(17, 40, 16))
    centers = points.selectExpr("point_id AS id", "v")
    assert points.agg(geometry._room("v", geometry.NEAR_ROWS)).first()[0] == 10
    found = {r["point_id"]: (r["center_id"], r["d"]) for r in geometry.nearest_center_distance(points, centers, None).collect()}
    assert found == {i: (i, 0.0) for i, _, _ in point_rows(17, 40, 16)}
    weights = geometry.ball_weights(points, centers, 0.0).collect()
    assert {r["center_id"]: r["ball_weight"] for r in weights} == {i: w for i, _, w in point_rows(17, 40, 16)}


def shuffled(df):
    """Rows that the exchanges of a plan that has run wrote."""
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            rows += node.metrics().get("shuffleRecordsWritten").get().value()
        children = node.children()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            todo += [children.apply(i) for i in range(children.size())]
    return rows


def test_no_row_is_copied_to_its_pairs(spark, monkeypatch):
    """However many groups or packs points and centers make, a point is shuffled once."""
    for name in ("GROUP_POINTS", "GROUP_CENTERS"):
        monkeypatch.setattr(geometry, name, 7)
    monkeypatch.setattr(geometry, "PACK_VALUES", 14, raising=False)
    points = spark.createDataFrame(point_rows(18, 60), "point_id long, v array<double>, w long")
    centers = points.selectExpr("point_id AS id", "v").limit(25)
    found = geometry.point_distances(points, centers, None)
    assert len(found.collect()) == 60 * 25
    assert 0 < shuffled(found) <= 60 + 25


@pytest.mark.parametrize("values", [1 << 19, 12])  # one pack of centers, or some
def test_all_pairs_of_null_and_repeated_rows(spark, monkeypatch, values):
    monkeypatch.setattr(geometry, "PACK_VALUES", values, raising=False)
    rows = [(i if i % 5 else None, v) for i, v, _ in point_rows(19, 30, 4)] * 2
    points = spark.createDataFrame(rows, "point_id long, v array<double>")
    centers = points.selectExpr("point_id AS id", "v").limit(11)
    own = [tuple(r) for r in centers.collect()]
    found = [tuple(r) for r in geometry.point_distances(points, centers, None).collect()]
    order = lambda x: tuple((y is not None, y) for y in x)
    assert sorted(found, key=order) == sorted(((i, j, distance(v, c)) for i, v in rows for j, c in own), key=order)
    other = centers.selectExpr("id", "array(1D, 2D) AS v")
    with pytest.raises(Exception, match="different dimensions"):
        geometry.point_distances(points, other, None).collect()


def test_pairs_of_packs_go_out_a_few_at_a_time(monkeypatch):
    for name, size in (("BATCH_PAIRS", 7), ("GROUP_POINTS", 5), ("GROUP_CENTERS", 3)):
        monkeypatch.setattr(geometry, name, size)
    X, C = (np.array([v for _, v, _ in point_rows(seed, n, 3)]) for seed, n in ((20, 7), (21, 4)))
    packs = [[[5, None, *range(5)]], [X.tobytes()], [[*range(3), None]], [C.tobytes()]]
    kinds = [pa.list_(pa.int64()), pa.binary()] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(packs, kinds, strict=True)], names=list("abcd"))
    found = list(geometry._all_distances([batch]))
    assert [len(b) for b in found] == [6, 6, 3, 5, 6, 2]
    want = [(i, j, distance(x, c)) for i, x in zip(packs[0][0], X, strict=True) for j, c in zip(packs[2][0], C, strict=True)]
    order = lambda x: tuple((y is not None, y) for y in x)
    assert sorted((tuple(r.values()) for b in found for r in b.to_pylist()), key=order) == sorted(want, key=order)
