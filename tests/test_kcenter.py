import random

import pytest
from pyspark.sql import functions as F

import brute
from conftest import fixture
from corvid.operators import geometry as geo
from corvid.operators import kcenter as kc
from corvid.sources import read_points


def solve_unit(spark, pts, k, z, alpha=0):
    sol = kc.weighted_kcenter(pts, k, z, alpha).cache()
    tr = kc.guess_trace(sol).first()
    centers = kc.solution_centers(sol)
    ids = [r.point_id + 1 for r in centers.orderBy("center_no").collect()]
    obj = geo.objective(
        geo.nearest_center_distance(pts, centers.select(F.col("center_no").alias("id"), "v")), z
    ).first().objective
    left = sol.where("feasible").first().left_over
    return tr, ids, left, obj


def rows_of(name):
    with open(fixture(name)) as f:
        return [tuple(float(x) for x in line.split(",")) for line in f.read().splitlines()]


UNIT_CASES = [
    ("clusters.csv", 3, 3), ("clusters.csv", 3, 1), ("clusters.csv", 3, 0), ("clusters_far.csv", 2, 2),
    ("clusters_far.csv", 2, 0), ("scatter.csv", 2, 5), ("scatter.csv", 5, 10),
]


@pytest.mark.parametrize("name,k,z", UNIT_CASES)
def test_unit_weight_files(spark, name, k, z):
    pts, raw = read_points(spark, fixture(name)), rows_of(name)
    guesses, chosen, left = brute.search(raw, [1] * len(raw), k, z, 0)
    tr, ids, got_left, got_obj = solve_unit(spark, pts, k, z)
    assert (tr.initial_guess, tr.final_guess, tr.guesses) == (guesses[0], guesses[-1], len(guesses))
    assert ids == [c + 1 for c in chosen] and got_left == left
    assert got_obj == brute.objective(raw, [raw[c] for c in chosen], z)


def two_rounds(raw, k, z, L, alpha):
    core, w = [], []
    for part in range(L):
        own = raw[part::L]
        centers, weights = brute.fft(own, k + z + 1)
        core += [own[c] for c in centers]
        w += weights
    guesses, chosen, left = brute.search(core, w, k, z, alpha)
    centers = [core[c] for c in chosen]
    return guesses, centers, left, brute.objective(raw, centers, z)


TWO_ROUND_CASES = [
    ("clusters.csv", 3, 1, 2, 2), ("clusters_far.csv", 2, 2, 2, 2), ("scatter.csv", 4, 6, 4, 2), ("scatter.csv", 4, 6, 3, 0),
]


@pytest.mark.parametrize("name,k,z,L,alpha", TWO_ROUND_CASES)
def test_two_round_files(spark, name, k, z, L, alpha):
    pts, raw = read_points(spark, fixture(name)), rows_of(name)
    guesses, centers, left, obj = two_rounds(raw, k, z, L, alpha)
    rep = kc.kcenter_report(pts, k, z, L, alpha).first()
    assert (rep.n, rep.k, rep.z, rep.L, rep.levels) == (len(raw), k, z, L, 1)
    assert (rep.initial_guess, rep.final_guess, rep.guesses) == (guesses[0], guesses[-1], len(guesses))
    assert rep.left_over == left and rep.objective == obj
    got = kc.solution_centers(kc.kcenter_outliers(pts, k, z, L, alpha)).orderBy("center_no").collect()
    assert [tuple(r.v) for r in got] == centers


def test_cases_double_the_guess_and_leave_weight_over():
    found = [brute.search(rows_of(n), [1] * len(rows_of(n)), k, z, 0) for n, k, z in UNIT_CASES[:5]]
    assert any(len(guesses) >= 3 and len(chosen) >= 2 and left > 0 for guesses, chosen, left in found)


def points_df(spark, pts):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "point_id long, v array<double>")


def test_matches_brute_force_on_random_sets(spark):
    rnd = random.Random(5)
    for trial in range(3):
        pts = [(round(rnd.uniform(0, 10), 2), round(rnd.uniform(0, 10), 2)) for _ in range(40)]
        k, z = 3, 2 + trial
        guesses, chosen, left = brute.search(pts, [1] * len(pts), k, z, 0)
        tr, ids, got_left, obj = solve_unit(spark, points_df(spark, pts), k, z)
        assert tr.guesses == len(guesses)
        assert tr.final_guess == guesses[-1]
        assert ids == [c + 1 for c in chosen]
        assert got_left == left
        assert obj == brute.objective(pts, [pts[c] for c in chosen], z)


def test_coreset_matches_brute_force_and_relational_weights(spark):
    rnd = random.Random(11)
    pts = [(rnd.randint(0, 20), rnd.randint(0, 20)) for _ in range(60)]
    df = points_df(spark, pts)
    m, L = 5, 3
    got = {(r.part, r.c): (r.point_id, r.w) for r in kc.coreset(df, m, L).collect()}
    for part in range(L):
        members = [i for i in range(len(pts)) if i % L == part]
        centers, weights = brute.fft([pts[i] for i in members], m)
        for c in range(m):
            assert got[(part, c)] == (members[centers[c]], weights[c])
    for given_m in (None, m):
        rel = kc.center_weights(df, kc.fft_centers(df, m, L), L, given_m)
        assert {(r.part, r.c): (r.point_id, r.w) for r in rel.collect()} == got
    with pytest.raises(Exception, match="exceed m"):
        kc.center_weights(df, kc.fft_centers(df, m, L), L, m - 1).collect()


def test_equal_points_first_guess_zero(spark):
    df = points_df(spark, [(0, 0), (0, 0), (5, 5), (9, 9), (20, 20)])
    sol = kc.weighted_kcenter(df, 1, 1, 0).orderBy("guess_no").collect()
    assert sol[0].r == 0.0 and sol[0].left_over == 3 and not sol[0].feasible
    assert sol[-1].feasible and all(not s.feasible for s in sol[:-1])


def test_tiny_partition_pads_with_first_point(spark):
    df = points_df(spark, [(0, 0), (1, 1)])
    rows = kc.coreset(df, 4, 1).orderBy("c").collect()
    assert [r.point_id for r in rows] == [0, 1, 0, 0]
    assert [r.w for r in rows] == [1, 1, 0, 0]


def test_too_few_points_is_an_error(spark):
    df = points_df(spark, [(0, 0), (1, 1)])
    with pytest.raises(Exception, match="k\\+z\\+1"):
        kc.weighted_kcenter(df, 2, 1, 0).collect()


def test_properties_on_many_points(spark):
    pts = read_points(spark, fixture("scatter.csv"))
    cs = kc.coreset(pts, 8, 4)
    assert cs.agg(F.sum("w")).first()[0] == 700
    for z in (0, 5, 20):
        rep = kc.kcenter_report(pts, 3, z, 4).first()
        assert rep.left_over <= z
    sol = kc.kcenter_outliers(pts, 3, 5, 4).collect()
    assert all(len(s.center_ord) <= 3 for s in sol)
    assert all(not s.feasible for s in sol[:-1]) and sol[-1].feasible
    # For fixed centers the objective never grows with z.
    centers = kc.solution_centers(kc.kcenter_outliers(pts, 3, 5, 4)).selectExpr("center_no AS id", "v")
    dists = geo.nearest_center_distance(pts, centers).cache()
    objs = [geo.objective(dists, z).first().objective for z in (0, 1, 5, 50, 699, 2000)]
    assert objs == sorted(objs, reverse=True)


def test_levels_are_the_callers_choice(spark):
    pts = read_points(spark, fixture("scatter.csv"))
    m, L = 6, 64
    one = kc.coreset(pts, m, L).agg(F.count("*").alias("n"), F.sum("w").alias("w")).first()
    two = kc.coreset(pts, m, L, levels=2, part_rows=100).agg(F.count("*").alias("n"), F.sum("w").alias("w")).first()
    assert (one.n, one.w) == (m * L, 700) and (two.n, two.w) == (4 * m, 700)
    assert kc.kcenter_report(pts, 2, 3, L, levels=2, part_rows=100).first().levels == 2
    assert kc.kcenter_report(pts, 2, 3, L).first().levels == 1


def test_parts_follow_the_data_or_are_refused(spark):
    pts = read_points(spark, fixture("scatter.csv"))
    sizes = kc.coreset(pts, 5, None, part_rows=100).groupBy("part").agg(F.sum("w").alias("w")).collect()
    assert len(sizes) == 7 and all(r.w <= 100 for r in sizes)
    assert kc.kcenter_report(pts, 2, 2, None, part_rows=100).first().L == 7
    saved = kc.MAX_PART_ROWS
    kc.MAX_PART_ROWS = 300
    try:
        with pytest.raises(Exception, match="raise L"):
            kc.coreset(pts, 5, 2).collect()
        assert kc.coreset(pts, 5, 3).count() == 15
    finally:
        kc.MAX_PART_ROWS = saved


@pytest.mark.parametrize("lanes", [1, 2, 5])
def test_lanes_do_not_change_the_answer(spark, lanes):
    pts = read_points(spark, fixture("scatter.csv"))
    want = [tuple(r) for r in kc.weighted_kcenter(pts, 4, 3, 0).orderBy("guess_no").collect()]
    got = [tuple(r) for r in kc.weighted_kcenter(pts, 4, 3, 0, lanes=lanes).orderBy("guess_no").collect()]
    assert got == want and len(got) >= 3


def test_blocks_do_not_change_the_answer(monkeypatch):
    import numpy as np

    from corvid.operators import kcenter_kernels as kk

    X = np.random.default_rng(3).normal(size=(90, 3))
    w = np.arange(1, 91)
    want = kk.search_lane(X, w, 3, 40, 0, 0, 1)
    monkeypatch.setattr(kk, "FULL_ROWS", 0)
    monkeypatch.setattr(kk, "BLOCK_CELLS", 700)
    assert kk.search_lane(X, w, 3, 40, 0, 0, 1) == want and len(want) > 1


def test_tiny_first_distance_keeps_doubling(spark):
    df = points_df(spark, [(0, 0), (1e-70, 0), (1, 0), (0, 1), (1, 1), (5, 5)])
    sol = kc.weighted_kcenter(df, 1, 1, 0).orderBy("guess_no").collect()
    assert len(sol) > 200 and sol[-1].feasible and [s.guess_no for s in sol] == list(range(len(sol)))


def test_report_writes_the_coreset_once_and_solves_once(spark):
    from corvid.plans.inspect import plan_text

    rep = kc.kcenter_report(read_points(spark, fixture("scatter.csv")), 4, 6, 3, 0)
    rep.collect()
    text = plan_text(rep, "simple")
    # The solve reads the written coreset, and its one row is a shared subquery.
    assert "ExistingRDD" in text and "ReusedSubquery" in text


@pytest.mark.parametrize("alpha", [0, 2])
def test_weighted_solver_matches_brute_force(spark, alpha):
    rnd = random.Random(17 + alpha)
    pts = [(round(rnd.uniform(0, 20), 1), round(rnd.uniform(0, 20), 1)) for _ in range(35)]
    w = [rnd.randint(1, 5) for _ in pts]
    k, z = 3, 6
    df = spark.createDataFrame(
        [(i, [float(x) for x in p], w[i]) for i, p in enumerate(pts)], "point_id long, v array<double>, w long"
    )
    guesses, chosen, left = brute.search(pts, w, k, z, alpha)
    sol = kc.weighted_kcenter(df, k, z, alpha).orderBy("guess_no").collect()
    assert [s.r for s in sol] == guesses
    assert sol[-1].center_point_id == chosen
    assert sol[-1].left_over == left and sol[-1].feasible
    greedy = kc.greedy_cover(df, k, guesses[0], alpha, z).first()
    first_chosen, first_left = brute.cover(pts, w, k, guesses[0], alpha)
    assert greedy.center_point_id == first_chosen and greedy.left_over == first_left


def test_reader_partitions_do_not_change_the_answer(spark):
    a = kc.kcenter_report(read_points(spark, fixture("scatter.csv")), 5, 10, 4).first()
    b = kc.kcenter_report(read_points(spark, fixture("scatter.csv"), partitions=7), 5, 10, 4).first()
    assert a == b


def test_file_splits_do_not_change_ids_or_answers(spark, tmp_path):
    raw = rows_of("scatter.csv")
    for k, at in enumerate((0, 301, 302)):
        to = (301, 302, 700)[k]
        (tmp_path / f"part{k}.csv").write_text("\n".join(f"{x},{y}" for x, y in raw[at:to]) + "\n")
    whole = kc.kcenter_report(read_points(spark, fixture("scatter.csv")), 4, 6, 3, 0).first()
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "10"}
    saved = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        pts = read_points(spark, str(tmp_path))
        assert pts.rdd.getNumPartitions() > 5
        assert [tuple(r.v) for r in pts.orderBy("point_id").collect()] == raw
        assert [r.point_id for r in pts.orderBy("point_id").collect()] == list(range(700))
        assert kc.kcenter_report(pts, 4, 6, 3, 0).first() == whole
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_kernel_distances_match_sequential_formula():
    import numpy as np

    from corvid.operators import kcenter_kernels as kk

    rng = np.random.default_rng(1)
    X = rng.normal(size=(300, 9))
    ref = np.zeros((300, 300))
    for j in range(9):
        dd = X[:, j][:, None] - X[:, j][None, :]
        ref = ref + dd * dd
    ref = np.sqrt(ref)
    assert np.array_equal(kk.pairwise(X, X, block=64), ref)
    assert np.array_equal(kk.dist_to(kk.columns(X), X[7]), ref[:, 7])


def test_argument_rules(spark):
    df = points_df(spark, [(0, 0), (1, 1), (2, 2), (3, 3)])
    for k, z in ((0, 1), (1, -1)):
        with pytest.raises(ValueError):
            kc.weighted_kcenter(df, k, z)
        with pytest.raises(ValueError):
            kc.kcenter_outliers(df, k, z, 2)
    with pytest.raises(ValueError):
        kc.coreset(df, 0, 2)
    with pytest.raises(ValueError):
        kc.coreset(df, 10, 2, levels=0)
    with pytest.raises(ValueError):
        geo.farthest_points(geo.nearest_distance(df, df.selectExpr("point_id AS id", "v")), -1)
