import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import bruteforce as BF
from pointlake.operators import fft as FFT
from pointlake.operators import geometry as G
from pointlake.operators import kcenter as KC
from pointlake.operators import metric as M
from pointlake.operators.fft import fft_centers, fft_coreset
from pointlake.plans import queries_points as Q
from pointlake.sources.points import parse_point, read_points

TOL = 1e-9
SF = "/root/testdata/sf0.001"

# FIXTURES.md §2, sequential solver with unit weights, alpha = 0.
SEQ_CASES = [
    ("points_15.txt", 3, 3, 0.04999999999999999, 0.04999999999999999, 1, [0, 4, 8],
     0.14142135623730964),
    ("points_15.txt", 3, 1, 0.04999999999999999, 0.7999999999999998, 5, [0, 4, 8],
     1.562049935181331),
    ("points_16.txt", 3, 2, 0.04999999999999999, 0.7999999999999998, 5, [0, 4, 8],
     1.562049935181331),
    ("points_959.csv", 10, 100, 0.00011180339887711215, 0.007155417528135178, 7,
     [802, 912, 86, 36, 205, 58, 321, 603, 108, 489], 0.02143944961980124),
    ("points_959.csv", 5, 10, 0.0014999999999972147, 0.04799999999991087, 6,
     [333, 22, 334, 56, 119], 0.11721518672936454),
]

# FIXTURES.md §2, two-round algorithm, alpha = 2, partition = point_id mod L.
MR_CASES = [
    ("points_16.txt", 3, 2, 1, 6, 16, 0.7810249675906655, 0.7810249675906655, 1, [0, 5, 9],
     1.562049935181331),
    ("points_16.txt", 3, 2, 2, 12, 16, 0.07071067811865474, 0.28284271247461895, 3, [1, 4, 8],
     1.4212670403551895),
    ("points_16.txt", 3, 2, 4, 16, 16, 0.07071067811865465, 0.2828427124746186, 3, [1, 4, 8],
     1.4212670403551895),
    ("points_959.csv", 10, 100, 4, 444, 959, 0.0017499999999976978, 0.0034999999999953957, 2,
     [856, 946, 384, 460, 928, 512, 84, 836, 452, 13], 0.02500599928016877),
    ("points_959.csv", 5, 10, 4, 64, 959, 0.020387066978848123, 0.020387066978848123, 1,
     [0, 460, 23, 404, 370], 0.2054015579298256),
]


def _ids(df):
    return [r.point_id for r in df.orderBy("center_no").collect()]


@pytest.mark.parametrize("name,k,z,r0,rf,ng,centers,obj", SEQ_CASES)
def test_sequential_fixture(spark, fixture_path, name, k, z, r0, rf, ng, centers, obj):
    pts = read_points(spark, fixture_path(name))
    sol = KC.seq_weighted_outliers(pts, k, z, alpha=0)
    assert sol.initial_guess == pytest.approx(r0, abs=TOL)
    assert sol.final_guess == pytest.approx(rf, abs=TOL)
    assert sol.n_guesses == ng
    assert _ids(sol.centers) == centers
    got = G.kcenter_objective(pts, sol.centers, z, max_centers=k).first()[0]
    assert got == pytest.approx(obj, abs=TOL)


@pytest.mark.parametrize("name,k,z,L,m,w,r0,rf,ng,centers,obj", MR_CASES)
def test_two_round_fixture(spark, fixture_path, name, k, z, L, m, w, r0, rf, ng, centers, obj):
    pts = read_points(spark, fixture_path(name))
    mr = KC.mr_kcenter_outliers(pts, k, z, L, alpha=2)
    rep = mr.report.first()
    assert (rep.coreset_points, rep.coreset_weight) == (m, w)
    assert rep.initial_guess == pytest.approx(r0, abs=TOL)
    assert rep.final_guess == pytest.approx(rf, abs=TOL)
    assert rep.n_guesses == ng
    assert _ids(mr.solution.centers) == centers
    assert rep.objective == pytest.approx(obj, abs=TOL)


def test_two_round_run_leaves_nothing_cached(spark, fixture_path):
    KC.mr_kcenter_outliers(read_points(spark, fixture_path("points_16.txt")), 3, 2, 2, alpha=2)
    KC.greedy_cover(_solver_input(spark, [(0, 0), (1, 0), (5, 5)], [1, 1, 1]), 1, 1.0)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_point_fails_in_either_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("1.0,zz",)], "v string")
        with pytest.raises(PySparkException):
            df.select(parse_point("v").alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_point_parsing(spark):
    df = spark.createDataFrame([("1.0,2.0,",), ("-50.0, -50.0",)], "v string")
    assert [r.p for r in df.select(parse_point("v").alias("p")).collect()] == \
        [[1.0, 2.0], [-50.0, -50.0]]


def _points(spark, coords):
    return spark.createDataFrame([(i, [float(x) for x in c], 1) for i, c in enumerate(coords)],
                                 "point_id bigint, point array<double>, weight bigint")


def test_first_points_identical_terminates(spark):
    coords = [(0, 0), (0, 0), (5, 5), (9, 0), (0, 9)]
    sol = KC.seq_weighted_outliers(_points(spark, coords), 2, 1)
    _check(sol, coords, 2, 1)


def test_first_points_identical_beyond_the_head(spark):
    coords = [(1, 1)] * 6 + [(4, 5), (1, 2)]
    sol = KC.seq_weighted_outliers(_points(spark, coords), 2, 1)
    assert sol.initial_guess == 0.5
    _check(sol, coords, 2, 1)


def _check(sol, coords, k, z):
    BF.check_solution(coords, [1] * len(coords), _ids(sol.centers), sol.initial_guess,
                      sol.final_guess, sol.n_guesses, k, z, 0)


def test_all_points_identical(spark):
    pts = _points(spark, [(1, 1)] * 6)
    sol = KC.seq_weighted_outliers(pts, 3, 1)
    assert sol.centers.count() == 1
    assert G.kcenter_objective(pts, sol.centers, 1, 3).first()[0] == 0.0
    core = fft_coreset(pts, 4, 2).collect()
    assert sorted((r.part_id, r.weight) for r in core) == [(0, 3), (1, 3)]


def test_single_point(spark):
    pts = _points(spark, [(3, 4)])
    sol = KC.seq_weighted_outliers(pts, 1, 0)
    assert sol.centers.count() == 1
    assert G.kcenter_objective(pts, sol.centers, 0, 1).first()[0] == 0.0


def test_more_partitions_than_points(spark):
    pts = _points(spark, [(0, 0), (1, 0), (0, 1)])
    core = fft_coreset(pts, 3, 8)
    assert core.count() == 3 and core.agg(F.sum("weight")).first()[0] == 3


def test_parameter_errors(spark):
    pts = _points(spark, [(0, 0), (1, 0), (0, 1)])
    with pytest.raises(ValueError):
        KC.seq_weighted_outliers(pts, 0, 1)
    with pytest.raises(ValueError):
        fft_coreset(pts, 0, 2)
    centers = spark.createDataFrame([(0, [0.0, 0.0])], "center_no int, point array<double>")
    with pytest.raises(PySparkException):
        G.kcenter_objective(pts, centers, 3, 1).collect()


def test_outliers_and_nearest(spark):
    coords = [(0, 0), (1, 0), (10, 0), (11, 0), (50, 50)]
    pts = _points(spark, coords)
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [10.0, 0.0])],
                                    "center_no int, point array<double>")
    near = {r.point_id: (r.center_no, r.dist) for r in G.nearest_center(pts, centers, 2).collect()}
    assert near[1] == (0, 1.0) and near[3] == (1, 1.0)
    out = G.kcenter_outliers(pts, centers, 1, 2).collect()
    assert [r.point_id for r in out] == [4]
    assert G.kcenter_objective(pts, centers, 1, 2).first()[0] == 1.0
    sizes = {r.center_no: r.n_points for r in G.cluster_sizes(G.nearest_center(pts, centers, 2)).collect()}
    assert sizes == {0: 2, 1: 3}


coord = st.integers(min_value=-6, max_value=6).map(lambda v: v / 2)
point_sets = st.lists(st.tuples(coord, coord), min_size=2, max_size=14)


@settings(max_examples=6, deadline=None)
@given(point_sets, st.integers(1, 3), st.integers(0, 3))
def test_solver_matches_bruteforce(spark, coords, k, z):
    sol = KC.seq_weighted_outliers(_points(spark, coords), k, z)
    _check(sol, coords, k, z)


def test_several_blocks_per_round(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 7)
    monkeypatch.setattr(M, "CELL", 9)
    rnd = random.Random(5)
    coords = [(rnd.randint(0, 9) / 2, rnd.randint(0, 9) / 2) for _ in range(45)]
    sol = KC.seq_weighted_outliers(_points(spark, coords), 4, 3)
    _check(sol, coords, 4, 3)


@pytest.fixture(scope="module")
def whole_tables(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    points = {"events": Q.pev(spark, SF), "customers": Q.pt2(spark, SF)}
    return {name: df.select(F.col("point_id").alias("idx"), "point_id", "point", F.lit(1).cast("bigint").alias("weight")) for name, df in points.items()}


@pytest.mark.parametrize("name,radius,block", [("events", 2.0, 64), ("customers", 0.4, 8)])
def test_range_join_compares_few_pairs(spark, monkeypatch, whole_tables, name, radius, block):
    """Exact ball weights of a whole table; blocks that lie apart never meet."""
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "CELL", block)
    P = whole_tables[name]
    rows = P.orderBy("idx").collect()
    gap = BF.distance_matrix([r.point for r in rows])
    got = {r.idx: r.ball_weight for r in KC.ball_weights(P, P, radius).collect()}
    assert got == {r.idx: int(n) for r, n in zip(rows, (gap <= radius).sum(axis=1))}
    head = {"head": [r.point for r in rows[:M.PIVOTS]], "n_points": len(rows)}
    with KC.metric_blocks(P, head) as blocks:
        assert blocks.size.sum() == len(rows) and len(blocks.number) > 10
        bound, at = blocks.between(blocks), {}
        for r in blocks.rows.collect():
            at[r.block] = r.idx
        place = {r.idx: i for i, r in enumerate(rows)}
        for i, a in enumerate(blocks.number.tolist()):
            for j, b in enumerate(blocks.number.tolist()):
                real = gap[np.ix_([place[x] for x in at[a]], [place[x] for x in at[b]])].min()
                assert bound[i, j] <= real
        cover = KC.Cover(blocks, [radius], 1, 3)
        try:
            cover.count()
            first = cover.pairs
            assert (gap <= radius).sum() <= first < len(rows) ** 2 / 3
            cover.lower(cover.choose(), 1, False)
            assert 0 < cover.pairs - first < first / 2  # a round only looks around its new center
        finally:
            cover.release()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_rounds_equal_counting_from_scratch(spark, monkeypatch, whole_tables):
    """Lowered ball weights choose the centers that weights counted anew choose."""
    monkeypatch.setattr(M, "BLOCK", 32)
    monkeypatch.setattr(M, "CELL", 50)
    P = whole_tables["customers"]
    rows = P.orderBy("idx").collect()
    for k, r, alpha in ((6, 0.5, 0), (4, 0.3, 2)):
        centers, left = KC.greedy_cover(P, k, r, alpha)
        order = {row.point_id: i for i, row in enumerate(rows)}
        BF.check_cover([row.point for row in rows], [1] * len(rows), [order[i] for i in _ids(centers)], left, k, r, alpha)


def test_closest_pair_behind_many_coinciding_points(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)
    monkeypatch.setattr(M, "CELL", 30)
    rnd = random.Random(8)
    for spread in (0, 3, 300):
        coords = [(1.0, 2.0)] * 60 + [(rnd.randint(0, 50 * spread) / 7, rnd.randint(0, 50 * spread) / 7) for _ in range(150 if spread else 0)]
        coords += [(5e4, 5e4)] * 20 if spread else []
        gap = BF.distance_matrix(coords)
        P = _solver_input(spark, coords, [1] * len(coords))
        for head in (coords[:1], coords[:40:9] + coords[-5:]):
            with KC.metric_blocks(P, {"head": [list(c) for c in head], "n_points": len(coords)}) as blocks:
                got = KC.closest_pair(blocks)
            assert got == (gap[gap > 0].min() if spread else None)
    sol = KC.initial_guess(P, 2, 3)
    assert sol["r0"] == gap[gap > 0].min() / 2


@settings(max_examples=5, deadline=None)
@given(point_sets, st.integers(1, 5), st.integers(1, 3))
def test_coreset_matches_bruteforce(spark, coords, k, L):
    rows = [(r.part_id, r.step, r.point_id, r.weight) for r in fft_coreset(_points(spark, coords), k, L).collect()]
    BF.check_coreset(coords, rows, k, L)
    assert sum(r[3] for r in rows) == len(coords)


def test_few_candidates_give_the_same_centers(spark, monkeypatch):
    """Passes whose candidates decide only some of the centers, and states written midway."""
    monkeypatch.setattr(FFT, "STORE_EVERY", 2)
    monkeypatch.setattr(FFT, "FEWEST", 3)
    monkeypatch.setattr(FFT, "MOST", 3)
    rnd = random.Random(11)
    coords = [[rnd.randint(0, 30) / 4 for _ in range(3)] for _ in range(120)]
    pts = _points(spark, coords).repartition(5)
    want = sorted(map(tuple, fft_coreset(pts, 15, 2).collect()))
    BF.check_coreset(coords, [(p, s, i, w) for p, s, i, _, w in want], 15, 2)
    rows = pts.rdd.map(tuple).collect()
    part = FFT.Part(ids=np.array([r[0] for r in rows]), points=np.array([r[1] for r in rows]),
                    mind=np.full(120, np.inf), bound=np.inf)
    assert [s for s, _ in part.advance(15)] == [0]  # the candidates decide the first center only
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_fft_centers_64d(spark):
    rnd = random.Random(7)
    coords = [[rnd.uniform(-1, 1) for _ in range(64)] for _ in range(40)]
    got = [r.point_id for r in fft_centers(_points(spark, coords), 6, 1).orderBy("step").collect()]
    BF.check_traversal(coords, got, 6)


def test_mixed_dimensions_fail(spark):
    pts = spark.createDataFrame([(0, [0.0, 0.0], 1), (1, [1.0, 0.0, 2.0], 1), (2, [3.0, 3.0], 1)],
                                "point_id bigint, point array<double>, weight bigint")
    with pytest.raises(Exception):
        fft_coreset(pts, 3, 1).collect()


def test_solver_rejects_mixed_dimensions(spark):
    pts = spark.createDataFrame([(0, [0.0, 0.0], 1), (1, [1.0, 0.0, 2.0], 1)],
                                "point_id bigint, point array<double>, weight bigint")
    with pytest.raises(Exception):  # the distance check or the up-front check
        KC.seq_weighted_outliers(pts, 1, 0)


def _solver_input(spark, coords, weights):
    return spark.createDataFrame(
        [(i, i, [float(x) for x in c], w) for i, (c, w) in enumerate(zip(coords, weights))],
        "idx bigint, point_id bigint, point array<double>, weight bigint")


@settings(max_examples=4, deadline=None)
@given(point_sets, st.integers(1, 3), st.sampled_from([0.5, 1.0, 2.5]), st.sampled_from([0, 2]))
def test_greedy_cover_matches_bruteforce(spark, coords, k, r, alpha):
    coords = [list(c) for c in coords]
    weights = [1 + (i % 3) for i in range(len(coords))]
    centers, left = KC.greedy_cover(_solver_input(spark, coords, weights), k, r, alpha)
    BF.check_cover(coords, weights, _ids(centers), left, k, r, alpha)


def test_ball_operators_match_bruteforce(spark):
    rnd = random.Random(3)
    coords = [[rnd.randint(0, 6) / 2, rnd.randint(0, 6) / 2] for _ in range(25)]
    weights = [1 + (i % 4) for i in range(25)]
    P = _solver_input(spark, coords, weights)
    r = 1.0
    bw = {row.idx: row.ball_weight for row in KC.ball_weights(P, P, r).collect()}
    want = {i: sum(weights[j] for j in range(25) if BF.dist(coords[i], coords[j]) <= r)
            for i in range(25)}
    assert bw == want
    best = max(range(25), key=lambda i: (want[i], -i))
    hb = KC.heaviest_ball(KC.ball_weights(P, P, r)).first()
    assert (hb.idx, hb.ball_weight) == (best, want[best])
    left = KC.ball_removal(P, P.filter(f"idx = {best}").select("point"), 3 * r)
    assert sorted(row.idx for row in left.collect()) == \
        [j for j in range(25) if BF.dist(coords[best], coords[j]) > 3 * r]


@settings(max_examples=4, deadline=None)
@given(point_sets, st.integers(1, 3), st.integers(0, 3))
def test_solution_invariants(spark, coords, k, z):
    coords = [list(c) for c in coords]
    pts = _points(spark, coords)
    sol = KC.seq_weighted_outliers(pts, k, z)
    centers = [coords[r.point_id] for r in sol.centers.collect()]
    assert 1 <= len(centers) <= k
    # uncovered weight at the final guess is at most z (unit weights, alpha = 0)
    uncovered = sum(1 for p in coords if min(BF.dist(p, c) for c in centers) > 3 * sol.final_guess)
    assert uncovered <= z
    if z < len(coords):
        obj = G.kcenter_objective(pts, sol.centers, z, k).first()[0]
        assert obj <= 3 * sol.final_guess or obj == 0.0


@settings(max_examples=4, deadline=None)
@given(point_sets, st.integers(2, 8))
def test_traversal_distances_non_increasing(spark, coords, k):
    coords = [list(c) for c in coords]
    order = [r.point_id for r in fft_centers(_points(spark, coords), k, 1)
             .orderBy("step").collect()]
    gaps = [min(BF.dist(coords[order[s]], coords[order[t]]) for t in range(s))
            for s in range(1, len(order))]
    assert all(a >= b for a, b in zip(gaps, gaps[1:]))
    assert all(g > 0 for g in gaps)
