"""Operators for many centers, large ranks, trees of coresets, heavy hitters, bitmaps, sketches and the sink."""

import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import bruteforce as BF
from pointlake.operators import baskets as B
from pointlake.operators import geometry as G
from pointlake.operators import heavy as H
from pointlake.operators import wordcount as W
from pointlake.operators.center_index import CenterIndex, nearest_of_many
from pointlake.operators.coreset_tree import reduced, tree_coreset
from pointlake.operators.fft import Fold, distances
from pointlake.operators.selection import kth_largest, kth_smallest_id, largest_rows
from pointlake.sources.sink import publish, read_published

POINTS = "point_id bigint, point array<double>"


def _points(spark, coordinates, parts=3):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(coordinates)], POINTS).repartition(parts)


# ---------------------------------------------------------------- selection

VALUES = [0.0, 5e-324, 1e-323, 1.0, 1.0, 1.0 + 2 ** -52, 2.5, 1e300, 1.7e308, -1.7e308, math.inf, -math.inf, math.nan]


@pytest.mark.parametrize("rank", range(1, len(VALUES) + 1))
def test_kth_largest_of_extreme_values(spark, rank):
    df = spark.createDataFrame([(v,) for v in VALUES] + [(None,)], "v double")
    want = sorted(VALUES, key=lambda v: (math.isnan(v), 0 if math.isnan(v) else v), reverse=True)[rank - 1]
    got = kth_largest(df, "v", rank)
    assert got.value == want or math.isnan(got.value) and math.isnan(want)
    assert got.before < rank <= got.before + got.equal


def test_kth_of_skewed_values_takes_few_passes(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.exponential(size=6000), np.full(3000, 0.25), 10.0 ** rng.integers(-5, 9, 1000)])
    df = spark.createDataFrame(values.reshape(-1, 1).tolist(), "v double")
    for rank in (1, 1000, 4000, 10_000):
        got = kth_largest(df, "v", rank)
        assert got.value == np.sort(values)[-rank] and got.passes <= 9


@pytest.mark.parametrize("rank", [1, 3, 5, 6])
def test_kth_smallest_id_over_the_whole_range(spark, rank):
    ids = [-2 ** 63, -5, 0, 0, 7, 2 ** 63 - 1]
    got = kth_smallest_id(spark.createDataFrame([(i,) for i in ids] + [(None,)], "i bigint"), "i", rank)
    assert got.value == sorted(ids)[rank - 1] and got.before < rank <= got.before + got.equal


def test_rank_errors(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    for rank in (0, 3):
        with pytest.raises(ValueError):
            kth_largest(df, "v", rank)
    with pytest.raises(ValueError):
        kth_largest(df.limit(0), "v", 1)
    with pytest.raises(ValueError):
        largest_rows(df, "v", "v", -1)


@pytest.mark.parametrize("n", [0, 1, 7, 40, 99, 100, 500])
def test_largest_rows_with_ties_repeats_and_missing_keys(spark, n):
    rows = [(i if i % 10 else None, float(i % 4)) for i in range(100)] + [(33, 1.0), (33, 1.0), (1, None)]
    got = largest_rows(spark.createDataFrame(rows, "id bigint, v double"), "v", "id", n).collect()
    order = sorted((r for r in rows if r[1] is not None), key=lambda r: (-r[1], r[0] is not None, r[0] or 0))[:n]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, order))


def test_outliers_and_objective_of_a_tenth(spark):
    rng = np.random.default_rng(3)
    pts = rng.integers(0, 30, (1500, 2))  # many equal distances
    df, gap = _points(spark, pts), BF.distance_matrix(pts, pts[:3]).min(axis=1)
    centers = spark.createDataFrame([(i, [float(x) for x in pts[i]]) for i in range(3)], "center_no bigint, point array<double>")
    order = np.lexsort((np.arange(1500), -gap))
    got = G.outliers_by_selection(df, centers, 150, 3).collect()
    assert {r.point_id: r.dist for r in got} == {int(i): gap[i] for i in order[:150]}
    assert G.objective_by_selection(df, centers, 150, 3).first().objective == gap[order[150]]
    assert sorted(map(tuple, got)) == sorted(map(tuple, G.kcenter_outliers(df, centers, 150, 3).collect()))
    with pytest.raises(ValueError):
        G.objective_by_selection(df, centers, 1500, 3)


def test_large_ranks_take_the_selection(spark, monkeypatch):
    monkeypatch.setattr(G, "TOP_ROWS", 2)
    df = _points(spark, [(0,), (1,), (2,), (3,), (3,)])
    centers = spark.createDataFrame([(0, [0.0])], "center_no bigint, point array<double>")
    assert G.kcenter_objective(df, centers, 2, 1).first().objective == 2.0
    assert sorted(r.point_id for r in G.kcenter_outliers(df, centers, 3, 1).collect()) == [2, 3, 4]


# ---------------------------------------------------------------- many centers

def test_nearest_of_five_thousand_centers(spark):
    rng = np.random.default_rng(7)
    centers = np.concatenate([rng.normal(size=(4000, 3)), np.round(rng.normal(size=(1000, 3)), 1)])
    pts = np.concatenate([rng.normal(size=(300, 3)), np.round(rng.normal(size=(100, 3)), 1), centers[:50]])
    set_ = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(centers)], "center_no bigint, point array<double>")
    got = nearest_of_many(_points(spark, pts), set_, 5000).orderBy("point_id").collect()
    gap = BF.distance_matrix(pts, centers)
    assert [r.center_no for r in got] == gap.argmin(axis=1).tolist()
    assert [r.dist for r in got] == gap.min(axis=1).tolist()
    index = CenterIndex(np.arange(5000), centers)
    index.nearest(pts)
    assert index.compared < gap.size / 5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=30),
       st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=30), st.integers(-9, 9))
def test_center_index_breaks_ties_by_number(centers, pts, shift):
    numbers = np.arange(len(centers))[::-1] + shift  # given in descending order
    who, d = CenterIndex(numbers, np.array(centers, float)).nearest(np.array(pts, float))
    gap = BF.distance_matrix(pts, centers)
    assert d.tolist() == gap.min(axis=1).tolist()
    assert who.tolist() == [min(numbers[row == row.min()]) for row in gap]


def test_nearest_of_many_edges(spark):
    df = _points(spark, [(1, 2), (3, 4)])
    none = spark.createDataFrame([], "center_no bigint, point array<double>")
    assert [tuple(r) for r in nearest_of_many(df, none, 3).orderBy("point_id").collect()] == [(0, None, None), (1, None, None)]
    two = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 1.0])], none.schema)
    with pytest.raises(ValueError):
        nearest_of_many(df, two, 1)
    assert nearest_of_many(df.limit(0), two, 2).count() == 0
    with pytest.raises(Exception, match="dimension"):
        nearest_of_many(_points(spark, [(1,)]), two, 2).collect()


# ---------------------------------------------------------------- traversal bounds

def test_fold_skips_points_no_new_center_can_improve():
    rng = np.random.default_rng(11)
    pts = np.concatenate([c + 0.01 * rng.normal(size=(500, 2)) for c in rng.uniform(0, 10, (12, 2))])
    order, gap = [0], distances(pts, pts[0])
    while len(order) < 60:
        order.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(pts, pts[order[-1]]))
    mind, near, compared = np.full(len(pts), np.inf), np.full(len(pts), -1), 0
    for at in range(0, 60, 5):
        fold = Fold.of([pts[i].tolist() for i in order[:at]], [(s, pts[order[s]]) for s in range(at, at + 5)])
        compared += fold.apply(pts, mind, near)
    full = np.stack([distances(pts, pts[i]) for i in order], axis=1)
    assert (mind == full.min(axis=1)).all() and (near == full.argmin(axis=1)).all()
    assert compared < full.size / 3


# ---------------------------------------------------------------- coreset tree

def _tree(pts, n, parts, fan):
    """(ids, weights, radius) by the definition, over a distance matrix."""
    groups = [[(i, 1) for i in range(p, len(pts), parts)] for p in range(parts)]
    while True:
        done = []
        for group in groups:
            if not group:
                done.append([])
                continue
            group = sorted(group)
            own = np.array([pts[i] for i, _ in group], float)
            gap, order = BF.distance_matrix(own), [0]
            while len(order) < n and gap[:, order].min(axis=1).max() > 0:
                order.append(int(gap[:, order].min(axis=1).argmax()))
            near = gap[:, order].argmin(axis=1)
            done.append([(group[o][0], sum(w for (_, w), a in zip(group, near, strict=True) if a == s)) for s, o in enumerate(order)])
        if parts == 1:
            return done[0]
        merged = -(-parts // fan)
        groups = [[x for p in range(parts) if p % merged == g for x in done[p]] for g in range(merged)]
        parts = merged


@pytest.mark.parametrize("n,parts,fan", [(5, 12, 3), (4, 7, 2), (6, 1, 2), (3, 40, 8)])
def test_coreset_tree(spark, n, parts, fan):
    pts = np.random.default_rng(n).integers(0, 12, (200, 2))
    rows = tree_coreset(_points(spark, pts), n, parts, fan).orderBy("step").collect()
    assert [(r.point_id, r.weight) for r in rows] == _tree(pts, n, parts, fan)
    assert sum(r.weight for r in rows) == 200
    gap = BF.distance_matrix(pts, np.array([r.point for r in rows]))
    assert gap.min(axis=1).max() <= max(r.radius for r in rows)


def test_coreset_tree_edges(spark):
    assert tree_coreset(_points(spark, []), 3).count() == 0
    same = tree_coreset(_points(spark, [(1, 1)] * 9), 3, 4, 2).collect()
    assert [(r.point_id, r.weight, r.radius) for r in same] == [(0, 9, 0.0)]
    heavy = _points(spark, [(0,), (5,), (9,)]).withColumn("weight", F.when(F.col("point_id") > 0, F.col("point_id") * 3))
    assert [r.weight for r in tree_coreset(heavy, 3).orderBy("point_id").collect()] == [1, 3, 6]
    for bad in ((0, 1, 2), (1, 0, 2), (1, 1, 1)):
        with pytest.raises(ValueError):
            tree_coreset(heavy, *bad)
    mixed = pa.table({"part_id": pa.array([0, 0], pa.int32()), "point_id": [0, 1], "point": [[1.0], [1.0, 2.0]],
                      "weight": [1, 1], "radius": [0.0, 0.0]})
    with pytest.raises(ValueError, match="dimension"):
        reduced(mixed, 1)


# ---------------------------------------------------------------- products

@pytest.mark.parametrize("capacity", [1, 8, 1000])
def test_heavy_hitters_equal_the_full_count(spark, capacity):
    rng = np.random.default_rng(1)
    ids = (rng.zipf(1.3, 4000) % 500).tolist()
    pairs = spark.createDataFrame([(i or None,) for i in ids], "product_id bigint").repartition(5)
    full = B.product_popularity(pairs)
    for h in (1, 10, 600):
        got = [tuple(r) for r in H.top_products_by_summaries(pairs, h, capacity).collect()]
        assert got == [tuple(r) for r in B.top_products(full, h).collect()]
    assert H.top_products_by_summaries(pairs.limit(0), 3).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=80), st.integers(1, 6))
def test_summary_bounds_hold(ids, capacity):
    batches = [pa.record_batch([pa.array(ids[i:i + 9], pa.int64())], ["product_id"]) for i in range(0, len(ids), 9)]
    out = next(iter(H._summaries(iter(batches), capacity, pa.int64()))).to_pylist()
    error, low = out[-1]["error"], {r["product_id"]: r["n"] for r in out[:-1]}
    assert len(low) <= capacity
    for i in set(ids):
        assert low.get(i, 0) <= ids.count(i) <= low.get(i, 0) + error


def test_bitmaps_count_any_customer_number(spark):
    rows = [(1, c, 1, "A") for c in (-2 ** 40, -1, 0, 1, 1, 32_768, 32_769, 2 ** 40, None)] + [(2, 5, 0, "A"), (3, 7, 2, "B"), (4, None, 1, "A")]
    txn = spark.createDataFrame(rows, "product_id bigint, customer_id bigint, quantity int, country string").repartition(3)
    got = {r.product_id: r.popularity for r in B.product_popularity_bitmaps(txn).collect()}
    assert got == {r.product_id: r.popularity for r in B.product_popularity_distinct(txn).collect()}
    assert [tuple(r) for r in B.product_popularity_bitmaps(txn, "B").collect()] == [(3, 1)]


# ---------------------------------------------------------------- sketches, sink

def test_sketches_merge_and_estimate(spark):
    docs = spark.range(3000).select(F.concat_ws(" ", *[F.concat(F.lit("w"), F.pmod(F.col("id") * p, F.lit(5000)).cast("string"))
                                                       for p in (1, 7, 31)]).alias("value"))
    exact = W.distinct_word_count(W.word_count(docs)).first().distinct_words
    for buckets in (1, 6):
        estimate = W.approx_distinct_words(W.word_sketches(docs, buckets)).first().distinct_words
        assert abs(estimate - exact) <= 4 * 1.04 / 2 ** 7 * exact
    assert W.approx_distinct_words(W.word_sketches(docs.limit(0), 3)).first().distinct_words == 0
    with pytest.raises(ValueError):
        W.word_sketches(docs, 0)


def test_sink_replaces_a_table_whole(spark, tmp_path):
    path = str(tmp_path / "result")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    made = []
    for n in (10, 20, 30):
        made.append(publish(spark.range(n).withColumn("part", F.pmod("id", F.lit(3))), path, ("part",)))
        assert sorted(r.id for r in read_published(spark, path).collect()) == list(range(n))
    assert read_published(spark, path).filter("part = 1").count() == 10
    assert spark.read.parquet(made[1]).count() == 20  # readers of the version before go on
    assert {p.name for p in (tmp_path / "result").iterdir() if not p.name.startswith(".")} == {
        "CURRENT", made[1].rsplit("/", 1)[1], made[2].rsplit("/", 1)[1]}
    with pytest.raises(Exception, match="boom"):
        publish(spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id")), path)
    assert read_published(spark, path).count() == 30


def test_sink_of_an_empty_result(spark, tmp_path):
    publish(spark.range(0), str(tmp_path / "none"))
    assert read_published(spark, str(tmp_path / "none")).count() == 0
