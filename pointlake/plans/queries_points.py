"""Driver queries for points and k-center, with generated DuckDB oracles.

PT2  = customers as 2-D points [c_acctbal/1000, c_nationkey], id c_custkey.
PT64 = embeddings as 64-D points, id vec_id.
Both are read whole. The greedy solver runs on the coreset (bounded by k, z
and L); everything that touches the whole table is linear in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geometry as G
from ..operators import kcenter as KC
from ..operators.center_index import nearest_of_many
from ..operators.coreset_tree import tree_coreset
from ..operators.fft import fft_centers, fft_coreset
from ..sources.points import points_from_array, points_from_columns
from . import oracle_points as O
from .queries import register
from .session import read_table

# Fixed query parameters.
PT64_PARTS, PT64_STEPS = 4, 8        # per-partition traversal on embeddings
PT64_K = 8                           # whole-table traversal centers for assignment
K, Z, L = 10, 20, 4                  # k-center with outliers on customers


def pt2(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    return points_from_columns(c, "c_custkey", [F.col("c_acctbal") / F.lit(1000.0),
                                                F.col("c_nationkey")])


def pt64(spark: SparkSession, sf: str) -> DataFrame:
    return points_from_array(read_table(spark, sf, "embeddings"), "vec_id", "embedding")


def _centers64(spark, sf):
    pts = pt64(spark, sf)
    c = fft_centers(pts, PT64_K, 1)
    return pts, c.select(F.col("step").alias("center_no"), "point_id", "point")


def _coreset2(spark, sf):
    return fft_coreset(pt2(spark, sf), K + Z + 1, L)


def _mr(spark, sf):
    return KC.mr_kcenter_outliers(pt2(spark, sf), K, Z, L, alpha=2)


# ---------------------------------------------------------------- oracle pieces

_PT64 = [f"pt64 AS ({O.PT64_SQL})"]
_PT2 = [f"pt2 AS ({O.PT2_SQL})"]
_FFT64, _FFT64_FINAL = O.fft_ctes("f64", "pt64", PT64_STEPS, PT64_PARTS)
_C64, _C64_FINAL = O.fft_ctes("c64", "pt64", PT64_K, 1)
_C64 = _C64 + [f"cent64 AS (SELECT chosen AS center_no, point_id, point FROM {_C64_FINAL} "
               f"WHERE chosen IS NOT NULL)"]
_NEAR64 = [
    "near64 AS (SELECT point_id, center_no, dist FROM ("
    f"SELECT p.point_id, c.center_no, {O.dist('p.point', 'c.point')} AS dist, "
    "row_number() OVER (PARTITION BY p.point_id ORDER BY "
    f"{O.dist('p.point', 'c.point')}, c.center_no) AS rn FROM pt64 p, cent64 c) WHERE rn = 1)"]
_CORE2, _CORE2_NAME = O.coreset_ctes("k2", "pt2", K + Z + 1, L)
_P2 = [f"solver_in AS (SELECT CAST(part_id AS BIGINT) * {K + Z + 1} + step AS idx, point_id, "
       f"point, weight FROM {_CORE2_NAME})"]
_SOLVE2, _S2 = O.solver_ctes("s2", "solver_in", K, Z, 2)
_SOLVE0, _S0 = O.solver_ctes("s0", "solver_in", K, Z, 0)
_OBJ2 = [f"objd AS (SELECT p.point_id, min({O.dist('p.point', 'c.point')}) AS dist "
         f"FROM pt2 p, {_S2['centers']} c GROUP BY p.point_id)"]


# ---------------------------------------------------------------- queries

@register("points_source", O.with_ctes(_PT64, (
    "SELECT point_id, CAST(len(point) AS INTEGER) AS dim, "
    "list_reduce(point, lambda _a, _b: _a + _b) AS coord_sum FROM pt64")))
def q_points_source(spark, sf):
    p = pt64(spark, sf)
    return p.select("point_id", F.size("point").alias("dim"),
                    F.aggregate("point", F.lit(0.0), lambda a, b: a + b).alias("coord_sum"))


@register("fft_centers", O.with_ctes(_PT64 + _FFT64, (
    f"SELECT part_id, CAST(chosen AS INTEGER) AS step, point_id FROM {_FFT64_FINAL} "
    "WHERE chosen IS NOT NULL")))
def q_fft_centers(spark, sf):
    c = fft_centers(pt64(spark, sf), PT64_STEPS, PT64_PARTS)
    return c.select("part_id", "step", "point_id")


@register("nearest_center", O.with_ctes(_PT64 + _C64 + _NEAR64,
                                        "SELECT point_id, CAST(center_no AS BIGINT) AS center_no, "
                                        "dist FROM near64"))
def q_nearest_center(spark, sf):
    pts, c = _centers64(spark, sf)
    return G.nearest_center(pts, c, PT64_K)


@register("point_center_distance", O.with_ctes(_PT64 + _C64 + _NEAR64,
                                               "SELECT point_id, dist FROM near64"))
def q_point_center_distance(spark, sf):
    pts, c = _centers64(spark, sf)
    return G.point_center_distance(pts, c, PT64_K)


@register("cluster_sizes", O.with_ctes(_PT64 + _C64 + _NEAR64, (
    "SELECT CAST(center_no AS BIGINT) AS center_no, count(*) AS n_points FROM near64 "
    "GROUP BY center_no")))
def q_cluster_sizes(spark, sf):
    pts, c = _centers64(spark, sf)
    return G.cluster_sizes(G.nearest_center(pts, c, PT64_K))


@register("coreset_points", O.with_ctes(_PT2 + _CORE2,
                                        f"SELECT part_id, step, point_id, weight FROM {_CORE2_NAME}"))
def q_coreset_points(spark, sf):
    return _coreset2(spark, sf).select("part_id", "step", "point_id", "weight")


@register("coreset_summary", O.with_ctes(_PT2 + _CORE2, (
    "SELECT count(*) AS coreset_points, CAST(sum(weight) AS BIGINT) AS coreset_weight "
    f"FROM {_CORE2_NAME}")))
def q_coreset_summary(spark, sf):
    return _coreset2(spark, sf).agg(F.count(F.lit(1)).alias("coreset_points"),
                                    F.sum("weight").cast("bigint").alias("coreset_weight"))


def _solver_input(spark, sf):
    return KC.coreset_order(_coreset2(spark, sf), K + Z + 1)


@register("initial_guess", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE2,
                                       f"SELECT r0 AS initial_guess FROM {_S2['r0']}"))
def q_initial_guess(spark, sf):
    P = _solver_input(spark, sf)
    return P.sparkSession.createDataFrame([(KC.initial_guess(P, K, Z)["r0"],)], "initial_guess double")


def _first_round(spark, sf, alpha=2):
    P = _solver_input(spark, sf)
    r0 = KC.initial_guess(P, K, Z)["r0"]
    bw = KC.ball_weights(P, P, (1 + 2 * alpha) * r0)
    return P, r0, bw


@register("ball_weights", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE2,
                                      "SELECT point_id, bw AS ball_weight FROM s2_bw1 WHERE g = 1"))
def q_ball_weights(spark, sf):
    _, _, bw = _first_round(spark, sf)
    return bw.select("point_id", "ball_weight")


@register("heaviest_ball", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE2, (
    "SELECT b.point_id, b.bw AS ball_weight FROM s2_bw1 b JOIN s2_c1 c "
    "ON b.g = c.g AND b.idx = c.idx WHERE b.g = 1")))
def q_heaviest_ball(spark, sf):
    _, _, bw = _first_round(spark, sf)
    return KC.heaviest_ball(bw).select("point_id", "ball_weight")


@register("ball_removal", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE2, (
    "SELECT point_id, weight FROM s2_u1 WHERE g = 1")))
def q_ball_removal(spark, sf):
    P, r0, bw = _first_round(spark, sf)
    hb = KC.heaviest_ball(bw).select("idx")
    center = P.join(hb, "idx").select("point")
    return KC.ball_removal(P, center, (3 + 4 * 2) * r0).select("point_id", "weight")


@register("kcenter_mr", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE2,
                                    f"SELECT center_no, point_id FROM {_S2['centers']}"))
def q_kcenter_mr(spark, sf):
    return _mr(spark, sf).solution.centers.select("center_no", "point_id")


@register("weighted_kcenter", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE0,
                                          f"SELECT center_no, point_id FROM {_S0['centers']}"))
def q_weighted_kcenter(spark, sf):
    sol = KC.solve_weighted_outliers(_solver_input(spark, sf), K, Z, alpha=0)
    return sol.centers.select("center_no", "point_id")


@register("weighted_kcenter_report", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE0,
                                                 f"SELECT * FROM {_S0['report']}"))
def q_weighted_kcenter_report(spark, sf):
    sol = KC.solve_weighted_outliers(_solver_input(spark, sf), K, Z, alpha=0)
    return sol.report


@register("kcenter_objective", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE2 + _OBJ2, (
    f"SELECT dist AS objective FROM objd ORDER BY dist DESC LIMIT 1 OFFSET {Z}")))
def q_kcenter_objective(spark, sf):
    mr = KC.mr_kcenter_outliers(pt2(spark, sf), K, Z, L, alpha=2, with_objective=False)
    return G.kcenter_objective(pt2(spark, sf), mr.solution.centers, Z, K)


@register("kcenter_outliers", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE2 + _OBJ2, (
    f"SELECT point_id, dist FROM objd ORDER BY dist DESC, point_id LIMIT {Z}")))
def q_kcenter_outliers(spark, sf):
    mr = KC.mr_kcenter_outliers(pt2(spark, sf), K, Z, L, alpha=2, with_objective=False)
    return G.kcenter_outliers(pt2(spark, sf), mr.solution.centers, Z, K)


@register("kcenter_report", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE2 + _OBJ2, (
    f"SELECT r.k, r.z, CAST({L} AS INTEGER) AS parts, r.alpha, "
    f"(SELECT count(*) FROM {_CORE2_NAME}) AS coreset_points, "
    f"(SELECT CAST(sum(weight) AS BIGINT) FROM {_CORE2_NAME}) AS coreset_weight, "
    "r.initial_guess, r.final_guess, r.n_guesses, r.n_centers, "
    f"(SELECT dist FROM objd ORDER BY dist DESC LIMIT 1 OFFSET {Z}) AS objective "
    f"FROM {_S2['report']} r")))
def q_kcenter_report(spark, sf):
    return _mr(spark, sf).report


def _cover0(spark, sf):
    P = _solver_input(spark, sf)
    return KC.greedy_cover(P, K, KC.initial_guess(P, K, Z)["r0"], alpha=0)


@register("greedy_cover", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE0, (
    "SELECT CAST(center_no AS INTEGER) AS center_no, point_id FROM ("
    + " UNION ALL ".join(f"SELECT * FROM s0_c{t}" for t in range(1, K + 1))
    + ") WHERE g = 1")))
def q_greedy_cover(spark, sf):
    centers, _ = _cover0(spark, sf)
    return centers.select("center_no", "point_id")


@register("greedy_cover_uncovered", O.with_ctes(_PT2 + _CORE2 + _P2 + _SOLVE0, (
    "SELECT CAST(wz AS BIGINT) AS uncovered_weight FROM s0_left WHERE g = 1")))
def q_greedy_cover_uncovered(spark, sf):
    _, left = _cover0(spark, sf)
    return spark.createDataFrame([(left,)], "uncovered_weight bigint")


@register("coreset_weights", O.with_ctes(_PT2 + _CORE2, (
    f"SELECT part_id, step, weight FROM {_CORE2_NAME}")))
def q_coreset_weights(spark, sf):
    """A17: weight of each traversal center = points of its partition nearest to it."""
    return _coreset2(spark, sf).select("part_id", "step", "weight")


# ---------------------------------------------------------------- event values
# Events as 1-D points [value] (id event_id). The value has a long right tail
# and many repeated values, so the outlier-aware solve is non-trivial at α = 2.
EK, EZ, EL = 4, 50, 8

_PEV = [f"pev AS ({O.PEV_SQL})"]
_COREEV, _COREEV_NAME = O.coreset_ctes("ke", "pev", EK + EZ + 1, EL)
_PE = [f"solver_ev AS (SELECT CAST(part_id AS BIGINT) * {EK + EZ + 1} + step AS idx, point_id, "
       f"point, weight FROM {_COREEV_NAME})"]
_SOLVEEV, _SE = O.solver_ctes("se", "solver_ev", EK, EZ, 2)
_OBJEV = [f"objev AS (SELECT p.point_id, min({O.dist('p.point', 'c.point')}) AS dist "
          f"FROM pev p, {_SE['centers']} c GROUP BY p.point_id)"]


def pev(spark: SparkSession, sf: str) -> DataFrame:
    return points_from_columns(read_table(spark, sf, "events"), "event_id", ["value"])


def _mr_events(spark, sf, with_objective=True):
    return KC.mr_kcenter_outliers(pev(spark, sf), EK, EZ, EL, alpha=2,
                                  with_objective=with_objective)


@register("event_kcenter_mr", O.with_ctes(_PEV + _COREEV + _PE + _SOLVEEV,
                                          f"SELECT center_no, point_id FROM {_SE['centers']}"))
def q_event_kcenter_mr(spark, sf):
    return _mr_events(spark, sf, with_objective=False).solution.centers.select(
        "center_no", "point_id")


@register("event_kcenter_report", O.with_ctes(_PEV + _COREEV + _PE + _SOLVEEV + _OBJEV, (
    f"SELECT r.k, r.z, CAST({EL} AS INTEGER) AS parts, r.alpha, "
    f"(SELECT count(*) FROM {_COREEV_NAME}) AS coreset_points, "
    f"(SELECT CAST(sum(weight) AS BIGINT) FROM {_COREEV_NAME}) AS coreset_weight, "
    "r.initial_guess, r.final_guess, r.n_guesses, r.n_centers, "
    f"(SELECT dist FROM objev ORDER BY dist DESC LIMIT 1 OFFSET {EZ}) AS objective "
    f"FROM {_SE['report']} r")))
def q_event_kcenter_report(spark, sf):
    return _mr_events(spark, sf).report


@register("event_kcenter_outliers", O.with_ctes(_PEV + _COREEV + _PE + _SOLVEEV + _OBJEV, (
    f"SELECT point_id, dist FROM objev ORDER BY dist DESC, point_id LIMIT {EZ}")))
def q_event_kcenter_outliers(spark, sf):
    mr = _mr_events(spark, sf, with_objective=False)
    return G.kcenter_outliers(pev(spark, sf), mr.solution.centers, EZ, EK)


@register("event_coreset", O.with_ctes(_PEV + _COREEV,
                                       f"SELECT part_id, step, point_id, weight FROM {_COREEV_NAME}"))
def q_event_coreset(spark, sf):
    """The traversal on the largest point table."""
    return fft_coreset(pev(spark, sf), EK + EZ + 1, EL).select("part_id", "step", "point_id", "weight")


# Few centers and many outliers: the first guess is far below the feasible one, so the
# search goes past its first chunk of guesses and the solution uses all centers.
FK, FZ, FL = 3, 60, 2
_COREFAR, _COREFAR_NAME = O.coreset_ctes("kf", "pev", FK + FZ + 1, FL)
_PF = [f"solver_far AS (SELECT CAST(part_id AS BIGINT) * {FK + FZ + 1} + step AS idx, point_id, "
       f"point, weight FROM {_COREFAR_NAME})"]
_SOLVEFAR, _SF = O.solver_ctes("sf", "solver_far", FK, FZ, 0)


@register("event_kcenter_late_guess", O.with_ctes(_PEV + _COREFAR + _PF + _SOLVEFAR, f"SELECT * FROM {_SF['report']}"))
def q_event_kcenter_late_guess(spark, sf):
    core = fft_coreset(pev(spark, sf), FK + FZ + 1, FL)
    return KC.solve_weighted_outliers(KC.coreset_order(core, FK + FZ + 1), FK, FZ, alpha=0).report


@register("coreset_points_passes", O.with_ctes(_PT2 + _CORE2,
                                               f"SELECT part_id, step, point_id, weight FROM {_CORE2_NAME}"))
def q_coreset_points_passes(spark, sf):
    """The coreset of points that are spread over more tasks than parts: candidates of
    several tasks meet in every pass."""
    return fft_coreset(pt2(spark, sf).repartition(3 * L, "point_id"), K + Z + 1, L).select(
        "part_id", "step", "point_id", "weight")


@register("points_text_source", O.with_ctes(_PT2, (
    "SELECT point_id, CAST(len(point) AS INTEGER) AS dim, "
    "list_reduce(point, lambda _a, _b: _a + _b) AS coord_sum FROM pt2")))
def q_points_text_source(spark, sf):
    """The text point parser on whole tables: every customer point rendered as
    a comma-separated line (odd ids with a trailing comma, which the parser
    forgives) and parsed back."""
    from ..sources.points import parse_point
    p = pt2(spark, sf)
    text = F.concat_ws(",", F.transform("point", lambda x: x.cast("string")))
    line = F.when(F.pmod(F.col("point_id"), F.lit(2)) == 1, F.concat(text, F.lit(","))) \
            .otherwise(text)
    parsed = p.select("point_id", parse_point(line).alias("point"))
    return parsed.select("point_id", F.size("point").alias("dim"),
                         F.aggregate("point", F.lit(0.0), lambda a, b: a + b).alias("coord_sum"))


# A tenth of all events as outliers of four whole-table centers: far more than a top-z in one task should hold.
_CEV, _CEV_FINAL = O.fft_ctes("cev", "pev", EK, 1)
_CEV = _CEV + [f"centev AS (SELECT chosen AS center_no, point_id, point FROM {_CEV_FINAL} WHERE chosen IS NOT NULL)",
               f"farev AS (SELECT p.point_id, min({O.dist('p.point', 'c.point')}) AS dist FROM pev p, centev c "
               "GROUP BY p.point_id)",
               "rankev AS (SELECT *, row_number() OVER (ORDER BY dist DESC, point_id) AS rn, "
               "count(*) OVER () // 10 AS z FROM farev)"]


def _events_and_centers(spark, sf):
    pts = pev(spark, sf)
    centers = fft_centers(pts, EK, 1).select(F.col("step").alias("center_no"), "point")
    return pts, centers, pts.count() // 10


@register("event_objective_tenth", O.with_ctes(_PEV + _CEV, "SELECT dist AS objective FROM rankev WHERE rn = z + 1"))
def q_event_objective_tenth(spark, sf):
    pts, centers, z = _events_and_centers(spark, sf)
    return G.objective_by_selection(pts, centers, z, EK)


@register("event_outliers_tenth", O.with_ctes(_PEV + _CEV, "SELECT point_id, dist FROM rankev WHERE rn <= z"))
def q_event_outliers_tenth(spark, sf):
    pts, centers, z = _events_and_centers(spark, sf)
    return G.outliers_by_selection(pts, centers, z, EK)


# Hundreds of centers: the coreset of the events as the center set.
_MANY = [f"manyev AS (SELECT CAST(part_id AS BIGINT) * {EK + EZ + 1} + step AS center_no, point FROM {_COREEV_NAME})",
         "nearmany AS (SELECT point_id, min(ROW(dist, center_no)) AS m FROM (SELECT p.point_id, c.center_no, "
         f"{O.dist('p.point', 'c.point')} AS dist FROM pev p, manyev c) GROUP BY point_id)"]


@register("event_nearest_many", O.with_ctes(_PEV + _COREEV + _MANY,
                                            "SELECT point_id, m[2] AS center_no, m[1] AS dist FROM nearmany"))
def q_event_nearest_many(spark, sf):
    core = fft_coreset(pev(spark, sf), EK + EZ + 1, EL)
    centers = core.select((F.col("part_id").cast("bigint") * (EK + EZ + 1) + F.col("step")).alias("center_no"), "point")
    return nearest_of_many(pev(spark, sf), centers, EL * (EK + EZ + 1))


# Merge and reduce: 64 leaves, merged by eight, twice.
TREE_CENTERS, TREE_LEAVES, TREE_FAN = 16, 64, 8
_TREE, _LEAVES = O.coreset_ctes("t0", "pev", TREE_CENTERS, TREE_LEAVES)
_MID, _MID_NAME = O.coreset_ctes("t1", _LEAVES, TREE_CENTERS, TREE_LEAVES // TREE_FAN, "weight")
_ROOT, _ROOT_NAME = O.coreset_ctes("t2", _MID_NAME, TREE_CENTERS, 1, "weight")


@register("event_coreset_tree", O.with_ctes(_PEV + _TREE + _MID + _ROOT,
                                            f"SELECT step, point_id, weight FROM {_ROOT_NAME}"))
def q_event_coreset_tree(spark, sf):
    return tree_coreset(pev(spark, sf), TREE_CENTERS, TREE_LEAVES, TREE_FAN).select("step", "point_id", "weight")
