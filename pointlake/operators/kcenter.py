"""Weighted k-center with z outliers (greedy ball cover with radius guesses)
and the two-round coreset algorithm built on it.

Greedy cover at radius guess r (the 3-approximation of Charikar et al.):
while fewer than k centers and uncovered weight > 0, pick the point x of P
(covered or not) whose ball of radius (1+2α)r holds the most uncovered weight
(lowest index on ties, only positive weights count), then mark every uncovered
point within (3+4α)r of x covered. A guess succeeds when the uncovered weight
is ≤ z; the sequential algorithm doubles r from r0 until one does.

The guesses r0·2^(g-1) run together in chunks (smallest first); the answer is
the smallest feasible one, which is what the doubling loop returns (doubling is
exact in floating point). The last guess of the ladder covers everything with
one ball: (3+4α)·r0·2^(G-1) ≥ 2·max_x d(x, first point) ≥ diameter.

Ball weights come from a range join on metric blocks (``metric``): only blocks that the
triangle inequality lets come within a ball of each other meet, and no pair becomes a row. They
are counted once per chunk of guesses; a round then lowers them by the points that its new centers
cover, which touches the blocks near those centers only (``Cover``). A round is one job that moves these blocks;
the driver sees the best point per changed block and guess, and keeps a few numbers per block.
How many pairs were compared is part of the solution.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.distance import euclidean
from ..plans.limits import check_broadcast_bound, point_bytes
from ..plans.session import Stored, cut_lineage
from .fft import distances, fft_coreset, matrix
from .geometry import kcenter_objective
from .metric import PIVOTS, SLACK, Blocks, pivots_of, range_grid

#: Cells of a distance matrix computed at once.
CELLS = 1_000_000


@dataclass
class KCenterSolution:
    centers: DataFrame        # center_no, point_id, point
    report: DataFrame         # one row
    initial_guess: float
    final_guess: float
    n_guesses: int
    pairs_compared: int       # in all rounds of all guesses


def _solver_input(P: DataFrame) -> DataFrame:
    return P.select(F.col("idx").cast("bigint").alias("idx"), F.col("point_id").cast("bigint").alias("point_id"),
                    F.col("point").cast("array<double>").alias("point"), F.col("weight").cast("bigint").alias("weight"))


# ---------------------------------------------------------------- ball weights by range join

def _near(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Distance matrices of slices of ``x`` against all of ``y``."""
    if x.shape[1] != y.shape[1]:
        raise ValueError("points of different dimension")
    step = max(1, CELLS // max(1, len(y)))
    for lo in range(0, len(x), step):
        at = slice(lo, min(len(x), lo + step))
        total = np.zeros((at.stop - lo, len(y)))
        for k in range(x.shape[1]):
            gap = x[at, k, None] - y[None, :, k]
            total += gap * gap
        yield at, np.sqrt(total)


@dataclass
class Round:
    """What a task needs: per guess the ball radius, the cover radius, the centers before this round, and the new
    one (None: no change). Without centers at all, a round counts the balls for the first time."""

    ball: list[float]
    cover: list[float]
    before: list[list[np.ndarray]]
    new: list[np.ndarray | None] | None = None

    def changed(self, points: np.ndarray) -> np.ndarray:
        """guesses x points: at first every point, then those that the new centers cover and no earlier one did."""
        out = np.ones((len(self.ball), len(points)), bool)
        for g in range(len(self.ball)) if self.new is not None else ():
            if self.new[g] is None:
                out[g] = False
                continue
            out[g] = distances(points, self.new[g]) <= self.cover[g]
            for c in self.before[g]:
                out[g] &= ~(distances(points, c) <= self.cover[g])
        return out


#: A block's points with the ball weights per guess (flat), the best point per guess, the weight the block lost, and the pairs compared.
STATE = ("cand int, idx array<bigint>, point_id array<bigint>, point array<array<double>>, weight array<bigint>, "
         "best array<struct<bw:bigint,idx:bigint,point_id:bigint,point:array<double>>>, lost array<bigint>, pairs bigint")


class _Block:
    """A candidate block while its members stream by."""

    def __init__(self, cand: int, idx: pa.Array, ids: pa.Array, points: pa.Array, weight: np.ndarray, guesses: int):
        self.cand, self.idx, self.ids, self.points = cand, idx, ids, points
        self.at, self.weight = matrix(points), weight.reshape(guesses, -1).copy()
        self.lost, self.pairs = np.zeros(guesses, np.int64), 0

    def meet(self, member: int, points: np.ndarray, weight: np.ndarray, round_: Round) -> None:
        changed = round_.changed(points)
        if member == self.cand and round_.new is not None:
            self.lost += changed @ weight
        rows = changed.any(axis=0)
        if not rows.any():
            return
        sign, w = 1 if round_.new is None else -1, np.where(changed, weight, 0)[:, rows].astype(float)  # sums below 2**53 are exact
        self.pairs += len(self.at) * int(rows.sum())
        for at, d in _near(self.at, points[rows]):
            for g, r in enumerate(round_.ball):
                self.weight[g, at] += sign * ((d <= r).astype(float) @ w[g]).astype(np.int64)

    def row(self) -> dict:
        idx, best = self.idx.to_numpy(), []
        for own in self.weight:
            i = np.flatnonzero(own == own.max())
            i = int(i[idx[i].argmin()])
            best.append({"bw": int(own[i]), "idx": int(idx[i]), "point_id": self.ids[i].as_py(), "point": self.at[i].tolist()})
        return {"cand": self.cand, "idx": self.idx, "point_id": self.ids, "point": self.points, "weight": pa.array(self.weight.reshape(-1)),
                "best": best, "lost": self.lost.tolist(), "pairs": self.pairs}


def _counted(round_: Round) -> Callable:
    """Streams a range grid; a STATE row per candidate block."""
    best = pa.list_(pa.struct([("bw", pa.int64()), ("idx", pa.int64()), ("point_id", pa.int64()), ("point", pa.list_(pa.float64()))]))

    def one(value: pa.Array, kind: pa.DataType | None = None) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value if kind is None else value.cast(kind))

    def batch_of(r: dict) -> pa.RecordBatch:
        arrays = [pa.array([r["cand"]], pa.int32()), one(r["idx"]), one(r["point_id"]), one(r["point"]), one(r["weight"]),
                  pa.array([r["best"]], best), pa.array([r["lost"]], pa.list_(pa.int64())), pa.array([r["pairs"]], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["cand", "idx", "point_id", "point", "weight", "best", "lost", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for i in range(len(batch)):
                cand, member = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                idx, ids, points, weight = (batch.column(c)[i].values for c in (2, 3, 4, 5))
                if member < 0:
                    if held:
                        yield batch_of(held.row())
                    held = _Block(cand, idx, ids, points, weight.to_numpy(), len(round_.ball))
                else:
                    held.meet(member, matrix(points), weight.to_numpy(), round_)
        if held:
            yield batch_of(held.row())

    return run


def _parts(spark, cands: int) -> int:
    return max(1, min(cands, int(spark.conf.get("spark.sql.shuffle.partitions"))))


class Cover:
    """The greedy cover of all guesses at once. Ball weights are counted in the first round and from then on lowered
    by what the new centers cover: a round touches the blocks that a new center reaches, and the candidate blocks
    within a ball of those. A block's weights live in the version of the last round that changed them."""

    def __init__(self, blocks: Blocks, radii: list[float], coef1: int, coef2: int):
        self.blocks, self.spark = blocks, blocks.rows.sparkSession
        self.ball, self.cover = [coef1 * r for r in radii], [coef2 * r for r in radii]
        self.centers: list[list[np.ndarray]] = [[] for _ in radii]
        self.picks: list[list[tuple[int, int, list[float]]]] = [[] for _ in radii]
        near = blocks.between(blocks) <= max(self.ball)
        self.near = {int(c): blocks.number[near[i]].tolist() for i, c in enumerate(blocks.number)}
        self.versions: dict[int, Stored] = {}
        self.where: dict[int, int] = {}
        self.best: dict[int, list] = {}
        self.lost = np.zeros(len(radii), np.int64)
        self.pairs = 0

    def _run(self, state: DataFrame, pairs: list[tuple[int, int]], round_: Round, turn: int) -> None:
        cands = {c for c, _ in pairs}
        grid = range_grid(state, self.blocks.rows, pairs, _parts(self.spark, len(cands)))
        # written: the plan of a round does not hold those before it, and a lost executor repeats no earlier round
        new = self.versions[turn] = Stored.write(grid.mapInArrow(_counted(round_), STATE), "cover")
        for r in new.df.select("cand", "best", "lost", "pairs").collect():  # a row per changed block
            self.best[r.cand] = r.best
            self.where[r.cand] = turn
            self.lost += r.lost
            self.pairs += r.pairs
        for old in set(self.versions) - set(self.where.values()) - {turn}:
            self.versions.pop(old).delete()

    def count(self) -> None:
        """The first round: every ball."""
        guesses = len(self.ball)
        zero = F.array_repeat(F.lit(0).cast("bigint"), F.size("idx") * guesses)
        state = self.blocks.rows.select(F.col("block").alias("cand"), "idx", "point_id", "point", zero.alias("weight"))
        pairs = [(c, m) for c, own in self.near.items() for m in own]
        self._run(state, pairs, Round(self.ball, self.cover, self.centers), 0)

    def choose(self) -> list[np.ndarray | None]:
        """The heaviest ball of each guess (lowest idx on ties); None where none has weight."""
        new: list[np.ndarray | None] = []
        for g in range(len(self.ball)):
            r = max((b[g] for b in self.best.values()), key=lambda r: (r.bw, -r.idx), default=None)
            new.append(np.array(r.point) if r is not None and r.bw > 0 else None)
            if new[-1] is not None:
                self.picks[g].append((r.idx, r.point_id, list(r.point)))
        return new

    def lower(self, new: list[np.ndarray | None], turn: int, last: bool) -> None:
        """Take what the new centers cover out of the balls (``last``: only out of the weight that is left)."""
        reached = np.zeros(len(self.blocks.number), bool)
        for g, c in enumerate(new):
            if c is not None:
                reached |= self.blocks.from_point(c) <= self.cover[g]
        members = self.blocks.number[reached].tolist()
        pairs = [(m, m) for m in members] if last else [(c, m) for m in members for c in self.near[m]]
        cands, parts = {c for c, _ in pairs}, []
        for v in {self.where[c] for c in cands}:
            parts.append(self.versions[v].df.filter(F.col("cand").isin([c for c in cands if self.where[c] == v])).select("cand", "idx", "point_id", "point", "weight"))
        state = parts[0]
        for more in parts[1:]:
            state = state.unionAll(more)
        self._run(state, pairs, Round(self.ball, self.cover, [list(c) for c in self.centers], new), turn)
        for g, c in enumerate(new):
            if c is not None:
                self.centers[g].append(c)

    def release(self) -> None:
        for stored in self.versions.values():
            stored.delete()


def _cover_rounds(blocks: Blocks, k: int, radii: list[float], coef1: int, coef2: int, total: int):
    """k greedy rounds for all radii at once: per radius the centers
    ``[(idx, point_id, point)]`` and the uncovered weight; and the pairs compared."""
    cover = Cover(blocks, radii, coef1, coef2)
    try:
        cover.count()
        for turn in range(1, k + 1):
            new = cover.choose()
            if all(c is None for c in new):
                break
            cover.lower(new, turn, turn == k)
        return cover.picks, (total - cover.lost).tolist(), cover.pairs
    finally:
        cover.release()


# ---------------------------------------------------------------- operators

def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least positive distance inside each block. Points are swept by their distance to the block's first point: only
    those whose distances to it differ by less than the best so far can be closer."""
    low = math.inf
    for batch in batches:
        for i in range(len(batch)):
            points = np.unique(matrix(batch.column(0)[i].values), axis=0)
            if len(points) > 1:
                order = distances(points, points[0])
                points, order = points[order.argsort(kind="stable")], np.sort(order)
                for shift in range(1, len(points)):
                    close = np.flatnonzero(order[shift:] - order[:-shift] <= low * (1 + SLACK))
                    if not len(close):
                        break
                    d = np.sqrt(sum((points[close + shift, k] - points[close, k]) ** 2 for k in range(points.shape[1])))
                    low = min(low, d[d > 0].min(initial=math.inf))
    yield pa.RecordBatch.from_arrays([pa.array([low])], names=["d"])


def _across(pivots: np.ndarray, cell: dict[int, int], low: dict[int, float], high: dict[int, float], best: float) -> Callable:
    """Least positive distance between a block and its neighbours, whose points only count within ``best`` of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, held, cand = best, None, -1
        for batch in batches:
            for i in range(len(batch)):
                points, member = matrix(batch.column(4)[i].values), batch.column(1)[i].as_py()
                if member < 0:
                    held, cand = np.unique(points, axis=0), batch.column(0)[i].as_py()
                    continue
                d = distances(points, pivots[cell[cand]])
                points = np.unique(points[(d <= (high[cand] + least) * (1 + SLACK)) & (d >= low[cand] - least - SLACK * (d + least))], axis=0)
                for _, d in _near(held, points) if len(points) else ():
                    least = min(least, d[d > 0].min(initial=math.inf))
        yield pa.RecordBatch.from_arrays([pa.array([least])], names=["d"])

    return run


def closest_pair(blocks: Blocks) -> float | None:
    """Smallest positive distance of two points; None if all coincide. First inside every block, then between blocks
    that can come closer than that, where a block sends its points near the border only."""
    def least(df: DataFrame) -> float:
        return min((r.d for r in df.collect()), default=math.inf)  # a row per task

    best = least(blocks.rows.select("point").mapInArrow(_within, "d double"))
    if math.isinf(best):  # every block holds copies of one point
        best = 2 * float(distances(blocks.pivots, blocks.pivots[0]).max() + blocks.high.max()) + 1  # more than any distance
    near = blocks.between(blocks) < best
    number = blocks.number.tolist()
    pairs = [(number[i], number[j]) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True)]
    if pairs:
        state = blocks.rows.withColumnRenamed("block", "cand").filter(F.col("cand").isin(sorted({a for a, _ in pairs})))
        grid = range_grid(state, blocks.rows, pairs, _parts(blocks.rows.sparkSession, len(pairs)))
        of = lambda x: dict(zip(number, x.tolist(), strict=True))
        found = least(grid.mapInArrow(_across(blocks.pivots, of(blocks.cell), of(blocks.low), of(blocks.high), best), "d double"))
        best = min(best, found)
    ends = blocks.rows.select(F.array_min("point").alias("a"), F.array_max("point").alias("b")).agg(F.min("a"), F.max("b")).first()
    return None if ends[0] == ends[1] else best


def initial_guess(P: DataFrame, k: int, z: int) -> dict:
    """Guess statistics: ``r0`` = half the smallest positive distance among the
    first k+z+1 points by ``idx`` (else among all; 0 if all coincide; infinity
    for a single point), ``reach`` = largest distance from the first point,
    ``n_points``, ``total_weight``, and the first points themselves (``head``).

    The head (≤ k+z+1 points, a parameter bound) travels to the tasks as one
    constant; everything else is a single aggregate over P."""
    head = P.orderBy("idx").limit(k + z + 1).select("idx", "point").collect()
    if not head:
        return {"r0": None, "reach": None, "n_points": 0, "total_weight": 0, "dim_min": None, "dim_max": None, "head": []}
    check_broadcast_bound(len(head), point_bytes(len(head[0]["point"])), "head of the order")
    last = head[-1]["idx"]
    head_val = F.from_json(F.lit(json.dumps([list(r["point"]) for r in head])), "array<array<double>>")
    pos_min = F.array_min(F.filter(F.transform(head_val, lambda y: euclidean(F.col("point"), y)), lambda d: d > 0))
    row = P.agg(
        F.min(F.when(F.col("idx") <= F.lit(last), pos_min)).alias("head_min"),
        F.max(euclidean(F.col("point"), F.element_at(head_val, 1))).alias("reach"),
        F.count(F.lit(1)).alias("n_points"), F.sum("weight").cast("bigint").alias("total_weight"),
        F.min(F.size("point")).alias("dim_min"), F.max(F.size("point")).alias("dim_max")).first().asDict()
    row["head"] = [list(r["point"]) for r in head]
    low = row.pop("head_min")
    if row["dim_min"] != row["dim_max"]:
        raise ValueError("points of different dimension")
    if row["n_points"] == 1:
        row["r0"] = math.inf
    elif low is None and row["reach"] > 0:
        with metric_blocks(P, row) as blocks:
            row["r0"] = closest_pair(blocks) / 2
    else:
        row["r0"] = 0.0 if low is None else low / 2
    return row


@contextmanager
def metric_blocks(P: DataFrame, stats: dict) -> Iterator[Blocks]:
    """Blocks of P around points of the head of its order, until the end of the context."""
    blocks = Blocks.build(P, pivots_of(stats["head"], stats["n_points"]), stats["n_points"])
    try:
        yield blocks
    finally:
        blocks.release()


def ball_weights(P: DataFrame, uncovered: DataFrame, radius: float) -> DataFrame:
    """(idx, point_id, ball_weight): for every x in P, the weight of the
    ``uncovered`` points within ``radius`` of x (one guess, one round). Written to
    the checkpoint folder, as the blocks it is made from are given back."""
    P, uncovered = _solver_input(P), _solver_input(uncovered)
    n, left = P.count(), uncovered.count()
    if not n or not left:
        return P.select("idx", "point_id", F.lit(0).cast("bigint").alias("ball_weight"))
    pivots = pivots_of([r.point for r in P.orderBy("idx").limit(PIVOTS).select("point").collect()], n)
    ours, theirs = Blocks.build(P, pivots, n), Blocks.build(uncovered, pivots, left)
    try:
        near = ours.between(theirs) <= radius
        pairs = [(int(ours.number[i]), int(theirs.number[j])) for i, j in zip(*np.nonzero(near), strict=True)]
        zero = F.array_repeat(F.lit(0).cast("bigint"), F.size("idx"))
        state = ours.rows.select(F.col("block").alias("cand"), "idx", "point_id", "point", zero.alias("weight"))
        grid = range_grid(state, theirs.rows, pairs, _parts(P.sparkSession, len(ours.number)))
        found = grid.mapInArrow(_counted(Round([float(radius)], [0.0], [[]])), STATE)
        found = found.select(F.explode(F.arrays_zip("idx", "point_id", "weight")).alias("r"))
        return cut_lineage(found.select("r.idx", "r.point_id", F.col("r.weight").alias("ball_weight")))
    finally:
        ours.release()
        theirs.release()


def heaviest_ball(weights: DataFrame) -> DataFrame:
    """One row: the x with the largest positive ball weight, lowest idx on ties."""
    return (weights.filter(F.col("ball_weight") > 0)
            .agg(F.max_by(F.struct("idx", "point_id", "ball_weight"),
                          F.struct(F.col("ball_weight"), -F.col("idx"))).alias("b"))
            .select("b.idx", "b.point_id", "b.ball_weight")
            .filter(F.col("idx").isNotNull()))


def ball_removal(uncovered: DataFrame, center: DataFrame, radius: float) -> DataFrame:
    """Uncovered points left after removing those within ``radius`` of the
    (one-row) ``center`` — an anti-filter against a one-point value."""
    c_val = center.select(F.first("point").alias("c")).scalar()
    return (uncovered.withColumn("_c", c_val)
            .filter(F.col("_c").isNull() | (euclidean(F.col("_c"), F.col("point")) > F.lit(float(radius))))
            .drop("_c"))


def solve_weighted_outliers(P: DataFrame, k: int, z: int, alpha: int = 0, guess_chunk: int = 4) -> KCenterSolution:
    """Greedy weighted k-center with z outliers over ``P[idx, point_id, point, weight]``.

    ``idx`` orders the points (ties, "first k+z+1"). Returns ≤ k centers in
    selection order with the report (initial guess, final guess, guesses).
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if z < 0:
        raise ValueError("z must be >= 0")
    P = _solver_input(P).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = initial_guess(P, k, z)
        if not stats["n_points"]:
            raise ValueError("no points to cluster")
        with metric_blocks(P, stats) as blocks:
            return _solve(blocks, stats, k, z, alpha, max(1, int(guess_chunk)))
    finally:
        P.unpersist()


def _solve(blocks: Blocks, stats: dict, k: int, z: int, alpha: int, guess_chunk: int) -> KCenterSolution:
    spark, pairs = blocks.rows.sparkSession, 0
    coef1, coef2 = 1 + 2 * alpha, 3 + 4 * alpha
    r0, diameter = float(stats["r0"]), 2.0 * float(stats["reach"] or 0.0)
    if r0 == 0.0 or math.isinf(r0) or diameter <= coef2 * r0:
        n_guesses = 1
    else:
        n_guesses = 2 + max(0, math.ceil(math.log2(diameter / (coef2 * r0))))
    # the first chunk with a feasible guess ends the search (the doubling loop's answer is the smallest one)
    for lo in range(0, n_guesses, guess_chunk):
        radii = [r0 * 2.0 ** g for g in range(lo, min(n_guesses, lo + guess_chunk))]
        picks, left, compared = _cover_rounds(blocks, k, radii, coef1, coef2, int(stats["total_weight"]))
        pairs += compared
        feasible = [g for g, w in enumerate(left) if w <= z]
        if feasible:
            break
    else:
        raise RuntimeError("no feasible radius guess (should not happen)")
    g = feasible[0]
    rows = [(t, pid, point) for t, (_, pid, point) in enumerate(picks[g])]
    centers = spark.createDataFrame(rows, T.StructType([
        T.StructField("center_no", T.IntegerType()), T.StructField("point_id", T.LongType()),
        T.StructField("point", T.ArrayType(T.DoubleType()))]))
    report = spark.createDataFrame(
        [(int(stats["n_points"]), int(stats["total_weight"]), k, z, alpha, r0, radii[g], lo + g + 1, len(rows))],
        "n_points bigint, total_weight bigint, k int, z int, alpha int, initial_guess double, "
        "final_guess double, n_guesses int, n_centers int")
    return KCenterSolution(centers, report, r0, radii[g], lo + g + 1, pairs)


def greedy_cover(P: DataFrame, k: int, r: float, alpha: int = 0):
    """Greedy cover at one fixed radius guess ``r``: up to k centers, picked by
    heaviest (1+2α)r ball and removing (3+4α)r balls. Returns (centers
    ``(center_no, point_id, point)``, uncovered weight)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    P = _solver_input(P)
    n, total = P.agg(F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    picks, left = [[]], [0]
    if n:
        head = [r.point for r in P.orderBy("idx").limit(PIVOTS).select("point").collect()]
        with metric_blocks(P, {"head": head, "n_points": n}) as blocks:
            picks, left, _ = _cover_rounds(blocks, k, [float(r)], 1 + 2 * alpha, 3 + 4 * alpha, int(total))
    centers = P.sparkSession.createDataFrame(
        [(t, pid, point) for t, (_, pid, point) in enumerate(picks[0])],
        "center_no int, point_id bigint, point array<double>")
    return centers, int(left[0])


def seq_weighted_outliers(points: DataFrame, k: int, z: int, alpha: int = 0, **kw) -> KCenterSolution:
    """The solver on a point set ordered by ``point_id``."""
    P = points.select(F.col("point_id").alias("idx"), "point_id", "point",
                      (F.col("weight") if "weight" in points.columns else F.lit(1)).alias("weight"))
    return solve_weighted_outliers(P, k, z, alpha, **kw)


def coreset_order(coreset: DataFrame, per_part: int) -> DataFrame:
    """Solver input from a coreset: ``idx`` follows (part_id, step), the order in
    which the per-partition coresets are gathered."""
    return coreset.select(
        (F.col("part_id").cast("bigint") * per_part + F.col("step")).alias("idx"),
        "point_id", "point", "weight")


@dataclass
class MRSolution:
    coreset: DataFrame
    solution: KCenterSolution
    report: DataFrame


def mr_kcenter_outliers(points: DataFrame, k: int, z: int, parts: int,
                        alpha: int = 2, with_objective: bool = True) -> MRSolution:
    """Two rounds: weighted coreset of k+z+1 traversal centers per partition,
    then the greedy solver (α = 2) on the union; objective over all points.
    ``points`` is cached once for both passes over it."""
    if k < 1:
        raise ValueError("k must be >= 1")
    if z < 0:
        raise ValueError("z must be >= 0")
    per_part = k + z + 1
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        coreset = fft_coreset(points, per_part, parts)
        sol = solve_weighted_outliers(coreset_order(coreset, per_part), k, z, alpha)
        objective = kcenter_objective(points, sol.centers, z, max_centers=k).first()[0] if with_objective else None
    finally:
        points.unpersist()
    r = sol.report.first()
    report = coreset.sparkSession.createDataFrame(
        [(r["k"], r["z"], parts, alpha, r["n_points"], r["total_weight"],
          r["initial_guess"], r["final_guess"], r["n_guesses"], r["n_centers"], objective)],
        "k int, z int, parts int, alpha int, coreset_points bigint, coreset_weight bigint, "
        "initial_guess double, final_guess double, n_guesses int, n_centers int, "
        "objective double")
    return MRSolution(coreset, sol, report)
