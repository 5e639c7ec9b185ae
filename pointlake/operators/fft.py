"""Farthest-first traversal per partition and the weighted coreset (Round 1).

Points are dealt to L partitions by ``part_id = pmod(point_id, L)`` (deterministic,
balanced when ids are dense). L is a parameter of the method only: tasks
follow the input's own partitioning, and one task holds points of all parts.

Every point carries a state: ``mind`` (distance to the nearest chosen center of
its part) and ``near`` (that center's step). A pass does two things in NumPy,
batch by batch:

* fold the centers chosen by the last pass into the state: at most one distance per
  point and new center, none where the new center is at least twice as far from
  the point's center as the point is (the triangle inequality);
* emit, per (part, salt), a fixed number of points with the largest distance
  (``candidates``: 16 to 512, fewer for more parts).

The candidates of all tasks are reduced to the same number per (part, salt)
and reach the driver: about ``ROWS`` rows, or 16 per part and salt. The driver
goes on choosing centers among them as long as the next one is provably the
farthest point of its part, i.e. its distance exceeds that of every point left
out. So one pass yields several centers; it always yields at least one per
part, and the centers are exactly those of the step-by-step traversal (largest
distance, lowest point_id on ties). A part whose points are all at distance 0
from its centers stops.

The state of a pass is cached and replaces the one before; every
``STORE_EVERY`` passes it is written to the checkpoint folder (and the written
state before it is deleted), so a lost executor repeats a few folds at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.limits import check_broadcast_bound, point_bytes
from ..plans.session import Stored, cut_lineage

#: Candidates per (part, salt): as many as keep a pass's rows near ROWS in all, within bounds.
ROWS = 32_768
FEWEST, MOST = 16, 512
SALTS = 4
STORE_EVERY = 8
STATE = "part_id int, point_id bigint, point array<double>, weight bigint, mind double, near int"
FARTHEST = "part_id int, salt int, point_id bigint, point array<double>, mind double"


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """n x d coordinates of a list column; rows of different length fail."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) == 0:
        return np.empty((0, 0))
    if column.null_count or (lengths != lengths[0]).any():
        raise ValueError("points of different dimension")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(lengths), lengths[0])


def distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    """Distances to one center: squares summed left to right from 0.0, the order
    of the JVM expression, so values are bit-identical to it."""
    if points.shape[1] != len(center):
        raise ValueError("points of different dimension")
    total = np.zeros(len(points))
    for k in range(points.shape[1]):
        gap = points[:, k] - center[k]
        total += gap * gap
    return np.sqrt(total)


@dataclass
class Part:
    """One part's traversal on the driver: centers so far, candidates of the last pass."""

    steps: list[tuple[int, list[float]]] = field(default_factory=list)  # (point_id, point)
    ids: np.ndarray | None = None
    points: np.ndarray | None = None
    mind: np.ndarray | None = None
    bound: float = -1.0  # no point outside the candidates is farther than this

    def finished(self, n_centers: int) -> bool:
        return len(self.steps) >= n_centers or self.bound < 0 and not self.mind.max(initial=0) > 0

    def advance(self, n_centers: int) -> list[tuple[int, np.ndarray]]:
        """Choose as many centers as the candidates decide; returns (step, point)."""
        chosen = []
        while len(self.steps) < n_centers and self.ids is not None and len(self.ids):
            top = self.mind.max()
            # the first center of a pass is the farthest of all; a later one must beat the bound
            if not top > 0 or chosen and not top > self.bound:
                break
            far = np.flatnonzero(self.mind == top)
            best = far[self.ids[far].argmin()]
            point = self.points[best].copy()
            chosen.append((len(self.steps), point))
            self.steps.append((int(self.ids[best]), point.tolist()))
            self.mind = np.minimum(self.mind, distances(self.points, point))
        return chosen


#: Bounds leave this much room for rounding.
SLACK = 1e-9


@dataclass
class Fold:
    """New centers of one part: (step, point, distances to all centers of earlier steps)."""

    new: list[tuple[int, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, earlier: list[list[float]], new: list[tuple[int, np.ndarray]]) -> Fold:
        """``earlier``: the part's centers before ``new``, in order of their steps."""
        known, folds = np.array([*earlier, *[p for _, p in new]], float), []
        for step, point in new:
            folds.append((step, point, distances(known[:step], point) if step else np.empty(0)))
        return cls(folds)

    def apply(self, points: np.ndarray, mind: np.ndarray, near: np.ndarray) -> int:
        """Folds the centers into (mind, near) in place; the number of distances computed.

        A point x with center a at distance m cannot be nearer to a new center c unless d(a, c) < 2 m: the
        triangle inequality gives d(x, c) >= d(a, c) - m. Points beyond that are skipped."""
        compared = 0
        for step, center, gaps in self.new:
            if step:
                rows = np.flatnonzero((gaps[near] * (1 - SLACK) < 2 * mind) | np.isinf(mind))
                if not len(rows):
                    continue
            else:
                rows = np.arange(len(points))
            d = distances(points[rows], center)
            compared += len(rows)
            closer = d < mind[rows]
            mind[rows[closer]], near[rows[closer]] = d[closer], step
        return compared


def _folder(new: dict[int, Fold]) -> Callable:
    """Folds ``new`` centers per part into the state columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            parts, points = batch.column(0).to_numpy(), matrix(batch.column(2))
            mind, near = batch.column(4).to_numpy().copy(), batch.column(5).to_numpy().copy()
            for part in np.unique(parts):
                if (fold := new.get(int(part))) is None:
                    continue
                rows = np.flatnonzero(parts == part)
                m, who = mind[rows], near[rows]
                fold.apply(points[rows], m, who)
                mind[rows], near[rows] = m, who
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(mind), pa.array(near, pa.int32())],
                                             names=batch.schema.names)

    return run


def candidates(parts: int) -> int:
    return max(FEWEST, min(MOST, ROWS // (parts * SALTS)))


def _farthest(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Per (part, salt) of this task: the ``most`` farthest points (lower id first on ties)."""
    best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for batch in batches:
        if not len(batch):
            continue
        parts, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        points, mind = matrix(batch.column(2)), batch.column(3).to_numpy()
        salts = (ids // 7919) % SALTS
        key = parts.astype(np.int64) * SALTS + salts
        for k in np.unique(key[mind > 0]):
            rows = np.flatnonzero((key == k) & (mind > 0))
            at = (int(k // SALTS), int(k % SALTS))
            i, p, m = ids[rows], points[rows], mind[rows]
            if at in best:
                i, p, m = (np.concatenate(x) for x in zip(best[at], (i, p, m), strict=True))
            order = np.lexsort((i, -m))[:most]
            best[at] = (i[order], p[order], m[order])
    for (part, salt), (i, p, m) in best.items():
        n = len(i)
        flat = pa.array(p.reshape(-1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, salt, np.int32)), pa.array(i),
             pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * p.shape[1], flat), pa.array(m)],
            names=["part_id", "salt", "point_id", "point", "mind"])


def _candidates(state: DataFrame, parts: dict[int, Part], most: int) -> None:
    """One pass over the state: fills the parts' candidates and bounds."""
    local = state.select("part_id", "point_id", "point", "mind").mapInArrow(lambda batches: _farthest(batches, most), FARTHEST)
    order = Window.partitionBy("part_id", "salt").orderBy(F.desc("mind"), "point_id")
    top = local.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")
    table = top.toArrow()  # at most parts * SALTS * most rows
    for part in parts.values():
        part.ids, part.mind, part.bound = None, np.empty(0), -1.0
    if not table.num_rows:
        return
    part_ids, salts = table["part_id"].to_numpy(), table["salt"].to_numpy()
    ids, points, mind = table["point_id"].to_numpy(), matrix(table["point"]), table["mind"].to_numpy()
    for p in np.unique(part_ids):
        rows = part_ids == p
        part = parts.setdefault(int(p), Part())
        part.ids, part.points, part.mind = ids[rows], points[rows], mind[rows].copy()
        for s in np.unique(salts[rows]):
            own = mind[rows & (salts == s)]
            if len(own) == most:  # points may have been left out, none farther than the last
                part.bound = max(part.bound, own.min())


def _check(n_centers: int, parts: int) -> None:
    if n_centers < 1:
        raise ValueError("number of centers must be >= 1")
    if parts < 1:
        raise ValueError("number of partitions must be >= 1")


def traverse(points: DataFrame, n_centers: int, parts: int) -> tuple[DataFrame, dict[int, Part], Callable[[], None]]:
    """(state, parts, release): the state after all centers, cached; each part's
    centers; and a call that gives the cache and the written state back."""
    _check(n_centers, parts)
    w = F.col("weight") if "weight" in points.columns else F.lit(1)
    state = points.select(
        F.pmod(F.col("point_id"), F.lit(parts)).cast("int").alias("part_id"), F.col("point_id").cast("bigint").alias("point_id"),
        F.col("point").cast("array<double>").alias("point"), w.cast("bigint").alias("weight"),
        F.lit(float("inf")).alias("mind"), F.lit(-1).alias("near"))
    run = Traversal(state.persist(StorageLevel.MEMORY_AND_DISK))
    try:
        run.passes(n_centers, parts)
    except BaseException:
        run.release()
        raise
    return run.state, run.parts, run.release


@dataclass
class Traversal:
    """The cached state of the last pass, and the one before until it is no longer needed."""

    state: DataFrame
    parts: dict[int, Part] = field(default_factory=dict)
    stale: DataFrame | None = None
    written: Stored | None = None

    def passes(self, n_centers: int, n_parts: int) -> None:
        n = 0
        while True:
            _candidates(self.state, self.parts, candidates(n_parts))  # fills the cache of the state
            if self.stale is not None:
                self.stale.unpersist()
            new = {p: got for p, part in self.parts.items() if (got := part.advance(n_centers))}
            if not new:
                return
            if not n:
                dim = len(next(iter(new.values()))[0][1])
                check_broadcast_bound(n_parts * n_centers, point_bytes(dim), "traversal centers")
            n += 1
            self.fold(new, n % STORE_EVERY == 0)
            if all(part.finished(n_centers) for part in self.parts.values()):
                self.state.count()
                self.stale.unpersist()
                return

    def fold(self, new: dict[int, list[tuple[int, np.ndarray]]], write: bool) -> None:
        folds = {p: Fold.of([x for _, x in self.parts[p].steps[:got[0][0]]], got) for p, got in new.items()}
        state, before = self.state.mapInArrow(_folder(folds), STATE), None
        if write:
            before, self.written = self.written, Stored.write(state, "traversal")
            state = self.written.df
        self.stale, self.state = self.state, state.persist(StorageLevel.MEMORY_AND_DISK)
        if before:
            self.state.count()  # from here on nothing reads the written state before this one
            self.stale.unpersist()
            before.delete()

    def release(self) -> None:
        for df in (self.state, self.stale):
            if df is not None:
                df.unpersist()
        if self.written:
            self.written.delete()


def fft_coreset(points: DataFrame, n_centers: int, parts: int) -> DataFrame:
    """Weighted coreset ``(part_id, step, point_id, point, weight)``: per part up
    to ``n_centers`` traversal centers, each weighted by the (weight of the)
    part's points whose nearest center it is (earliest step on ties)."""
    state, chosen, release = traverse(points, n_centers, parts)
    try:
        weights = state.groupBy("part_id", F.col("near").alias("step")).agg(F.sum("weight").cast("bigint").alias("weight"))
        centers = _centers_frame(points.sparkSession, chosen)
        return cut_lineage(centers.join(weights, ["part_id", "step"], "left").select(
            "part_id", "step", "point_id", "point", F.coalesce("weight", F.lit(0)).cast("bigint").alias("weight")))
    finally:
        release()


def fft_centers(points: DataFrame, n_centers: int, parts: int = 1) -> DataFrame:
    """Traversal centers only: ``(part_id, step, point_id, point)``."""
    _, chosen, release = traverse(points, n_centers, parts)
    release()
    return _centers_frame(points.sparkSession, chosen)


def _centers_frame(spark, chosen: dict[int, Part]) -> DataFrame:
    rows = [(p, s, i, x) for p, part in sorted(chosen.items()) for s, (i, x) in enumerate(part.steps)]
    return spark.createDataFrame(rows, "part_id int, step int, point_id bigint, point array<double>")
