"""Metric blocks: points cut by their distance to pivots, so that range queries skip far blocks.

Every point belongs to the cell of its nearest pivot, and a cell is cut into rings by the distance
to it, of about ``BLOCK`` points each (points of one ring in excess of that are dealt by a hash). A
block thus knows its pivot and the least and largest distance to it, and the triangle inequality bounds
from below how close its points can come to a point or to another block. A range join of radius R
only brings together blocks whose bound is at most R: a block is copied to the blocks around it,
never to all.

Pivots are a few points that the caller has anyway (at most ``PIVOTS``); a poor choice costs time, not results. The
driver holds four numbers per block.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.limits import check_broadcast_bound, point_bytes
from .fft import distances, matrix

#: Points of a block; points of a cell (on average) that make another pivot worth while; most pivots; rings of a cell.
BLOCK, CELL, PIVOTS, RINGS = 2_048, 512, 256, 64
#: Bounds are lowered by this share of the distances they are made of, far above any rounding.
SLACK = 1e-9
COLUMNS = "block int, idx bigint, point_id bigint, point array<double>, weight bigint, dist double"


def pivots_of(points: list[list[float]], n: int) -> np.ndarray:
    """Distinct points among the given ones, as many as ``n`` points can use."""
    found = list(dict.fromkeys(map(tuple, points)))
    return np.array(found[:max(1, min(PIVOTS, -(-n // CELL)))], float)


def nearest_pivot(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pivot, distance), the first pivot on ties."""
    cell, dist = np.zeros(len(points), np.int32), np.full(len(points), np.inf)
    for i, pivot in enumerate(pivots):
        d = distances(points, pivot)
        closer = d < dist
        cell[closer], dist[closer] = i, d[closer]
    return cell, dist


@dataclass
class Rings:
    """How cells are cut: per cell the first block, the ring ends, and blocks per ring."""

    first: np.ndarray
    ends: list[np.ndarray]
    split: list[int]

    @classmethod
    def whole(cls, cells: int) -> Rings:
        return cls(np.arange(cells), [np.empty(0)] * cells, [1] * cells)

    @classmethod
    def of(cls, cells: int, counts: dict[int, tuple[int, list[float]]]) -> Rings:
        """From (points, distance quantiles) per cell."""
        first, ends, split, at = [], [], [], 0
        for c in range(cells):
            n, quantiles = counts.get(c, (0, []))
            rings = max(1, min(RINGS, -(-n // BLOCK)))
            cut = np.unique([quantiles[len(quantiles) * i // rings] for i in range(1, rings)]) if rings > 1 else np.empty(0)
            first.append(at)
            ends.append(cut)
            split.append(max(1, -(-n // (BLOCK * (len(cut) + 1)))))
            at += (len(cut) + 1) * split[-1]
        return cls(np.array(first), ends, split)

    def block(self, cell: np.ndarray, dist: np.ndarray, idx: np.ndarray) -> np.ndarray:
        out = np.empty(len(cell), np.int32)
        for c in np.unique(cell):
            rows = np.flatnonzero(cell == c)
            ring = np.searchsorted(self.ends[c], dist[rows], "right")
            out[rows] = self.first[c] + ring * self.split[c] + (idx[rows] * 2654435761 >> 7) % self.split[c]
        return out


def _assigned(pivots: np.ndarray, rings: Rings | None):
    """Adds block (or with no rings yet: the cell) and distance to (idx, point_id, point, weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cell, dist = nearest_pivot(matrix(batch.column(2)), pivots)
                block = cell if rings is None else rings.block(cell, dist, batch.column(0).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), *batch.columns, pa.array(dist)],
                                                 names=["block", "idx", "point_id", "point", "weight", "dist"])

    return run


@dataclass
class Blocks:
    """Cached rows (block, and arrays of idx, point_id, point, weight, dist), and per block number its pivot and distances."""

    cached: DataFrame
    pivots: np.ndarray
    number: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray

    @classmethod
    def build(cls, P: DataFrame, pivots: np.ndarray, n: int) -> Blocks:
        """Blocks of ``P`` (idx, point_id, point, weight), which has ``n`` rows."""
        check_broadcast_bound(len(pivots), point_bytes(pivots.shape[1]), "pivots")
        P, rings = P.select("idx", "point_id", "point", "weight"), Rings.whole(len(pivots))
        if n > BLOCK:
            cells = P.mapInArrow(_assigned(pivots, None), COLUMNS).groupBy("block").agg(
                F.count(F.lit(1)).alias("n"), F.percentile_approx("dist", [i / RINGS for i in range(RINGS)]).alias("q"))
            rings = Rings.of(len(pivots), {r.block: (r.n, r.q) for r in cells.collect()})
        rows = P.mapInArrow(_assigned(pivots, rings), COLUMNS).groupBy("block").agg(
            F.sort_array(F.collect_list(F.struct("idx", "point_id", "point", "weight", "dist"))).alias("p"))
        columns = [F.col(f"p.{c}").alias(c) for c in ("idx", "point_id", "point", "weight", "dist")]
        rows = rows.select("block", *columns).persist(StorageLevel.MEMORY_AND_DISK)
        found = rows.select("block", F.array_min("dist").alias("low"), F.array_max("dist").alias("high"), F.size("idx").alias("n")).collect()
        found.sort(key=lambda r: r.block)
        number = np.array([r.block for r in found], np.int64)
        cell = np.searchsorted(rings.first, number, "right") - 1
        return cls(rows, pivots, number, cell, *(np.array([r[c] for r in found], float) for c in ("low", "high", "n")))

    @property
    def rows(self) -> DataFrame:
        return self.cached.select("block", "idx", "point_id", "point", "weight")

    def release(self) -> None:
        self.cached.unpersist()

    def between(self, other: Blocks) -> np.ndarray:
        """len(self) x len(other): no two points of the blocks are closer than this. Equal pivots are assumed."""
        gap = np.stack([distances(self.pivots, p) for p in self.pivots])[np.ix_(self.cell, other.cell)]
        a_low, a_high, b_low, b_high = self.low[:, None], self.high[:, None], other.low[None, :], other.high[None, :]
        nearest = np.maximum(gap - b_high, b_low - gap)     # of other's points, to the pivot of self
        bound = np.maximum(nearest - a_high, a_low - (gap + b_high))
        return np.maximum(0, bound - SLACK * (gap + a_high + b_high))

    def from_point(self, point: np.ndarray) -> np.ndarray:
        """Per block: no point of it is closer to ``point`` than this."""
        d = distances(self.pivots, np.asarray(point, float))[self.cell]
        return np.maximum(0, np.maximum(d - self.high, self.low - d) - SLACK * (d + self.high))


def range_grid(state: DataFrame, members: DataFrame, pairs: list[tuple[int, int]], parts: int) -> DataFrame:
    """Rows (cand, member, idx, point_id, point, weight) in order: each row of ``state`` (cand, ...) with member -1, then the
    ``members`` (block, ...) that ``pairs`` (cand, block) bring to it. The pairs travel as a constant, two numbers each;
    rows that all go to one task need no exchange."""
    near: dict[int, list[int]] = {}
    for cand, block in pairs:
        near.setdefault(block, []).append(cand)
    near_val = F.from_json(F.lit(json.dumps(near)), "map<string,array<int>>")
    columns = ["idx", "point_id", "point", "weight"]
    moved = members.filter(F.col("block").isin(list(near))).select(
        F.explode(F.try_element_at(near_val, F.col("block").cast("string"))).alias("cand"), F.col("block").alias("member"), *columns)
    own = state.select("cand", F.lit(-1).alias("member"), *columns)
    grid = own.unionAll(moved)
    grid = grid.coalesce(1) if parts == 1 else grid.repartition(parts, "cand")
    return grid.sortWithinPartitions("cand", "member")
