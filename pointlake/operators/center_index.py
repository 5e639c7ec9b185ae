"""Nearest center among many centers: a ball cover of the center set, searched with pruning.

The centers are grouped around about sqrt(k) pivots (farthest-first among the centers, every
center to its nearest pivot), and each group keeps its radius and its members' distances
to the pivot. A point is compared with all pivots; a group is opened only if its ball comes
as near as the best center so far, and a member only if the triangle inequality through the
pivot leaves it a chance. Bounds have a slack far above rounding errors and every
distance that decides is the plain one, so result and ties (lowest center_no) are those of the full scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.limits import check_broadcast_bound, point_bytes
from .fft import distances, matrix

SLACK = 1e-9


class CenterIndex:
    """Centers in ascending order of their number."""

    def __init__(self, numbers: np.ndarray, points: np.ndarray) -> None:
        order = np.argsort(numbers, kind="stable")
        self.numbers, self.points = numbers[order], points[order]
        n = max(1, int(np.sqrt(len(order))))
        pivots, gap, near = [0], distances(self.points, self.points[0]), np.zeros(len(order), int)
        while len(pivots) < n and gap.max() > 0:
            pivots.append(int(gap.argmax()))
            d = distances(self.points, self.points[pivots[-1]])
            closer = d < gap
            gap[closer], near[closer] = d[closer], len(pivots) - 1
        self.pivots = self.points[pivots]
        self.members = [np.flatnonzero(near == g) for g in range(len(pivots))]
        self.arms, self.radius = gap, np.array([gap[m].max() for m in self.members])
        self.compared = 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(center number, distance) per point."""
        to_pivot = np.stack([distances(points, p) for p in self.pivots], axis=1)
        self.compared += to_pivot.size
        best, who = np.full(len(points), np.inf), np.full(len(points), len(self.points), int)
        home = to_pivot.argmin(axis=1)
        for first in (True, False):  # the nearest pivot's group makes the bound for the others
            for g, members in enumerate(self.members):
                d = to_pivot[:, g]
                reach = d - self.radius[g] - SLACK * (d + self.radius[g])
                rows = np.flatnonzero(home == g) if first else np.flatnonzero((home != g) & (reach <= best))
                if len(rows):
                    self._open(members, rows, d[rows], points, best, who)
        lost = who == len(self.points)
        if lost.any():  # no comparable distance (NaN): the first center, as a scan's minimum of NaN has it
            who[lost], best[lost] = 0, distances(points[lost], self.points[0])
        return self.numbers[who], best

    def _open(self, members, rows, to_pivot, points, best, who) -> None:
        for m in members:
            arm = self.arms[m]
            low = np.abs(to_pivot - arm) - SLACK * (to_pivot + arm)
            some = rows[low <= best[rows]]
            if not len(some):
                continue
            d = distances(points[some], self.points[m])
            self.compared += len(some)
            better = (d < best[some]) | (d == best[some]) & (m < who[some])
            best[some[better]], who[some[better]] = d[better], m


def nearest_of_many(points: DataFrame, centers: DataFrame, max_centers: int) -> DataFrame:
    """(point_id, center_no, dist) as ``geometry.nearest_center``, for center sets of thousands.

    ``max_centers`` bounds the set, which reaches every task; more centers, or more bytes than a
    broadcast may have, are an error. Edge cases: no centers gives null center and distance; points of
    another dimension than the centers, and null points, fail the query."""
    table = centers.select(F.col("center_no").cast("bigint").alias("center_no"), "point").limit(max_centers + 1).toArrow()
    if table.num_rows > max_centers:
        raise ValueError(f"center set larger than its bound {max_centers}")
    slim = points.select(F.col("point_id").cast("bigint").alias("point_id"), F.col("point").cast("array<double>").alias("point"))
    if not table.num_rows:
        return slim.select("point_id", F.lit(None).cast("bigint").alias("center_no"), F.lit(None).cast("double").alias("dist"))
    numbers, places = table["center_no"].to_numpy(), matrix(table["point"])
    check_broadcast_bound(len(numbers), point_bytes(places.shape[1]), "center set")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CenterIndex(numbers, places)
        for batch in batches:
            if len(batch):
                number, d = index.nearest(matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int64()), pa.array(d)],
                                                 names=["point_id", "center_no", "dist"])

    return slim.mapInArrow(search, "point_id bigint, center_no bigint, dist double")
