"""Coresets by merge and reduce: a tree of weighted coresets of coresets.

The leaves are the parts ``pmod(point_id, parts)``; each is reduced to at most ``n_centers``
farthest-first centers with the weight of the points nearest to them. A level merges the coresets
whose parts agree modulo the next level's number of parts (about ``fan_in`` of them) and reduces the union in
the same way, weights added, until one part is left. So a merge holds at most about fan_in * n_centers
points, nothing reaches the driver, and the number of leaves is not bounded by
the union of all coresets, as it is where that union is solved at once.

Every center carries ``radius``: no point it stands for is farther from it. A level adds the
distance from a merged center to its new one, so the bound grows by one covering radius per level.

Edge cases: an empty table gives an empty coreset; fewer points than centers, or equal points, give fewer
centers; a null weight counts as 1, null points and points of different dimension fail the query. Leaves are balanced
when ids are spread evenly, as dense ids are (``functions.rowindex`` makes them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut_lineage
from .fft import distances, matrix

#: Points of a leaf where the number of leaves is not given.
LEAF = 8_192
SCHEMA = "part_id int, step int, point_id bigint, point array<double>, weight bigint, radius double"


def reduced(table: pa.Table, n_centers: int) -> pa.Table:
    """Coreset of one part's weighted points (part_id, point_id, point, weight, radius)."""
    ids = table["point_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, points = ids[order], matrix(table["point"])[order]
    weight, radius = table["weight"].to_numpy()[order], table["radius"].to_numpy()[order]
    chosen, gap, near = [0], distances(points, points[0]), np.zeros(len(ids), int)
    while len(chosen) < n_centers and gap.max() > 0:
        chosen.append(int(gap.argmax()))  # the lowest id among the farthest
        d = distances(points, points[chosen[-1]])
        closer = d < gap
        gap[closer], near[closer] = d[closer], len(chosen) - 1
    n, dim = len(chosen), points.shape[1]
    held, reach = np.zeros(n, np.int64), np.zeros(n)
    np.add.at(held, near, weight)
    np.maximum.at(reach, near, gap + radius)
    flat = pa.array(points[chosen].reshape(-1))
    return pa.table({
        "part_id": pa.array(np.full(n, table["part_id"][0].as_py()), pa.int32()), "step": pa.array(np.arange(n), pa.int32()),
        "point_id": pa.array(ids[chosen]), "point": pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * dim, flat),
        "weight": pa.array(held), "radius": pa.array(reach)})


def tree_coreset(points: DataFrame, n_centers: int, parts: int | None = None, fan_in: int = 8) -> DataFrame:
    """``(part_id, step, point_id, point, weight, radius)`` of the root, in the checkpoint folder."""
    if n_centers < 1:
        raise ValueError("number of centers must be >= 1")
    if fan_in < 2:
        raise ValueError("fan_in must be >= 2")
    if parts is None:
        parts = max(1, -(-points.count() // LEAF))
    if parts < 1:
        raise ValueError("number of partitions must be >= 1")
    w = F.coalesce(F.col("weight"), F.lit(1)) if "weight" in points.columns else F.lit(1)
    level = points.select(
        F.pmod(F.col("point_id"), F.lit(parts)).cast("int").alias("part_id"), F.col("point_id").cast("bigint").alias("point_id"),
        F.col("point").cast("array<double>").alias("point"), w.cast("bigint").alias("weight"), F.lit(0.0).alias("radius"))
    while True:
        level = level.groupBy("part_id").applyInArrow(lambda t: reduced(t, n_centers), SCHEMA)
        if parts == 1:
            return cut_lineage(level)
        parts = -(-parts // fan_in)
        level = level.withColumn("part_id", F.pmod("part_id", F.lit(parts)).cast("int")).drop("step")
