"""Connected components of an edge table, without gathering edges anywhere.

Each task first reduces its own edges to a spanning forest with union-find
(blocks of bounded size), then alternating large-star and small-star rounds
contract the forest until every node points at the least node of its component.
Rounds are joins and grouped minima; each is written to the shared folder, so
a lost executor repeats one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, store

#: Edges per writing task, and the least number of tasks.
TASK_EDGES = 200_000
LEAST_TASKS = 12


class UnionFind(dict):
    """Roots by least element, path halving; missing nodes are their own root."""

    def find(self, x):
        while (up := self.get(x, x)) != x:
            top = self.get(up, up)
            self[x] = top
            x = top
        return x

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            low, high = (a, b) if a < b else (b, a)
            self[high] = low


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        uf = UnionFind()
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            uf.union(a, b)
        nodes = list(uf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, batch.schema.field(0).type), pa.array([uf.find(x) for x in nodes], batch.schema.field(1).type)],
            schema=batch.schema)


def _stamp(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; no nulls): root is the least
    node of its component. Isolated nodes do not occur in the result."""
    with scratch(edges.sparkSession):
        return store(_contracted(edges.select("a", "b").filter("a <> b")), "components-found", keep=True)


def _contracted(edges: DataFrame) -> DataFrame:
    # the edges left shrink from here on, so their number bounds the tasks that write them
    tasks = max(LEAST_TASKS, -(-edges.count() // TASK_EDGES))
    edges = edges.coalesce(tasks).mapInArrow(_forest, edges.schema).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = store(edges.filter("a <> b").distinct().coalesce(tasks), "components")
    seen = _stamp(edges)
    while seen[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = store(large.coalesce(tasks), "components-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = store(small.unionAll(low.select("a", F.col("m").alias("b"))).distinct().coalesce(tasks), "components-small")
        now = _stamp(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
