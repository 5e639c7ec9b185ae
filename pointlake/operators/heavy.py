"""Top-H without shuffling a count per product and task: mergeable heavy-hitter summaries.

Pass 1 keeps a Misra-Gries summary per task: at most ``capacity`` counters; where there are more, the
(capacity+1)-th largest count is taken off all of them and added to the task's error. A product's
true count lies between the sum of its counters and that sum plus the sum E of all errors, so
with t, the H-th largest sum, every product of the top H has an upper bound of at least t, and one without a counter has at
most E. If E < t, the counters hold all candidates, and pass 2 counts these exactly. Else the
summaries were too small for this table: another pass takes eight times the capacity (E is 0 once a task's
products fit).

Edge cases: an empty table gives no rows; a null product is a product; ties by ascending product id (null first).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import Stored, cut_lineage

CAPACITY = 4_096


def cut(counters: dict, capacity: int) -> int:
    """Reduce to ``capacity`` counters in place; what was taken off each."""
    if len(counters) <= capacity:
        return 0
    off = sorted(counters.values(), reverse=True)[capacity]
    for key in [k for k, n in counters.items() if n <= off]:
        del counters[key]
    for key in counters:
        counters[key] -= off
    return off


def _summaries(batches: Iterator[pa.RecordBatch], capacity: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    counters: dict = {}
    error = 0
    for batch in batches:
        counts = pc.value_counts(batch.column(0))
        for key, n in zip(counts.field(0).to_pylist(), counts.field(1).to_pylist(), strict=True):
            counters[key] = counters.get(key, 0) + n
        error += cut(counters, capacity)
    rows = len(counters)
    yield pa.RecordBatch.from_arrays(
        [pa.array([*counters, None], kind), pa.array([*counters.values(), 0], pa.int64()),
         pa.array([0] * rows + [error], pa.int64()), pa.array([True] * rows + [False])], names=["product_id", "n", "error", "counter"])


def top_products_by_summaries(pairs: DataFrame, h: int, capacity: int = CAPACITY) -> DataFrame:
    """The H products with the most rows in ``pairs`` (product_id, popularity); equal to
    ``baskets.top_products`` of the full count for H > 0."""
    if h < 1 or capacity < 1:
        raise ValueError("H and capacity must be >= 1")
    kind = pairs.schema["product_id"].dataType.simpleString()
    rows = Stored.write(pairs.select("product_id"), "heavy-pairs")  # read by every pass
    try:
        while True:
            summary = Stored.write(_summary(rows.df, capacity, kind), "heavy-summary")
            try:
                top = _exact_top(rows.df, summary.df, h)
            finally:
                summary.delete()
            if top is not None:
                return top
            capacity *= 8
    finally:
        rows.delete()


def _summary(rows: DataFrame, capacity: int, kind: str) -> DataFrame:
    arrow = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    return rows.mapInArrow(lambda batches: _summaries(batches, capacity, arrow),
                           f"product_id {kind}, n bigint, error bigint, counter boolean")


def _exact_top(rows: DataFrame, summary: DataFrame, h: int) -> DataFrame | None:
    """The top H, counted exactly among the candidates; None if the errors are too large to prove them."""
    error = summary.agg(F.coalesce(F.sum("error"), F.lit(0)).alias("e")).first().e
    low = summary.filter("counter").groupBy("product_id").agg(F.sum("n").alias("low"))
    best = low.orderBy(F.desc("low")).limit(h).collect()  # H rows
    least = best[-1].low if len(best) == h else 0
    if error and error >= least:
        return None
    few = low.filter(F.col("low") + F.lit(error) >= least).select(F.col("product_id").alias("candidate"))
    exact = (rows.join(few, F.col("product_id").eqNullSafe(F.col("candidate")), "left_semi")
             .groupBy("product_id").agg(F.count(F.lit(1)).alias("popularity")))
    return cut_lineage(exact.orderBy(F.desc("popularity"), F.asc("product_id")).limit(h))
