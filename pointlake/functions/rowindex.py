"""Dense, file-ordered row numbers for a file scan, without a join or a sort of rows.

``monotonically_increasing_id`` counts rows inside a task. A task reads one
or several file splits, one after the other; a row's number is its place in its split
plus the rows of all earlier splits. A first scan counts rows per split; the table of splits (a
row each) is ordered and summed, and reaches the second scan as one
value: per task the first rows and bases of its splits, which a row looks up by its task's
number. It is a scalar subquery, so nothing runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_dense_index(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Add ``name`` = 0-based position of each row in (file name, line) order.

    Must be applied directly on a file scan (before any shuffle) so that the
    task layout still follows the files.
    """
    tagged = df.select(F.input_file_name().alias("_file"), F.spark_partition_id().alias("_pid"),
                       F.monotonically_increasing_id().alias("_mid"), *df.columns)
    splits = tagged.groupBy("_file", "_pid").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_first").rowsBetween(Window.unboundedPreceding, -1)
    based = splits.select("_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    per_task = based.groupBy("_pid").agg(F.sort_array(F.collect_list(F.struct("_first", "_base"))).alias("_splits"))
    # tasks without rows have no entry: an array by task number, empty where there is none
    table = per_task.agg(F.map_from_entries(F.collect_list(F.struct("_pid", "_splits"))).alias("m"), F.max("_pid").alias("last"))
    by_task = table.select(F.transform(F.sequence(F.lit(0), F.coalesce("last", F.lit(0))), lambda p: F.col("m")[p]).alias("t"))
    rows = df.select(F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"), *df.columns)
    rows = rows.withColumn("_own", F.get(by_task.scalar(), F.col("_pid")))
    split = F.element_at(F.filter("_own", lambda s: s["_first"] <= F.col("_mid")), -1)
    return rows.select((split["_base"] + F.col("_mid") - split["_first"]).alias(name), *df.columns)
