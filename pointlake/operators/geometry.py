"""Point-to-center-set operators: nearest center, distance to a set, cluster
sizes, the k-center objective with z outliers, and the outlier set.

A center set has at most k rows (k is a parameter), so it is shipped to the
tasks as one array value (a scalar subquery, checked against the broadcast
budget); the point set is never shuffled, joined pairwise or collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distance import min_distance, nearest
from ..plans.limits import MAX_BROADCAST_BYTES
from ..plans.session import Stored, cut_lineage
from .selection import kth_largest, largest_rows

#: Ranks up to here are taken by a top-z of rows in one task; beyond, by bracketing the distance.
TOP_ROWS = 100_000


def centers_value(centers: DataFrame, max_centers: int) -> Column:
    """The center set as one ``array<struct<center_no, point>>`` value, sorted by
    ``center_no``. ``max_centers`` is the proven bound (k); it and the size of the
    points as they are get checked when the value is made."""
    arr = F.sort_array(F.collect_list(
        F.struct(F.col("center_no").cast("bigint").alias("center_no"),
                 F.col("point").alias("point"))))
    size = F.sum(F.lit(8) * F.size("point") + F.lit(64))  # bytes of a (id, point) row
    guarded = (F.when(F.size(arr) > F.lit(max_centers),
                      F.raise_error(F.lit(f"center set larger than its bound {max_centers}")))
               .when(size > F.lit(MAX_BROADCAST_BYTES), F.raise_error(F.lit("center set over the broadcast budget")))
               .otherwise(arr))
    return centers.select(guarded.alias("c")).scalar()


def with_centers(points: DataFrame, centers: DataFrame, max_centers: int,
                 name: str = "_centers") -> DataFrame:
    """Attach the center set as a column. (Spark analyses a subquery inside a
    higher-order function as unsupported, so it is projected first.)"""
    return points.withColumn(name, centers_value(centers, max_centers))


def nearest_center(points: DataFrame, centers: DataFrame, max_centers: int) -> DataFrame:
    """(point_id, center_no, dist): nearest center, lowest center_no on ties."""
    n = nearest("point", F.col("_centers"))
    return with_centers(points, centers, max_centers).select(
        "point_id", n["id"].alias("center_no"), n["dist"].alias("dist"))


def point_center_distance(points: DataFrame, centers: DataFrame, max_centers: int) -> DataFrame:
    """(point_id, dist) with dist = d(x, S) = min over centers."""
    return with_centers(points, centers, max_centers).select(
        "point_id", min_distance("point", F.col("_centers")).alias("dist"))


def cluster_sizes(assignment: DataFrame, weight_col: str | None = None) -> DataFrame:
    """(center_no, n_points): points (or weight) nearest to each center.
    Partial aggregation per task, so a center owning a third of all points does
    not concentrate rows on one reducer."""
    w = F.col(weight_col) if weight_col else F.lit(1)
    return assignment.groupBy("center_no").agg(F.sum(w).cast("bigint").alias("n_points"))


def kcenter_objective(points: DataFrame, centers: DataFrame, z: int, max_centers: int) -> DataFrame:
    """One row ``objective``: the (z+1)-th largest distance of a point to its
    nearest center (the largest after discarding the z farthest). Unweighted.

    Plans as TakeOrderedAndProject with z+1 rows per task, then a merge; fails at
    run time when the input has no more than z points.
    """
    if z < 0:
        raise ValueError("z must be >= 0")
    if z >= TOP_ROWS:
        return objective_by_selection(points, centers, z, max_centers)
    d = point_center_distance(points, centers, max_centers)
    top = d.orderBy(F.desc("dist")).limit(z + 1)
    agg = top.agg(F.min("dist").alias("dist"), F.count(F.lit(1)).alias("n"))
    return agg.select(
        F.when(F.col("n") <= F.lit(z),
               F.raise_error(F.lit(f"z={z} must be smaller than the number of points")))
         .otherwise(F.col("dist")).cast("double").alias("objective"))


def kcenter_outliers(points: DataFrame, centers: DataFrame, z: int, max_centers: int) -> DataFrame:
    """The z points farthest from the centers (ties: lower point_id kept)."""
    if z < 0:
        raise ValueError("z must be >= 0")
    if z > TOP_ROWS:
        return outliers_by_selection(points, centers, z, max_centers)
    d = point_center_distance(points, centers, max_centers)
    return d.orderBy(F.desc("dist"), F.asc("point_id")).limit(z)


def objective_by_selection(points: DataFrame, centers: DataFrame, z: int, max_centers: int) -> DataFrame:
    """The objective for any z: distances are written once (16 bytes a point), then the
    (z+1)-th largest is bracketed in a few passes (``selection``); no task holds z rows.
    A table of no more than z points is an error; null distances are left out."""
    stored = Stored.write(point_center_distance(points, centers, max_centers).select("dist"), "distances")
    try:
        value = kth_largest(stored.df, "dist", z + 1).value
    finally:
        stored.delete()
    return points.sparkSession.createDataFrame([(value,)], "objective double")


def outliers_by_selection(points: DataFrame, centers: DataFrame, z: int, max_centers: int) -> DataFrame:
    """The z farthest points (point_id, dist) for any z, lower ids among equal distances: a
    filter at the z-th largest distance, and at the id of the last point that shares it."""
    stored = Stored.write(point_center_distance(points, centers, max_centers), "distances")
    try:
        return cut_lineage(largest_rows(stored.df, "dist", "point_id", z))
    finally:
        stored.delete()
