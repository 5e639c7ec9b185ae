"""Euclidean distance and nearest-of-a-set, as JVM column expressions.

Points are ``ARRAY<DOUBLE>``. The squared distance is summed left to right from
0.0 over the coordinates — the same operation order as a sequential loop, so the
value is bit-identical wherever it is computed (Spark, the oracle SQL, a NumPy
loop). Every distance in a solve comes from this one expression (exact ``<=``
comparisons against radii depend on it).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sq_distance(a: Column | str, b: Column | str) -> Column:
    diffs = F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def euclidean(a: Column | str, b: Column | str) -> Column:
    """Distance; points of different dimension fail the query (rather than
    ``zip_with`` padding the shorter one with NULLs)."""
    a, b = _col(a), _col(b)
    return F.when(F.size(a) != F.size(b),
                  F.raise_error(F.lit("points of different dimension"))) \
            .otherwise(F.sqrt(sq_distance(a, b)))


def plain_distance(a: Column | str, b: Column | str) -> Column:
    """Distance without the dimension check (callers check once per point)."""
    return F.sqrt(sq_distance(a, b))


def same_dimension(point: Column, centers: Column, value: Column,
                   point_field: str | None = "point") -> Column:
    """``value``, or a failure when ``point`` and the first element of the set
    differ in dimension (all centers come from the same point set)."""
    first = F.element_at(centers, 1)
    first = first[point_field] if point_field else first
    return F.when(F.size(centers) > 0,
                  F.when(F.size(point) != F.size(first),
                         F.raise_error(F.lit("points of different dimension")))
                   .otherwise(value))


def nearest(point: Column | str, centers: Column, id_field: str = "center_no",
            point_field: str = "point") -> Column:
    """``struct(dist, id)`` of the nearest element of ``centers`` (an array of
    structs); ties go to the lowest id. NULL when ``centers`` is empty."""
    p = _col(point)
    cands = F.transform(
        centers, lambda c: F.struct(plain_distance(p, c[point_field]).alias("dist"),
                                    c[id_field].alias("id")))
    return same_dimension(p, centers, F.array_min(cands), point_field)


def min_distance(point: Column | str, centers: Column, point_field: str = "point") -> Column:
    """Distance to the nearest element of ``centers``; NULL when empty."""
    p = _col(point)
    d = F.array_min(F.transform(centers, lambda c: plain_distance(p, c[point_field])))
    return same_dimension(p, centers, d, point_field)
