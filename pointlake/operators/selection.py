"""Selection by rank in tables of any size: the value is bracketed by histograms.

A pass counts the values of the bracket in ``BUCKETS`` buckets of equal width (partial
counts per task, one row per bucket at the driver) and keeps the bucket that holds the
wanted rank, with that bucket's own smallest and largest value as the next bracket. The
ends of a bracket lie in different buckets, so every pass narrows it; it ends when all
values left are equal. No task or driver ever holds more than a row per bucket,
whatever the rank is.

Edge cases: null values are left out; NaN counts as the largest value, above infinity; a rank
below 1 or above the number of values is an error (so is an empty table).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
NAN, INF, NEG = BUCKETS + 1, BUCKETS, -1


@dataclass
class Rank:
    """The value at a rank, how many values come before it, how many equal it, and the passes made."""

    value: float
    before: int
    equal: int
    passes: int


def _check_rank(rank: int, n: int) -> None:
    if rank < 1:
        raise ValueError("rank must be >= 1")
    if rank > n:
        raise ValueError(f"rank {rank} of {n} values")


def _place(v: Column, lo: float, hi: float) -> Column:
    """Bucket of a value; larger values never have a smaller bucket."""
    scale = 0.5 if max(abs(lo), abs(hi)) > 1e300 else 1.0  # a width that would overflow is halved
    width = hi * scale - lo * scale
    inside = F.lit(0) if lo == hi else F.least(
        F.lit(BUCKETS - 1), F.floor((v * scale - lo * scale) / F.lit(width) * BUCKETS).cast("int"))
    return (F.when(F.isnan(v), NAN).when(v == F.lit(math.inf), INF).when(v == F.lit(-math.inf), NEG)
            .otherwise(inside))


def kth_largest(values: DataFrame, column: str, rank: int) -> Rank:
    """The ``rank``-th largest value of a double column (1 = the largest)."""
    rows = values.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    finite = (F.col("v") > F.lit(-math.inf)) & (F.col("v") < F.lit(math.inf))
    n, lo, hi = rows.agg(F.count(F.lit(1)), F.min(F.when(finite, F.col("v"))), F.max(F.when(finite, F.col("v")))).first()
    _check_rank(rank, n)
    lo, hi = (0.0, 0.0) if lo is None else (lo, hi)
    before, passes, inside = 0, 1, rows
    while True:
        counts = inside.groupBy(_place(F.col("v"), lo, hi).alias("place")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()  # a row per bucket
        passes += 1
        for row in sorted(counts, key=lambda r: -r.place):
            if before + row.n >= rank:
                break
            before += row.n
        if row.place in (NAN, INF, NEG) or row.lo == row.hi:
            return Rank(row.lo, before, row.n, passes)
        lo, hi = row.lo, row.hi
        inside = rows.filter(F.col("v").between(lo, hi))


def kth_smallest_id(ids: DataFrame, column: str, rank: int) -> Rank:
    """The ``rank``-th smallest value of a bigint column, by its leading bits first."""
    rows = ids.select(F.col(column).cast("bigint").alias("v")).filter("v IS NOT NULL")
    n, lo, hi = rows.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    _check_rank(rank, n)
    before, passes, equal = 0, 1, n
    while lo < hi:
        shift = max(0, ((hi - lo) // BUCKETS).bit_length())
        counts = rows.filter(F.col("v").between(lo, hi)).groupBy(F.shiftright("v", shift).alias("place")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        passes += 1
        for row in sorted(counts, key=lambda r: r.place):
            if before + row.n >= rank:
                break
            before += row.n
        lo, hi, equal = row.lo, row.hi, row.n
    return Rank(lo, before, equal, passes)


def largest_rows(rows: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows of largest ``value`` (all rows with one, if fewer), equal values by ascending
    ``key``: a filter at the cut value, and one on the keys of the rows that share it. ``rows`` is
    read once per pass, so it should be a stored table. Rows without a key come first among equals."""
    if n < 0:
        raise ValueError("n must be >= 0")
    rows = rows.filter(F.col(value).isNotNull())
    if n == 0 or (total := rows.count()) == 0:
        return rows.filter(F.lit(False))
    if n >= total:
        return rows
    v, k = F.col(value), F.col(key)
    cut = kth_largest(rows, value, n)
    at = F.lit(cut.value).cast("double")
    above, ties, wanted = rows.filter(v > at), rows.filter(v == at), n - cut.before
    if wanted == cut.equal:
        return rows.filter(v >= at)
    bare = ties.filter(k.isNull()).count()
    if wanted <= bare:
        return above.unionAll(ties.filter(k.isNull()).limit(wanted))
    last = kth_smallest_id(ties, key, wanted - bare)
    inside = above.unionAll(ties.filter(k.isNull() | (k < last.value)))
    same = ties.filter(k == last.value)  # one row where keys are unique
    return inside.unionAll(same.limit(wanted - bare - last.before))
