"""Product popularity: distinct (product, customer) purchase pairs, popularity
per product, cross-check of two plans, top-H.

Shuffle layout: the pair dedup is keyed on (product, customer), so a product
bought by a third of all customers is still spread over every reducer; the
popularity count that follows receives at most one row per product per map
task (partial aggregation). Neither step gathers one product's rows together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "all"


def purchases(txn: DataFrame, country: str = ALL, on_error: str | None = None) -> DataFrame:
    """Rows with quantity > 0 and, unless ``country == 'all'``, the given country.

    The reference reads the country of a row only when its quantity is positive
    and parses the customer only for rows that pass both tests. With
    ``on_error='fail'`` a passing row without a country or a valid customer id
    raises; with ``'drop'`` it is skipped; ``None`` trusts typed input.
    """
    qty_ok = F.col("quantity") > 0
    match = F.lit(True) if country == ALL else (F.col("country") == F.lit(country))
    if on_error is None:
        # trusted typed input: plain conjuncts, so the country test is pushed down
        return txn.filter(qty_ok & match) if country != ALL else txn.filter(qty_ok)
    if on_error not in ("fail", "drop"):
        raise ValueError("on_error must be None, 'fail' or 'drop'")
    # One predicate whose CASE nesting fixes the evaluation order (a filter is
    # never pruned and CASE branches are evaluated lazily).
    if on_error == "fail":
        country_ok = F.when(F.col("country").isNull(),
                            F.raise_error(F.lit("transaction row without a country field"))) \
                      .otherwise(match)
        customer_ok = F.when(F.col("customer_id").isNull(),
                             F.raise_error(F.lit("transaction row with a malformed customer id"))) \
                       .otherwise(F.lit(True))
    else:
        country_ok = F.col("country").isNotNull() & F.coalesce(match, F.lit(False))
        customer_ok = F.col("customer_id").isNotNull()
    pred = F.when(qty_ok, F.when(country_ok, customer_ok).otherwise(F.lit(False))) \
            .otherwise(F.lit(False))
    return txn.filter(pred)


def product_customer_pairs(txn: DataFrame, country: str = ALL,
                           on_error: str | None = None) -> DataFrame:
    """All distinct (product_id, customer_id) purchase pairs (hash dedup)."""
    return (purchases(txn, country, on_error)
            .select("product_id", "customer_id")
            .dropDuplicates(["product_id", "customer_id"]))


def product_customer_pairs_salted(txn: DataFrame, country: str = ALL,
                                  buckets: int = 16, on_error: str | None = None,
                                  salt_cols: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """Same pairs, deduplicated in two rounds: rows are dealt to ``buckets`` salt
    groups (a hash of the pair and ``salt_cols``, so task retries agree) and
    deduplicated there, so repeats of one pair are split over all groups; what is left
    of a pair, at most a row per group, meets in the second round. Both exchanges are explicit: the optimizer
    would otherwise fold the two rounds into one. Either deals by the pair too, to as many tasks as the session
    asks for: ``buckets`` bounds the groups of a pair, not the tasks."""
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    pair = ["product_id", "customer_id"]
    rows = purchases(txn, country, on_error)
    salt = F.pmod(F.xxhash64(*pair, *salt_cols), F.lit(buckets))
    local = rows.select(salt.alias("salt"), *pair).repartition("salt", *pair).dropDuplicates(["salt", *pair])
    return local.select(*pair).repartition(*pair).dropDuplicates(pair)


def pair_count(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"))


def product_popularity(pairs: DataFrame) -> DataFrame:
    """Popularity = number of pairs per product (partial + final count)."""
    return pairs.groupBy("product_id").agg(F.count(F.lit(1)).alias("popularity"))


def product_popularity_distinct(txn: DataFrame, country: str = ALL,
                                on_error: str | None = None) -> DataFrame:
    """Popularity straight from rows: ``count(DISTINCT customer_id)`` per product.
    Spark plans it as an aggregate on (product, customer) and then on product,
    the same two-level shape as the pair route."""
    return (purchases(txn, country, on_error)
            .groupBy("product_id")
            .agg(F.count_distinct("customer_id").alias("popularity")))


def product_popularity_bitmaps(txn: DataFrame, country: str = ALL, on_error: str | None = None) -> DataFrame:
    """Popularity from bitmaps of customers: per product and bucket of 64 customer numbers one
    bitmap (a bigint), made per task and merged after one shuffle on (product, bucket); a product's popularity is
    the sum of its bitmaps' set bits. A repeated pair sets a bit again, so no pair is deduplicated by a shuffle.

    There are at most as many bitmaps as pairs, each the size of a customer number, so a product whose customers lie
    far apart takes no more than its pairs do. Customer ids must be whole numbers (any bigint); rows without one count nothing."""
    customer = F.col("customer_id").cast("bigint")
    bit = F.expr("shiftleft(1L, CAST(customer & 63 AS INT))")
    per_bucket = (purchases(txn, country, on_error)
                  .select("product_id", customer.alias("customer"))
                  .groupBy("product_id", F.shiftright("customer", 6).alias("bucket"))
                  .agg(F.bit_or(bit).alias("bits")))
    counted = F.sum(F.bit_count("bits")).cast("bigint")
    return per_bucket.groupBy("product_id").agg(F.coalesce(counted, F.lit(0).cast("bigint")).alias("popularity"))


def popularity_crosscheck(pop_a: DataFrame, pop_b: DataFrame) -> DataFrame:
    """One row: products seen by either plan and how many disagree (must be 0).
    Both inputs are already hash-partitioned on product_id, so the full outer
    join reuses that partitioning."""
    a = pop_a.select("product_id", F.col("popularity").alias("pop_a"))
    b = pop_b.select("product_id", F.col("popularity").alias("pop_b"))
    j = a.join(b, "product_id", "full_outer")
    differs = ~F.coalesce(F.col("pop_a") == F.col("pop_b"), F.lit(False))
    return j.agg(F.count(F.lit(1)).alias("n_products"),
                 F.sum(F.when(differs, 1).otherwise(0)).cast("bigint").alias("n_mismatch"))


def top_products(popularity: DataFrame, h: int) -> DataFrame:
    """The H most popular products, ties by ascending product id.

    ``h == 0`` gives the full listing ordered by product id (the debug listing);
    ``h > 0`` plans as TakeOrderedAndProject (per-task top-H, then merge).
    """
    if h < 0:
        raise ValueError("H must be >= 0")
    if h == 0:
        return popularity.orderBy("product_id")
    return popularity.orderBy(F.desc("popularity"), F.asc("product_id")).limit(h)
