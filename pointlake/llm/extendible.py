"""Exact duplicates by an extendible-hash index on shared files.

Texts are equal when they are identical after each run of blanks has become one space.

1. Rows. Each document gets its row number, a 64-bit key (a hash of its normalised text) and the
   digest of that text; texts stay where they are.
2. Directory. Keys are counted per slot, the leading bits of the key. A bucket that holds more
   than ``capacity`` keys splits into the two halves of its key range, again and again, until none is
   overfull; a bucket's local depth is the number of its overfull ancestors. The directory (as many
   bits as the deepest bucket needs) maps each slot to the bucket it shares with its neighbours, and
   doubles while a single slot is overfull. The capacity grows with the table once it would need
   more than 2**DIRECTORY_BITS buckets, which bounds the directory.
3. Chains. Texts whose key occurs more than once are compared byte by byte: they are grouped by
   (key, text) with a combine in each task, so a group of copies moves one text per task. Different
   texts under one key form a chain, whose members are told apart by digest; a digest that names two
   texts fails the run.
4. Index files. Tasks own ranges of buckets, thus key ranges: each receives the entries of its
   buckets, numbers the chains and writes one file, sorted by bucket, key and place.
5. Lookup. Rows meet their entry by key and digest. Entries of large groups (at most ``HOT_KEYS`` of
   them, as their sizes add up to the table) are broadcast, so copies are not dealt by their key.

Edge cases: a null text is the empty text; blank texts normalise to '' or ' ', which differ; a null doc_id is
larger than any id, so it is the keep_id only of a group without ids; of rows that repeat an id and
a text exactly one is kept (the first in the order of the table's files); texts of any length are
compared whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, read_table, store

#: Bits of a key.
KEY_BITS = 64
#: Keys of a bucket, as long as 2**DIRECTORY_BITS buckets of that size hold all keys.
CAPACITY = 4096
DIRECTORY_BITS = 16
#: Slots start this many bits finer than the mean bucket.
SPARE_BITS = 2
#: A group is large from this many copies and from a HOT_KEYS-th of all rows.
HOT_ROWS, HOT_KEYS = 1_000, 100_000
#: Index entries of an owner task.
TASK_ENTRIES = 1_000_000


@dataclass
class Index:
    """``directory`` (slot, bucket, depth), ``depth`` its bits, ``entries`` (bucket, key, place, digest,
    keep_id, keep_row, group_size), ``rows`` (row, doc_id, key, digest) of the documents indexed."""

    directory: DataFrame
    depth: int
    entries: DataFrame
    rows: DataFrame


def normalised(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def text_key(text: Column, bits: int = KEY_BITS) -> Column:
    """The leading ``bits`` of a 64-bit hash, as an unsigned number unless it is the whole hash."""
    return F.shiftrightunsigned(F.xxhash64(text), KEY_BITS - bits)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def slot_of(key: Column, bits: int, depth: int) -> Column:
    """The first ``depth`` bits of a key of ``bits`` bits."""
    return F.shiftrightunsigned(key, bits - depth) if depth else F.lit(0).cast("long")


def build_directory(keys: DataFrame, bits: int = KEY_BITS, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """((slot, bucket, depth), directory bits) for the distinct ``keys`` (key). A bucket is named by its first slot."""
    n = keys.count()
    capacity = max(capacity, -(-n >> DIRECTORY_BITS))
    depth = min(bits, max(0, math.ceil(math.log2(max(1, n) / capacity))) + SPARE_BITS)
    while True:
        slots = keys.groupBy(slot_of(F.col("key"), bits, depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        slots = store(slots, "exact-slots")
        if depth == bits or not (slots.agg(F.max("n")).first()[0] or 0) > capacity:
            break
        depth += 1  # the directory doubles
    # every slot with each of its ancestors: level 0 is the one bucket that the index starts with
    levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
    levels = levels.withColumn("bucket", F.expr(f"shiftrightunsigned(slot, {depth} - level)"))
    overfull = levels.groupBy("level", "bucket").agg(F.sum("n").alias("n")).filter(F.col("n") > capacity).select("level", "bucket")
    split = levels.join(overfull, ["level", "bucket"], "left_semi").groupBy("slot").agg(F.count(F.lit(1)).alias("depth"))
    found = slots.select("slot").join(split, "slot", "left").select("slot", F.coalesce("depth", F.lit(0)).cast("int").alias("depth"))
    first = F.expr(f"shiftleft(shiftrightunsigned(slot, {depth} - depth), {depth} - depth)")
    return store(found.select("slot", first.alias("bucket"), "depth"), "exact-directory"), depth


def build_index(docs: DataFrame, bits: int = KEY_BITS, capacity: int = CAPACITY) -> Index:
    """The index of all rows of ``docs`` (doc_id, text), written into the shared folder."""
    texts = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    rows = store(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_key(F.col("text"), bits).alias("key"),
                              digest(F.col("text")).alias("digest")), "exact-rows")
    keys = store(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "exact-keys")
    directory, depth = build_directory(keys.select("key"), bits, capacity)

    shared = store(keys.filter("n > 1").select("key"), "exact-shared")
    texts = texts.select("text", text_key(F.col("text"), bits).alias("key"))
    texts = texts.join(broadcast_if_small(shared, 16), "key", "left_semi").groupBy("key", "text").agg(F.count(F.lit(1)).alias("n"))
    chains = texts.select("key", digest(F.col("text")).alias("digest"), "n").groupBy("key", "digest").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"))

    low = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("low")
    entries = rows.groupBy("key", "digest").agg(low, F.count(F.lit(1)).alias("group_size"))
    entries = entries.join(chains, ["key", "digest"], "left")
    same = F.when((F.col("texts") > 1) | (F.col("n") != F.col("group_size")) | F.col("n").isNull() & (F.col("group_size") > 1),
                  F.raise_error(F.lit("one digest names two texts"))).otherwise(F.col("group_size"))
    entries = entries.select(slot_of(F.col("key"), bits, depth).alias("slot"), "key", "digest", F.col("low.doc_id").alias("keep_id"),
                             F.col("low.row").alias("keep_row"), same.cast("long").alias("group_size"))
    entries = entries.join(broadcast_if_small(directory.select("slot", "bucket"), 32), "slot")
    tasks = max(1, -(-rows.count() // TASK_ENTRIES), rows.sparkSession.sparkContext.defaultParallelism)
    owned = entries.repartitionByRange(tasks, "bucket").sortWithinPartitions("bucket", "key", "digest")
    place = F.row_number().over(W.partitionBy("bucket", "key").orderBy("digest"))
    owned = owned.select("bucket", "key", place.alias("place"), "digest", "keep_id", "keep_row", "group_size")
    return Index(directory, depth, store(owned, "exact-index"), rows)


def exact_duplicates(docs: DataFrame, bits: int = KEY_BITS, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) per row of ``docs``."""
    index = build_index(docs, bits, capacity)
    found = index.entries.select("key", "digest", "keep_id", "keep_row", "group_size")
    least = max(HOT_ROWS, -(-index.rows.count() // HOT_KEYS))
    hot = F.broadcast(found.filter(F.col("group_size") >= least))  # at most HOT_KEYS entries
    rest = index.rows.join(hot.select("key", "digest"), ["key", "digest"], "left_anti")
    out = index.rows.join(hot, ["key", "digest"]).unionByName(
        rest.join(found.filter(F.col("group_size") < least), ["key", "digest"]))
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def op13(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
g AS (SELECT text, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g ON t.text = g.text
"""
