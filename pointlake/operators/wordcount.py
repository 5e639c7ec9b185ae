"""Word counting over line documents, in the four plans of the reference.

Input: a DataFrame of documents with id column(s) and a ``value`` text column
(one line = one document). All plans give the same counts; they differ in how
map-side combining and skew protection are arranged. A word held by a third of
all documents still reaches each reducer as at most one partial row per map
task, because every plan aggregates before its shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import java_space_split, utf16_length


def words(docs: DataFrame, id_cols: Sequence[str] = (), value_col: str = "value") -> DataFrame:
    """One row per token (Java ``split(" ")`` semantics), keeping ``id_cols``."""
    return docs.select(*id_cols, F.explode(java_space_split(value_col)).alias("word"))


def doc_term_freq(docs: DataFrame, id_cols: Sequence[str], value_col: str = "value") -> DataFrame:
    """Per-document term frequency: (id..., word, n); a row is a document.

    Counted inside the row, without a shuffle: run lengths over the sorted
    tokens (a run starts where a token differs from the one before it)."""
    tokens = docs.select(*id_cols, F.array_sort(java_space_split(value_col)).alias("_t"))
    starts = F.filter(F.sequence(F.lit(1), F.size("_t")), lambda i: (i == 1) | (
        F.get("_t", i - 1) != F.get("_t", i - 2)))
    runs = tokens.filter(F.size("_t") > 0).select(*id_cols, "_t", starts.alias("_s"))
    run = F.transform("_s", lambda i, k: F.struct(
        F.get("_t", i - 1).alias("word"),
        (F.coalesce(F.get("_s", k + 1), F.size("_t") + 1) - i).cast("bigint").alias("n")))
    return runs.select(*id_cols, F.inline(run))


def word_count(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """(word, n) over all documents: partial count per task, one shuffle on word."""
    return words(docs, (), value_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_salted(docs: DataFrame, id_cols: Sequence[str], buckets: int,
                      value_col: str = "value") -> DataFrame:
    """Two-round count: documents are dealt to ``buckets`` salt groups by a hash
    of their id (deterministic, so retried tasks agree), counted per (salt, word),
    then summed per word."""
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in id_cols]), F.lit(buckets))
    per_salt = (docs.select(salt.alias("salt"), F.col(value_col))
                .select("salt", F.explode(java_space_split(value_col)).alias("word"))
                .groupBy("salt", "word").agg(F.count(F.lit(1)).alias("n")))
    return per_salt.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


#: A task of ``word_count_partitioned`` passes its counts on beyond this many rows held.
HELD_ROWS = 500_000


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of a partition: the counts of its batches merged, in bounded memory."""
    held, rows = [], 0

    def merged() -> pa.Table:
        return pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    for batch in batches:
        counts = pc.value_counts(batch.column(0).cast(pa.string()))
        held.append(pa.RecordBatch.from_arrays(counts.flatten(), names=["word", "n"]))
        rows += len(counts)
        if rows > HELD_ROWS:
            held = merged().to_batches()
            rows = sum(map(len, held))
            if rows > HELD_ROWS // 2:  # mostly different words: holding them longer would not combine much
                yield from held
                held, rows = [], 0
    if held:
        yield from merged().to_batches()


def word_count_partitioned(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """Counts combined per input partition by a step of its own (MapInArrow in the plan), then summed:
    only a partition's (word, count) rows move, once. The combine is not the partial aggregate of ``word_count``;
    it holds at most ``HELD_ROWS`` rows and passes them on beyond that, so a word may come several times from a partition."""
    combined = words(docs, (), value_col).mapInArrow(_combined, "word string, n bigint")
    return combined.groupBy("word").agg(F.sum("n").alias("n"))


def distinct_word_count(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count(F.lit(1)).alias("distinct_words"))


def word_sketches(docs: DataFrame, buckets: int, value_col: str = "value", lg_k: int = 14) -> DataFrame:
    """(bucket, sketch): a HyperLogLog sketch of the words of each of ``buckets`` shares of the
    documents (by hash of the text, so reruns agree). Sketches of fixed size are what a store keeps: those of
    new documents merge with the old ones, and only sketches are shuffled, never words."""
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    bucket = F.pmod(F.xxhash64(F.col(value_col)), F.lit(buckets)).cast("int")
    rows = docs.select(bucket.alias("bucket"), F.explode(java_space_split(value_col)).alias("word"))
    return rows.groupBy("bucket").agg(F.hll_sketch_agg("word", F.lit(lg_k)).alias("sketch"))


def approx_distinct_words(sketches: DataFrame) -> DataFrame:
    """One row ``distinct_words``: the estimate of the union of sketches (0 without any). The relative standard
    error of a sketch of 2^lg_k registers is about 1.04 / sqrt(2^lg_k): 0.8 % at 14."""
    union = sketches.agg(F.hll_union_agg("sketch").alias("s"))
    return union.select(F.coalesce(F.hll_sketch_estimate("s"), F.lit(0)).cast("bigint").alias("distinct_words"))


def avg_word_length(counts: DataFrame, utf16: bool = True) -> DataFrame:
    """Mean length over distinct words: integer division as in the reference
    (``avg_length``), plus the exact mean. NULL when there are no words. A length is
    in UTF-16 code units (Java), or in code points with ``utf16=False``."""
    length = utf16_length("word") if utf16 else F.length("word")
    agg = counts.agg(F.sum(length).cast("bigint").alias("total_length"),
                     F.count(F.lit(1)).alias("distinct_words"))
    return agg.select(
        "distinct_words", "total_length",
        F.when(F.col("distinct_words") > 0,
               F.expr("total_length div distinct_words")).alias("avg_length"),
        F.when(F.col("distinct_words") > 0,
               F.col("total_length") / F.col("distinct_words")).alias("avg_length_exact"))
