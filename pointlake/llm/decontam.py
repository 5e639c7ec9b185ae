"""Benchmark decontamination by size-partitioned MinHash containment search.

Texts are lower-cased, cut into words (runs of letters and digits) and hashed
into 5-word shingles. A test item is kept as the bottom-k sketch of its shingle
hashes; a document of any length is streamed against the sketches, and its hits
estimate the share of the item it contains, which unlike set similarity does not
shrink with the document. Items are partitioned by size (powers of two): each
class has the number of hits below which an item contained to the threshold
falls with probability at most ``MISS``. Pairs with enough hits are verified by exact
containment of the whole shingle sets.

Documents are never shuffled by shingle: sketches are broadcast in blocks of at
most ``BLOCK_ROWS`` rows, one pass over the documents per block, and hits are
aggregated per (document, item) where they arise.

An item of one to four words is one shingle of all its words; documents are also cut into
shingles of those lengths, as far as they occur among the items, so it is found inside documents of any length.

Edge cases: a document of fewer words than an item's shingles holds none of them; texts without words (null,
empty) match nothing; rows that share an id count as one document or item; a
null id is an id like any other; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, read_table, store

SHINGLE = 5
THRESHOLD = 0.8
SKETCH = 24
MISS = 1e-9
BLOCK_ROWS = 500_000


def _hashes(w: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` words, repeats included."""
    n = F.size(w)
    return F.when(n >= length, F.transform(F.sequence(F.lit(0), n - length), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(length)]))) \
            .otherwise(F.array().cast("array<long>"))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _bound(w: Column, of) -> Column:
    """``of`` the words, which are bound once, as the only element of an array, not recomputed at every use."""
    return F.element_at(F.transform(F.array(w), of), 1)


def document_hashes(text: Column, short: Sequence[int] = ()) -> Column:
    """Hashes of a document's shingles, repeats included: of SHINGLE words, and of the lengths in ``short``."""
    return _bound(_words(text), lambda w: F.concat(*[_hashes(w, n) for n in (SHINGLE, *short)]))


def item_hashes(text: Column) -> Column:
    """Hashes of an item's shingles; one of fewer than SHINGLE words is a single shingle of all its words."""
    def of(w: Column) -> Column:
        out = _hashes(w, SHINGLE)
        for n in range(1, SHINGLE):
            out = F.when(F.size(w) == n, _hashes(w, n)).otherwise(out)
        return out

    return _bound(_words(text), of)


def short_lengths(items: DataFrame) -> list[int]:
    """Numbers of words below SHINGLE that occur among the items, at most SHINGLE - 1 of them."""
    n = items.select(F.size(_words(F.col("text"))).alias("n")).filter((F.col("n") > 0) & (F.col("n") < SHINGLE))
    return sorted(r.n for r in n.distinct().collect())


@cache
def least_hits(size: int, sketch: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Most hits h with P(fewer than h of the sketch are shared) <= miss, when
    ceil(threshold * size) of the item's shingles are shared (hypergeometric)."""
    shared = -(-round(threshold * size * 1000) // 1000)
    total, below = comb(size, sketch), 0.0
    for hits in range(sketch + 1):
        below += comb(shared, hits) * comb(size - shared, sketch - hits) / total
        if below > miss:
            return max(1, hits)
    return max(1, sketch)


def class_hits(level: int) -> int:
    """Hits asked of items with 2**level to 2**(level+1)-1 shingles: the least of the class."""
    low = 1 << level
    sizes = range(low, 2 * low) if level <= 8 else range(low, 2 * low, low // 64)
    return min(least_hits(n, min(n, SKETCH)) for n in sizes)


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, hash, n_item) with distinct hashes per item."""
    rows = items.select("item_id", F.explode(item_hashes(F.col("text"))).alias("hash")).distinct()
    sizes = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    r, s = rows.alias("r"), sizes.alias("s")
    return r.join(s, F.col("r.item_id").eqNullSafe(F.col("s.item_id"))).select("r.item_id", "hash", "n_item")


def hits(docs: DataFrame, table: DataFrame, short: Sequence[int] = ()) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared): distinct hashes of ``table`` (item_id,
    hash, n_item) that the document has; ``short`` as in ``document_hashes``."""
    total = table.count()
    blocks = max(1, -(-total // BLOCK_ROWS))
    stream = docs.select("doc_id", F.explode(document_hashes(F.col("text"), short)).alias("hash"))
    out = None
    for b in range(blocks):
        block = table if blocks == 1 else table.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        part = stream.join(broadcast_if_small(block, 40), "hash")
        part = part.groupBy("doc_id", "item_id", "n_item", "hash").agg(F.lit(1).alias("one"))
        part = part.groupBy("doc_id", "item_id", "n_item").agg(F.count(F.lit(1)).alias("n_shared"))
        out = part if out is None else out.unionAll(part)
    return out


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every pair found whose
    exact containment of the item in the document reaches the threshold."""
    table = store(item_shingles(items), "bench-shingles")
    short = short_lengths(items)
    rank = F.row_number().over(W.partitionBy("item_id").orderBy("hash"))
    sketch = store(table.withColumn("rank", rank).filter(F.col("rank") <= SKETCH).drop("rank"), "bench-sketches")
    level = F.floor(F.log2(F.col("n_item"))).cast("int")
    asked = F.element_at(F.array(*[F.lit(class_hits(k)) for k in range(24)]), F.least(level, F.lit(23)) + 1)
    found = hits(docs, sketch, short).filter(F.col("n_shared") >= asked).select("doc_id", "item_id")
    found = store(found, "bench-candidates")
    one = broadcast_if_small(store(found.select("doc_id").distinct(), "bench-docs"), 64).alias("c")
    d = docs.select("doc_id", "text").alias("d")
    again = d.join(one, F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")), "left_semi")
    exact, f = hits(again, table, short).alias("e"), found.alias("f")
    pairs = exact.join(f, F.col("e.doc_id").eqNullSafe(F.col("f.doc_id"))
                       & F.col("e.item_id").eqNullSafe(F.col("f.item_id")), "left_semi")
    ratio = F.col("n_shared") / F.col("n_item")
    return pairs.select("doc_id", "item_id", "n_item", "n_shared", ratio.alias("containment")).filter(
        ratio >= F.lit(threshold))


def op6(spark, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
WITH docs AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
              FROM documents),
items AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
          FROM benchmark),
short AS (SELECT DISTINCT len(w) AS n FROM items WHERE len(w) BETWEEN 1 AND 4 UNION SELECT 5),
doc_shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
  FROM docs, short WHERE len(w) >= n),
item_shingles AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0
    THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM items),
sizes AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id)
SELECT doc_id, i.item_id, n_item, count(*) AS n_shared, count(*)::DOUBLE / n_item AS containment
FROM doc_shingles d JOIN item_shingles i USING (s) JOIN sizes z ON z.item_id = i.item_id
GROUP BY doc_id, i.item_id, n_item HAVING count(*)::DOUBLE / n_item >= 0.8
"""
