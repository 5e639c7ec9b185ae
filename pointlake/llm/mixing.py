"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key ``-ln(u) / quality`` (``u`` a hash of
its id, so reruns agree); within a source the mix takes documents by ascending
key, which is weighted sampling without replacement. A source's target is first
spent on complete epochs (every document once), the rest on a prefix of the key
order: documents wholly before the cut, and from the document at the cut just
the words that still fit, so the target is met to the word.

The prefix sum never puts a source into one task: keys fall into ordered
buckets by ``exp(-key)``, bucket totals give the bucket that holds the cut, and
only that bucket's rows are ordered. What is decided per source is one row (epochs,
cut, share at the cut), joined back to the documents without ordering them.

Edge cases: a null text has size 0 and is never cut; a null source is a source
of its own, ranked last; a null id sorts first and is hashed as the empty string;
rows that tie in key, id and size share the words at the cut equally (whole words,
rounded down); no documents, or only empty ones, give targets of 0; columns
other than the three used are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, read_table, store, word_count

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
MAX_EPOCHS = 2
#: Rows of a source that one key bucket holds on average, and the least number of buckets.
BUCKET_ROWS = 50_000
MIN_BUCKETS = 64


def default_quality() -> Column:
    """Quality weight of a document, 0.5 to 1.5: very short documents count less."""
    return F.lit(0.5) + F.least(F.col("size"), F.lit(400)) / F.lit(400.0)


def sampling_key(seed: str, quality: Column) -> Column:
    """-ln(u) / quality with u in (0, 1) from the first 52 bits of an MD5 of the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))
    return -F.log(u) / quality


def keyed(docs: DataFrame, seed: str = "mix", quality: Column | None = None) -> DataFrame:
    """(doc_id, source, size, key) of every document."""
    base = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return base.withColumn("key", sampling_key(seed, default_quality() if quality is None else quality))


def source_targets(base: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, weight, target.

    ``min(max_epochs * size, level * weight)`` with the one level at which the
    targets add up to ``total`` times all sizes: what resharing the excess by
    weight until nobody is above its bound converges to. The level follows from
    sorting sources by size / weight. The table has a row per source, so its
    windows order the list of sources, not documents.
    """
    per = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * max_epochs)
    ratio = F.col("cap") / F.col("weight")
    per = per.withColumn("ratio", ratio)
    lower = W.orderBy("ratio").rangeBetween(W.unboundedPreceding, W.currentRow)
    everything = W.partitionBy(F.lit(1))
    per = (per
           .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(total)))
           .withColumn("cap_upto", F.sum("cap").over(lower)).withColumn("weight_upto", F.sum("weight").over(lower))
           .withColumn("cap_same", F.sum("cap").over(W.partitionBy("ratio")))
           .withColumn("weight_same", F.sum("weight").over(W.partitionBy("ratio")))
           .withColumn("weight_all", F.sum("weight").over(everything)))
    level = ((F.col("budget") - (F.col("cap_upto") - F.col("cap_same")))
             / (F.col("weight_all") - F.col("weight_upto") + F.col("weight_same")))
    per = per.withColumn("level", level)
    # the level of the first ratio group that it does not exceed; none: every source is at its bound
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))
    per = per.withColumn("level", F.min_by("level", fits).over(everything))
    target = F.least(F.col("cap").cast("double"),
                     F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return per.select("source", "source_size", "n_docs", "weight", target.alias("target"))


def source_cuts(base: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source: epochs, and the place in key order at which the
    fractional epoch ends (key, id and size of the document at the cut, words each
    row there still gives)."""
    plan = targets.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = plan.withColumn("rest", F.floor(F.col("target") + 0.5).cast("long") - F.col("epochs") * F.col("source_size"))
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-largest // BUCKET_ROWS))
    rows = base.filter("size > 0").withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * buckets))
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = W.partitionBy("source").orderBy("bucket")
    totals = totals.withColumn("upto", F.sum("words").over(upto))
    p, t = plan.alias("p"), totals.alias("t")
    crossing = (t.join(p, F.col("t.source").eqNullSafe(F.col("p.source")))
                .filter("t.upto >= p.rest and t.upto - t.words < p.rest")
                .select("t.source", "t.bucket", "p.rest", (F.col("t.upto") - F.col("t.words")).alias("before")))
    r, c = rows.alias("r"), crossing.alias("c")
    ident = F.coalesce(F.col("r.doc_id"), F.lit(-(1 << 63)).cast("long"))
    held = (r.join(broadcast_if_small(store(crossing, "mix-crossing"), 80).alias("c"),
                   F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.bucket") == F.col("c.bucket")))
            .select("r.source", "key", ident.alias("ident"), "size", "rest", "before"))
    peers = held.groupBy("source", "key", "ident", "size", "rest", "before").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("source").orderBy("key", "ident", "size").rowsBetween(W.unboundedPreceding, -1)
    peers = peers.withColumn("start", F.col("before") + F.coalesce(
        F.sum(F.col("size") * F.col("n")).over(order), F.lit(0)))
    cut = (peers.filter("start < rest and start + size * n >= rest")
           .select("source", F.col("key").alias("cut_key"), F.col("ident").alias("cut_ident"),
                   F.col("size").alias("cut_size"), F.floor((F.col("rest") - F.col("start")) / F.col("n")).alias("cut_share")))
    p, q = plan.alias("p"), cut.alias("q")
    return p.join(q, F.col("p.source").eqNullSafe(F.col("q.source")), "left").select(
        "p.*", "cut_key", "cut_ident", "cut_size", "cut_share")


def with_taken(base: DataFrame, cuts: DataFrame) -> DataFrame:
    """Every row of ``base`` with source_size, target, taken and copies (whole
    copies that a mix of whole documents holds: the document at the cut counts if
    at least half of it is taken). ``cuts`` is broadcast if its size allows."""
    b, c = base.alias("b"), broadcast_if_small(cuts, 120).alias("c")
    ident = F.coalesce(F.col("b.doc_id"), F.lit(-(1 << 63)).cast("long"))
    place = F.struct(F.col("b.key").alias("k"), ident.alias("i"), F.col("b.size").alias("s"))
    cut = F.struct(F.col("c.cut_key").alias("k"), F.col("c.cut_ident").alias("i"), F.col("c.cut_size").alias("s"))
    part = F.when(F.col("c.cut_key").isNull(), F.lit(0)).when(place < cut, F.col("b.size")).when(
        place == cut, F.col("c.cut_share")).otherwise(F.lit(0)).cast("long")
    return (b.join(c, F.col("b.source").eqNullSafe(F.col("c.source")))
            .select("b.*", "c.source_size", "c.target", "c.epochs", part.alias("part"))
            .withColumn("taken", (F.col("epochs") * F.col("size") + F.col("part")).cast("long"))
            .withColumn("copies", (F.col("epochs") + F.when((F.col("part") > 0) & (F.col("part") * 2 >= F.col("size")), 1)
                                   .otherwise(0)).cast("int")))


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL,
                max_epochs: int = MAX_EPOCHS, seed: str = "mix", quality: Column | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies) per document."""
    base = store(keyed(docs, seed, quality), "mix-keys")
    cuts = store(source_cuts(base, store(source_targets(base, weights, total, max_epochs), "mix-targets")), "mix-cuts")
    return with_taken(base, cuts).select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL,
                    max_epochs: int = MAX_EPOCHS, seed: str = "mix", quality: Column | None = None) -> DataFrame:
    """The mix itself: rows of ``docs`` (same columns), each as often as the mix
    holds it. The texts stay where they were scanned; only the source's
    cut is joined to them."""
    base = store(keyed(docs, seed, quality), "mix-keys")
    cuts = store(source_cuts(base, store(source_targets(base, weights, total, max_epochs), "mix-targets")), "mix-cuts")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), own)
    rows = rows.withColumn("key", sampling_key(seed, default_quality() if quality is None else quality))
    taken = with_taken(rows, cuts).filter("copies > 0")
    return taken.select("own", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("own.*")


def op3(spark, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH base AS (
  SELECT doc_id, source, size, -ln(u) / (0.5 + least(size, 400) / 400.0::DOUBLE) AS key,
         coalesce(doc_id, -9223372036854775808) AS ident
  FROM (SELECT doc_id, source,
          len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
          (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
            / 4503599627370496::DOUBLE AS u
        FROM documents)),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM base GROUP BY source),
ratios AS (SELECT *, source_size * 2 AS cap, (source_size * 2)::DOUBLE / weight AS ratio,
                  sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM per),
levels AS (
  SELECT a.ratio,
         (any_value(a.budget) - coalesce(sum(b.cap) FILTER (b.ratio < a.ratio), 0)::DOUBLE)
           / (sum(b.weight) FILTER (b.ratio >= a.ratio))::DOUBLE AS level
  FROM (SELECT DISTINCT ratio, budget FROM ratios) a, ratios b GROUP BY a.ratio),
level AS (SELECT arg_min(level, ratio) AS level FROM levels WHERE level <= ratio),
targets AS (SELECT r.*, least(cap::DOUBLE, coalesce(level * weight, cap::DOUBLE)) AS target FROM ratios r, level),
plan AS (
  SELECT *, floor(target + 0.5)::BIGINT - epochs * source_size AS rest
  FROM (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets)),
ordered AS (
  SELECT b.*, p.source_size, p.target, p.epochs, p.rest,
         coalesce(sum(size) OVER (PARTITION BY b.source ORDER BY key, ident, size), 0)::BIGINT AS upto,
         count(*) OVER (PARTITION BY b.source, key, ident, size) AS n
  FROM base b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + CASE WHEN size = 0 OR rest <= 0 THEN 0 WHEN upto < rest THEN size
          WHEN upto - n * size >= rest THEN 0
          ELSE floor((rest - (upto - n * size)) / n)::BIGINT END)::BIGINT AS taken
FROM ordered
"""
