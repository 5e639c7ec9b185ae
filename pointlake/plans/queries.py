"""Driver queries over the test tables and their DuckDB oracle SQL.

Each query reads whole tables (no id subsets, no row caps); the only limits are
the top-H / (z+1)-largest features themselves. Column names are identical on
both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import baskets as B
from ..operators import wordcount as W
from ..operators.heavy import top_products_by_summaries
from ..sources.sink import publish, read_published
from ..sources.text import lines_of_documents, read_lines
from ..sources.transactions import TXN_SQL, parse_transactions, transactions_from_tables
from .session import dealt, ensure_checkpoint_dir, read_table, table_path

Query = Callable[[SparkSession, str], DataFrame]

# Fixed query parameters.
COUNTRY = "NATION_7"
TOP_H = 10
TOP_H_COUNTRY = 5
SALT_BUCKETS = 8

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- baskets

def txn(spark: SparkSession, sf: str) -> DataFrame:
    return transactions_from_tables(spark, sf)


def bought(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions for queries about purchases: returned lines are left at the scan."""
    return transactions_from_tables(spark, sf, purchases_only=True)


_TXN = f"WITH txn AS ({TXN_SQL})\n"
_PURCHASES_ALL = "SELECT * FROM txn WHERE quantity > 0"
_PURCHASES_CTRY = f"SELECT * FROM txn WHERE quantity > 0 AND country = '{COUNTRY}'"


@register("txn_rows", _TXN + "SELECT * FROM txn")
def q_txn_rows(spark, sf):
    return txn(spark, sf)


@register("txn_row_count", _TXN + "SELECT count(*) AS n_rows FROM txn")
def q_txn_row_count(spark, sf):
    return txn(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"))


@register("product_customer_pairs",
          _TXN + f"SELECT DISTINCT product_id, customer_id FROM ({_PURCHASES_ALL})")
def q_pairs(spark, sf):
    return B.product_customer_pairs(bought(spark, sf))


@register("product_customer_pairs_country",
          _TXN + f"SELECT DISTINCT product_id, customer_id FROM ({_PURCHASES_CTRY})")
def q_pairs_country(spark, sf):
    return B.product_customer_pairs(bought(spark, sf), COUNTRY)


@register("product_customer_pairs_salted",
          _TXN + f"SELECT DISTINCT product_id, customer_id FROM ({_PURCHASES_ALL})")
def q_pairs_salted(spark, sf):
    return B.product_customer_pairs_salted(bought(spark, sf), buckets=SALT_BUCKETS)


@register("product_customer_pair_count",
          _TXN + f"SELECT count(*) AS n_pairs FROM (SELECT DISTINCT product_id, customer_id "
                 f"FROM ({_PURCHASES_ALL}))")
def q_pair_count(spark, sf):
    return B.pair_count(B.product_customer_pairs(bought(spark, sf)))


_POP_ALL = (f"SELECT product_id, count(DISTINCT customer_id) AS popularity "
            f"FROM ({_PURCHASES_ALL}) GROUP BY product_id")
_POP_CTRY = (f"SELECT product_id, count(DISTINCT customer_id) AS popularity "
             f"FROM ({_PURCHASES_CTRY}) GROUP BY product_id")


@register("product_popularity", _TXN + _POP_ALL)
def q_popularity(spark, sf):
    return B.product_popularity(B.product_customer_pairs(bought(spark, sf)))


@register("product_popularity_country", _TXN + _POP_CTRY)
def q_popularity_country(spark, sf):
    return B.product_popularity(B.product_customer_pairs(bought(spark, sf), COUNTRY))


@register("product_popularity_distinct", _TXN + _POP_ALL)
def q_popularity_distinct(spark, sf):
    return B.product_popularity_distinct(bought(spark, sf))


@register("popularity_crosscheck",
          _TXN + f"SELECT count(*) AS n_products, "
                 "count(*) FILTER (a.popularity IS DISTINCT FROM b.popularity) AS n_mismatch "
                 f"FROM (SELECT product_id, count(*) AS popularity FROM (SELECT DISTINCT product_id, customer_id "
                 f"FROM ({_PURCHASES_ALL})) GROUP BY product_id) a FULL JOIN ({_POP_ALL}) b USING (product_id)")
def q_crosscheck(spark, sf):
    t = bought(spark, sf)
    return B.popularity_crosscheck(B.product_popularity(B.product_customer_pairs(t)),
                                   B.product_popularity_distinct(t))


@register("popularity_listing", _TXN + _POP_ALL + " ORDER BY product_id")
def q_listing(spark, sf):
    return B.top_products(B.product_popularity(B.product_customer_pairs(bought(spark, sf))), 0)


@register("top_products",
          _TXN + _POP_ALL + f" ORDER BY popularity DESC, product_id LIMIT {TOP_H}")
def q_top_products(spark, sf):
    return B.top_products(B.product_popularity(B.product_customer_pairs(bought(spark, sf))), TOP_H)


@register("top_products_country",
          _TXN + _POP_CTRY + f" ORDER BY popularity DESC, product_id LIMIT {TOP_H_COUNTRY}")
def q_top_products_country(spark, sf):
    return B.top_products(
        B.product_popularity(B.product_customer_pairs(bought(spark, sf), COUNTRY)), TOP_H_COUNTRY)


@register("txn_text_pair_count",
          _TXN + f"SELECT count(*) AS n_pairs FROM (SELECT DISTINCT product_id, customer_id "
                 f"FROM ({_PURCHASES_ALL}))")
def q_txn_text_pair_count(spark, sf):
    """The text transaction source on whole tables: every transaction rendered
    as an 8-field line (Spark-derived), parsed back with the parse-order and
    failure rules, then the distinct purchase pairs counted."""
    t = transactions_from_tables(spark, sf)
    lines = t.select(F.concat_ws(
        ",", F.col("transaction_id").cast("string"), F.col("product_id").cast("string"),
        F.lit("ITEM"), F.col("quantity").cast("string"), F.lit("2010-12-01 08:26:00"),
        F.lit("1.0"), F.col("customer_id").cast("string"), F.col("country")).alias("value"))
    parsed = parse_transactions(lines, on_error="fail")
    return B.pair_count(B.product_customer_pairs(parsed, on_error="fail"))


@register("top_products_summaries",
          _TXN + _POP_ALL + f" ORDER BY popularity DESC, product_id LIMIT {TOP_H}")
def q_top_products_summaries(spark, sf):
    return top_products_by_summaries(B.product_customer_pairs(bought(spark, sf)), TOP_H)


@register("product_popularity_bitmaps", _TXN + _POP_ALL)
def q_popularity_bitmaps(spark, sf):
    return B.product_popularity_bitmaps(bought(spark, sf))


@register("popularity_sink", _TXN + _POP_ALL)
def q_popularity_sink(spark, sf):
    """The result sink on a whole result: popularity written in partitions of product ids, read back."""
    path = f"{ensure_checkpoint_dir(spark)}/popularity-{uuid.uuid4().hex}"
    popularity = B.product_popularity(B.product_customer_pairs(bought(spark, sf)))
    publish(popularity.withColumn("share", F.pmod("product_id", F.lit(SALT_BUCKETS))).repartition("share"), path, ("share",))
    return read_published(spark, path).drop("share")


# ---------------------------------------------------------------- word count

def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return lines_of_documents(dealt(docs, table_path(sf, "documents")))


_LINES = r"""
WITH parts AS (
  SELECT doc_id, regexp_split_to_array(text, '\r\n|\n|\r') AS p FROM documents),
lines_arr AS (
  SELECT doc_id, CASE WHEN p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS ls FROM parts),
lines AS (
  SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no, unnest(ls) AS value
  FROM lines_arr),
toks AS (
  SELECT doc_id, line_no,
         CASE WHEN value = '' THEN ['']
              WHEN rtrim(value, ' ') = '' THEN []::VARCHAR[]
              ELSE string_split(rtrim(value, ' '), ' ') END AS t
  FROM lines),
words AS (SELECT doc_id, line_no, unnest(t) AS word FROM toks),
wc AS (SELECT word, count(*) AS n FROM words GROUP BY word)
"""


@register("src_documents",
          _LINES + "SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id")
def q_src_documents(spark, sf):
    return doc_lines(spark, sf).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


@register("doc_term_freq",
          _LINES + "SELECT doc_id, line_no, word, count(*) AS n FROM words "
                   "GROUP BY doc_id, line_no, word")
def q_doc_term_freq(spark, sf):
    return W.doc_term_freq(doc_lines(spark, sf), ["doc_id", "line_no"])


@register("word_count", _LINES + "SELECT word, n FROM wc")
def q_word_count(spark, sf):
    return W.word_count(doc_lines(spark, sf))


@register("word_count_salted", _LINES + "SELECT word, n FROM wc")
def q_word_count_salted(spark, sf):
    return W.word_count_salted(doc_lines(spark, sf), ["doc_id", "line_no"], SALT_BUCKETS)


@register("word_count_partitioned", _LINES + "SELECT word, n FROM wc")
def q_word_count_partitioned(spark, sf):
    return W.word_count_partitioned(doc_lines(spark, sf))


@register("distinct_word_count", _LINES + "SELECT count(*) AS distinct_words FROM wc")
def q_distinct_word_count(spark, sf):
    return W.distinct_word_count(W.word_count(doc_lines(spark, sf)))


@register("avg_word_length", _LINES + r"""
SELECT count(*) AS distinct_words, CAST(sum(units) AS BIGINT) AS total_length,
       CAST(sum(units) AS BIGINT) // count(*) AS avg_length,
       CAST(sum(units) AS BIGINT) / count(*) AS avg_length_exact
FROM (SELECT length(word) + length(regexp_replace(word, '[\x{0}-\x{FFFF}]', '', 'g')) AS units FROM wc)""")
def q_avg_word_length(spark, sf):
    return W.avg_word_length(W.word_count(doc_lines(spark, sf)))


@register("text_files_word_count", _LINES + "SELECT word, n FROM wc")
def q_text_files_word_count(spark, sf):
    """The text source with a least number of partitions: every line written to text files, read and counted."""
    path = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    doc_lines(spark, sf).select("value").write.text(path)
    return W.word_count(read_lines(spark, path, min_partitions=2 * SALT_BUCKETS))


#: Four standard errors of a sketch of 2^14 registers.
SKETCH_BOUND = 4 * 1.04 / 2 ** 7


@register("approx_distinct_words", _LINES + "SELECT count(*) AS distinct_words, true AS within_bound FROM wc")
def q_approx_distinct_words(spark, sf):
    """Exact distinct words, and whether the estimate from merged sketches is within four standard errors of them."""
    lines = doc_lines(spark, sf)
    estimate = W.approx_distinct_words(W.word_sketches(lines, SALT_BUCKETS)).select(F.col("distinct_words").alias("estimate"))
    exact = W.distinct_word_count(W.word_count(lines))
    off = F.abs(F.col("estimate") - F.col("distinct_words"))
    return exact.withColumn("estimate", estimate.scalar()).select(
        "distinct_words", (off <= F.col("distinct_words") * F.lit(SKETCH_BOUND)).alias("within_bound"))
