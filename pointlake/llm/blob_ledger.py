"""Secret scan over versions with an incremental blob ledger.

Every version of a document is content-addressed (SHA-256 of its text). The
ledger, a Parquet folder, holds one row per scanned pair (blob, rule@version)
with the spans found. A scan takes only pairs the ledger lacks, scans each of
those blobs once whatever number of paths hold it, appends them, and joins
the findings back to all paths. A run that stops before its rows are written leaves the ledger as it was.
Two runs at once may scan a pair twice; findings count its spans once. The registered query scans the
table in two instalments against one ledger.

Rules match leftmost and without overlap. Spans come from built-in functions
alone: the k-th match starts after the k-th piece of ``split`` and all pieces
and matches before it, which a running sum over (blob, rule) adds up.

Edge cases: a null text is the empty blob; repeated rows share a blob and get equal
findings; a null id is a path like any other; an empty table gives an empty
result; a text of any length is scanned whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, shared_folder, store


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if the given group has at least ``least`` characters.
    ``hint`` is a cheaper pattern that every text with a match contains."""

    name: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


RULES = (
    Rule("assign", 1, r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6,
         r"(?i)(?:passw|secret|token|api_?key)[a-z]*[\"']?\x20*[:=]"),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16}"),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24, r"[0-9a-f]{24}"),
)
LEDGER = T.StructType([
    T.StructField("blob", T.StringType()), T.StructField("rule", T.StringType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])


def text_blob() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def _measured(key: str, r: Column) -> Column:
    return F.struct(F.lit(key).alias("rule"), F.length(r["piece"]).cast("long").alias("before"),
                    F.length(r["match"]).cast("long").alias("length"), F.length(r["part"]).alias("part"))


def scan_blobs(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """LEDGER rows for (blob, text, todo): a row per blob and rule key in ``todo``."""
    found = []
    for rule in rules:
        pattern, key = rule.pattern, rule.key
        hit = F.array_contains("todo", rule.key) & F.col("text").rlike(rule.hint)
        whole = F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1))
        kept = F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(rule.group + 1))
        rows = F.arrays_zip(F.split("text", pattern, -1).alias("piece"), whole.alias("match"), kept.alias("part"))
        found.append(F.when(hit, F.transform(rows, lambda r: _measured(key, r))))
    matches = (blobs.select("blob", F.array_compact(F.array(*found)).alias("found"))
               .select("blob", F.explode("found").alias("found"))
               .select("blob", F.posexplode("found").alias("place", "m"))
               .select("blob", "place", "m.*").filter("length is not null"))
    # a blob's text comes several times where a path is repeated
    matches = matches.repartition("blob", "rule").dropDuplicates(["blob", "rule", "place"])
    upto = W.partitionBy("blob", "rule").orderBy("place")
    end = F.sum(F.col("before") + F.col("length")).over(upto)
    least = F.element_at(F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.least)]), F.col("rule"))
    spans = (matches.withColumn("end", end).filter(F.col("part") >= least).groupBy("blob", "rule")
             .agg(F.sort_array(F.collect_list(F.struct((F.col("end") - F.col("length")).alias("start"), "end"))).alias("spans")))
    return spans


def update_ledger(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> int:
    """Scan the pairs that the ledger lacks and append them; returns their number.

    ``versions`` has (path, text). The text moves once, to the row that
    represents its blob; hot blobs are reduced to one row before that."""
    spark = versions.sparkSession
    keys = [r.key for r in rules]
    known = read_ledger(spark, ledger).select("blob", "rule")
    rows = versions.select(F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                           F.coalesce("text", F.lit("")).alias("text"))
    first = rows.select("path", text_blob().alias("blob")).groupBy("blob").agg(F.min("path").alias("path"))
    pairs = first.select("blob", "path", F.explode(F.array(*[F.lit(k) for k in keys])).alias("rule"))
    pairs = pairs.join(known, ["blob", "rule"], "left_anti")
    todo = store(pairs.groupBy("blob", "path").agg(F.collect_set("rule").alias("todo")), "ledger-todo")
    n = todo.agg(F.sum(F.size("todo"))).first()[0] or 0
    if not n:
        return 0
    texts = (rows.join(todo, "path").filter(text_blob() == F.col("blob")).select("blob", "text", "todo"))
    spans = scan_blobs(texts, rules)
    pairs = todo.select("blob", F.explode("todo").alias("rule"))
    pairs.join(spans, ["blob", "rule"], "left").write.mode("append").parquet(ledger)
    return n


def update_in_instalments(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, instalments: int = 2) -> list[int]:
    """Bring a ledger up to date as a growing history does: the i-th update sees the first i shares of the paths
    (by hash), so it scans only what the ones before have not. Returns the pairs scanned by each; the last update sees every row."""
    share = F.pmod(F.xxhash64(F.col("path").cast("string")), F.lit(instalments))
    return [update_ledger(versions.filter(share <= i) if i < instalments - 1 else versions, ledger, rules) for i in range(instalments)]


def read_ledger(spark, ledger: str) -> DataFrame:
    """The ledger so far; a folder that does not exist yet is an empty ledger."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def _named(name: str) -> Callable[[Column], Column]:
    return lambda s: s["name"] == name


def findings(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row of ``versions`` (path, text): path, blob, counts per rule name, and
    all spans as ``rule:start:end`` by start, then rule order, comma-joined."""
    spark = versions.sparkSession
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)])
    hits = (read_ledger(spark, ledger).filter(F.col("rule").isin([r.key for r in rules]))
            .select("blob", "rule", F.explode("spans").alias("s"))
            .select("blob", F.struct(F.col("s.start").alias("start"), F.element_at(order, F.col("rule")).alias("place"),
                                     F.col("s.end").alias("end"), F.split_part("rule", F.lit("@"), F.lit(1)).alias("name")).alias("s")))
    # a set: a pair that two writers scanned at once is there twice, with equal spans
    per = hits.groupBy("blob").agg(F.sort_array(F.collect_set("s")).alias("found"))
    per = per.select("blob", F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",").alias("spans"),
                     *[F.size(F.filter("found", _named(r.name))).alias(f"n_{r.name}") for r in rules])
    rows = versions.select("path", text_blob().alias("blob")).join(per, "blob", "left")
    return rows.select("path", "blob", *[F.coalesce(f"n_{r.name}", F.lit(0)).cast("long").alias(f"n_{r.name}") for r in rules],
                       F.coalesce("spans", F.lit("")).alias("spans"))


def op8(spark, sf_dir: str) -> DataFrame:
    versions = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    ledger = shared_folder(spark, "blob-ledger")
    update_in_instalments(versions, ledger)
    return findings(versions, ledger).select(
        F.col("path").alias("doc_id"), "n_assign", "n_access", "n_hex",
        F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"), "spans")


def _op8_sql() -> str:
    parts = []
    for i, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(rf"""
  SELECT blob, {i} AS place, '{r.name}' AS name,
         string_split_regex(text, '{pattern}') AS piece,
         regexp_extract_all(text, '{pattern}', 0) AS match, regexp_extract_all(text, '{pattern}', {r.group}) AS part,
         {r.least} AS least FROM blobs""")
    return f"""
WITH blobs AS (SELECT DISTINCT coalesce(text, '') AS text, sha256(coalesce(text, '')) AS blob FROM documents),
matches AS ({' UNION ALL '.join(parts)}),
one AS (SELECT blob, place, name, least, unnest(match) AS m, unnest(part) AS p, unnest(piece[1:len(match)]) AS b,
               generate_subscripts(match, 1) AS i FROM matches WHERE len(match) > 0),
placed AS (SELECT *, sum(length(b) + length(m)) OVER (PARTITION BY blob, place ORDER BY i) AS e FROM one),
kept AS (SELECT blob, place, name, (e - length(m))::BIGINT AS s, e::BIGINT AS e FROM placed WHERE length(p) >= least),
per AS (SELECT blob, count(*) FILTER (name = 'assign') AS n_assign, count(*) FILTER (name = 'access') AS n_access,
               count(*) FILTER (name = 'hex') AS n_hex,
               string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans FROM kept GROUP BY blob)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN per ON sha256(coalesce(d.text, '')) = per.blob
"""


OP8_SQL = _op8_sql()
