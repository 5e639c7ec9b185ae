"""URL filter: longest fitting rule, else the verdict of the path-template tree.

Per host the paths form a tree of segments. The tree is generalised in three
steps, all on counts per (host, path shape), never on single urls:

1. digits and long hexadecimal ids inside a segment become wildcards;
2. below a node whose children are mostly seen once (at least ``MIN_CHILDREN``
   children, distinct / urls at least ``VARIABLE``) the literal segment is
   a wildcard ``*``;
3. sibling branches under the same prefix whose distribution over what follows is close to the
   pooled one of all siblings (total variation at most ``TOLERANCE`` plus what a sample of
   the branch's size may deviate) are merged into ``~``; of the others, those with the same
   most frequent continuation are compared with their own pool and merged into ``~?..?name``.

Steps 2 and 3 go down level by level until no shape has a segment left; the number of levels follows from the data.

Urls that a rule decides are the labelled ones. A template is rejected when its
smoothed share of blocked urls among its labelled ones reaches ``PURITY`` and it has at least
``LEAST_LABELS`` of them; ``ALPHA`` pseudo-urls are drawn from the prior (the block share of all
labelled urls, at most one half). Branches are merged only with branches whose labels say
the same (all blocked, all allowed, none at all), and a branch whose own labels disagree stays alone, so
labels of one branch never condemn a sibling without any. What lies deeper than ``DEPTH`` segments
shares its rest as ``**`` only where all its shapes have the same labels, so that no verdict hangs on
telling them apart; elsewhere the tree goes on.

Edge cases: a null url, or one without ``://``, has empty host and path, fits no
rule and is allowed unless its template is rejected; repeated rows get
equal verdicts; no labelled url at all: everything without a rule is allowed; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, read_table, store

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEPTH = 3
MIN_CHILDREN = 8
VARIABLE = 0.5
TOLERANCE = 0.25
PURITY = 0.9
#: Bound of the prior, so that unlabelled urls alone never reject a template.
PRIOR = 0.5
ALPHA = 1.0
#: Labelled urls below which a template is never rejected.
LEAST_LABELS = 10


def with_parts(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) of every row."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rows = pages.select("page_id", rest.alias("rest"))
    host = F.regexp_extract("rest", r"^([^/?#]*)", 1)
    path = F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1)
    return rows.select("page_id", ascii_lower(host).alias("host"), path.alias("path"))


def fitting_rule(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        host, slash, path = text.partition("/")
        fits = (((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(slash + path))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def path_shape(path: Column) -> Column:
    """Step 1: digits become #, long hexadecimal ids @."""
    shape = F.regexp_replace(path, r"[0-9a-f]{16,}", "@")
    return F.regexp_replace(shape, r"[0-9]+", "#")


def said_by(n_block: Column, n_allow: Column) -> Column:
    """What the labels of a branch say: block, allow, both or none."""
    return F.when((n_block > 0) & (n_allow > 0), "both").when(n_block > 0, "block").when(n_allow > 0, "allow").otherwise("none")


def marked(wildcard: str) -> Column:
    """A wildcard for branches of equal labels (column said); no path has a "?"."""
    return F.when(F.col("said") == "none", wildcard).otherwise(F.concat(F.lit(f"{wildcard}?"), F.col("said")))


def generalise(shapes: DataFrame) -> DataFrame:
    """Step 2 at one level: variable literal segments below a (host, prefix) become ``*``.

    ``shapes`` has (host, shape, n, prefix, rest): prefix is the generalised
    part, rest what is still literal, starting with "/" or empty."""
    seg = F.regexp_extract("rest", r"^(/[^/]*)", 1)
    rows = shapes.withColumn("seg", seg).withColumn("tail", F.substring(F.col("rest"), F.length(seg) + 1, F.length("rest")))
    children = rows.filter("seg != ''").groupBy("host", "prefix", "seg").agg(
        F.sum("n").alias("n"), said_by(F.sum("n_block"), F.sum("n_allow")).alias("said"))
    nodes = children.groupBy("host", "prefix").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total"))
    variable = nodes.filter((F.col("kinds") >= MIN_CHILDREN) & (F.col("kinds") >= VARIABLE * F.col("total"))).select("host", "prefix")
    literal = ~F.col("seg").rlike(r"[#@]|^/$")
    wild = children.filter(literal & (F.col("said") != "both")).join(variable, ["host", "prefix"]).select(
        "host", "prefix", "seg", marked("/*").alias("wild"))
    rows = rows.join(wild, ["host", "prefix", "seg"], "left")
    label = F.coalesce("wild", "seg")
    return rows.select("host", "shape", "n", "n_block", "n_allow", F.concat("prefix", label).alias("prefix"),
                       F.col("tail").alias("rest"))


def share_tails(shapes: DataFrame) -> DataFrame:
    """Below (host, prefix) nodes whose shapes all have the same labels the rest becomes ``**``."""
    said = said_by(F.col("n_block"), F.col("n_allow"))
    nodes = shapes.filter("rest <> ''").groupBy("host", "prefix").agg(F.min(said).alias("low"), F.max(said).alias("high"))
    alike = nodes.filter("low = high and low <> 'both'").select("host", "prefix", F.lit(True).alias("alike"))
    shared = F.col("alike").isNotNull() & (F.col("rest") != "")
    rows = shapes.join(alike, ["host", "prefix"], "left")
    return rows.select("host", "shape", "n", "n_block", "n_allow", F.when(shared, F.concat("prefix", F.lit("/**"))).otherwise(
        F.col("prefix")).alias("prefix"), F.when(shared, F.lit("")).otherwise(F.col("rest")).alias("rest"))


def close_to_pool(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, seg, said) of the branches whose distribution over tails is close to that of all branches
    with equal ``keys``. ``cells`` has (*keys, seg, said, tail, n)."""
    names = list(dict.fromkeys([*keys, "seg", "said"]))
    branch = cells.groupBy(*keys, "seg").agg(F.sum("n").alias("seg_n"))
    pool = cells.groupBy(*keys, "tail").agg(F.sum("n").alias("tail_n"))
    nodes = pool.groupBy(*keys).agg(F.sum("tail_n").alias("node_n"), F.count(F.lit(1)).alias("kinds"))
    # sum over tails of |p - q| = 2 - 2 * sum of min(p, q), and min is 0 where the branch lacks the tail
    same = (cells.join(branch, [*keys, "seg"]).join(pool, [*keys, "tail"]).join(nodes, keys)
            .withColumn("least", F.least(F.col("n") / F.col("seg_n"), F.col("tail_n") / F.col("node_n")))
            .groupBy(*names).agg(F.sum("least").alias("overlap"), F.first("seg_n").alias("seg_n"),
                                 F.first("kinds").alias("kinds")))
    close = same.filter((F.lit(1.0) - F.col("overlap")) <= F.lit(TOLERANCE) + F.lit(0.5) * F.sqrt(F.col("kinds") / F.col("seg_n")))
    return close.filter((F.col("said") != "both") & ~F.col("seg").rlike(r"[#@*]|^/$")).select(*names)


def several(close: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``close`` that are not alone with their ``keys``, and the least branch of each (least)."""
    groups = close.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"), F.min("seg").alias("least")).filter("k > 1").drop("k")
    return close.join(groups, keys)


def merge_branches(shapes: DataFrame) -> DataFrame:
    """Step 3 at one level: literal branches below a (host, prefix) close to the pool of their siblings, or of
    those siblings that mostly go on like them, get one label, if there are several. ``shapes`` as in ``generalise``."""
    seg = F.regexp_extract("rest", r"^(/[^/]*)", 1)
    rows = shapes.withColumn("seg", seg).withColumn("tail", F.substring(F.col("rest"), F.length(seg) + 1, F.length("rest")))
    said = rows.groupBy("host", "prefix", "seg").agg(said_by(F.sum("n_block"), F.sum("n_allow")).alias("said"))
    cells = rows.groupBy("host", "prefix", "seg", "tail").agg(F.sum("n").alias("n")).join(said, ["host", "prefix", "seg"])
    cells = store(cells, "url-cells")
    node = ["host", "prefix"]
    first = several(close_to_pool(cells, node).filter("seg <> ''"), [*node, "said"])
    first = store(first.select(*node, "seg", marked("/~").alias("merged")), "url-close")
    rest = cells.filter((F.col("seg") != "") & (F.col("said") != "both") & ~F.col("seg").rlike(r"[#@*]|^/$"))
    rest = rest.join(first, [*node, "seg"], "left_anti")
    mode = rest.groupBy(*node, "seg").agg(F.max(F.struct("n", "tail"))["tail"].alias("mode"))
    own = [*node, "said", "mode"]
    second = several(close_to_pool(rest.join(mode, [*node, "seg"]), own), own)
    second = second.select(*node, "seg", F.concat(F.lit("/~?"), "said", F.lit("?"), F.substring("least", 2, 1 << 30)).alias("merged"))
    rows = rows.join(first.unionAll(second), [*node, "seg"], "left")
    return rows.select("host", "shape", "n", "n_block", "n_allow", F.concat("prefix", F.coalesce("merged", "seg")).alias("prefix"),
                       F.col("tail").alias("rest"))


def level_by_level(shapes: DataFrame, step: Callable[[DataFrame, int], DataFrame], name: str) -> DataFrame:
    """``step`` on the shapes that have a rest, until none has; each step takes at least a segment off it."""
    done: list[DataFrame] = []
    while True:
        held = store(step(shapes, len(done)), name)
        done.append(held.filter("rest = ''"))
        shapes = held.filter("rest <> ''")
        if not shapes.head(1):
            return reduce(DataFrame.unionAll, done)


def path_templates(urls: DataFrame) -> DataFrame:
    """(host, shape, template, purity, verdict) per path shape; ``urls`` has host,
    path and said (block, allow or null: not labelled)."""
    counts = (urls.select("host", path_shape(F.col("path")).alias("shape"), "said").groupBy("host", "shape")
              .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("said") == "block").alias("n_block"),
                   F.count_if(F.col("said") == "allow").alias("n_allow")))
    shapes = store(counts, "url-shapes").withColumn("prefix", F.lit("")).withColumn("rest", F.col("shape"))
    shapes = level_by_level(shapes, lambda s, level: share_tails(generalise(s)) if level >= DEPTH - 1 else generalise(s), "url-general")
    shapes = shapes.withColumn("rest", F.col("prefix")).withColumn("prefix", F.lit(""))
    labelled = level_by_level(store(shapes, "url-general"), lambda s, level: merge_branches(s), "url-merged")
    labelled = labelled.select("host", "shape", "n", "n_block", "n_allow", F.col("prefix").alias("template"))
    labelled = store(labelled, "url-templates")
    prior = labelled.agg(F.sum("n_block").alias("b"), F.sum("n_allow").alias("a")).select(
        F.least(F.lit(PRIOR), F.coalesce(F.try_divide("b", F.col("a") + F.col("b")), F.lit(0.0))).alias("prior")).first()[0]
    per = labelled.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "n_block", "n_allow")])
    labels = F.col("n_block") + F.col("n_allow")
    purity = (F.col("n_block") + F.lit(ALPHA * float(prior))) / (labels + F.lit(ALPHA))
    per = per.select("host", "template", labels.alias("labels"), purity.alias("purity")).withColumn(
        "judged", F.when((F.col("purity") >= PURITY) & (F.col("labels") >= LEAST_LABELS), F.lit("block")).otherwise(F.lit("allow"))).drop("labels")
    return labelled.select("host", "shape", "template").join(per, ["host", "template"])


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row."""
    rule, said = fitting_rule(rules)
    urls = with_parts(pages).withColumn("rule", rule).withColumn("said", said)
    templates = store(path_templates(urls), "url-judged")
    rows = urls.withColumn("shape", path_shape(F.col("path")))
    rows = rows.join(templates, ["host", "shape"], "left")
    return rows.select("page_id", "host", "path", "rule",
                       F.coalesce("said", "judged", F.lit("allow")).alias("verdict"), "template", "purity")


def op9(spark, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _op9_sql() -> str:
    levels, last = [], "shapes0"
    for d in range(DEPTH):
        levels.append(rf"""
cut{d} AS (SELECT *, regexp_extract(rest, '^(/[^/]*)', 1) AS seg FROM {last}),
variable{d} AS (
  SELECT host, prefix FROM (SELECT host, prefix, seg, sum(n) AS n FROM cut{d} WHERE seg <> '' GROUP BY ALL)
  GROUP BY host, prefix HAVING count(*) >= {MIN_CHILDREN} AND count(*) >= {VARIABLE} * sum(n)),
shapes{d + 1} AS (
  SELECT host, shape, n, n_block, n_allow, substr(rest, length(seg) + 1) AS rest,
         prefix || CASE WHEN seg <> '' AND NOT regexp_matches(seg, '[#@]|^/$|^/\*\*$')
                          AND (host, prefix) IN (SELECT (host, prefix) FROM variable{d}) THEN '/*' ELSE seg END AS prefix
  FROM cut{d}),""")
        last = f"shapes{d + 1}"
    rules = sorted(RULES, key=lambda r: -len(r[1]))
    cases = []
    for _, text in rules:
        host, slash, path = text.partition("/")
        cases.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + path}') THEN '{text}'")
    said = " ".join(f"WHEN '{text}' THEN '{verdict}'" for verdict, text in rules)
    return rf"""
WITH rests AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
ruled AS (SELECT *, CASE {' '.join(cases)} END AS rule FROM parts),
urls AS (
  SELECT *, CASE rule {said} END AS said,
         regexp_replace(regexp_replace(regexp_replace(path, '[0-9a-f]{{16,}}', '@', 'g'), '[0-9]+', '#', 'g'),
                        '^((?:/[^/]*){{{DEPTH}}})/[\s\S]*$', '\1/**') AS shape FROM ruled),
shapes0 AS (
  SELECT host, shape, count(*) AS n, count(*) FILTER (said = 'block') AS n_block, count(*) FILTER (said = 'allow') AS n_allow,
         '' AS prefix, shape AS rest FROM urls GROUP BY host, shape),{''.join(levels)}
general AS (SELECT host, shape, n, n_block, n_allow, prefix || rest AS whole,
                   regexp_extract(prefix || rest, '^(/[^/]*)', 1) AS seg FROM {last}),
cells AS (SELECT host, seg, substr(whole, length(seg) + 1) AS tail, sum(n) AS n FROM general GROUP BY ALL),
shares AS (
  SELECT host, seg, tail, n, sum(n) OVER (PARTITION BY host, seg) AS seg_n, sum(n) OVER (PARTITION BY host, tail) AS tail_n,
         sum(n) OVER (PARTITION BY host) AS host_n FROM cells),
kinds AS (SELECT host, count(DISTINCT tail) AS kinds FROM cells GROUP BY host),
near AS (
  SELECT host, seg FROM shares JOIN kinds USING (host) WHERE seg <> '' AND NOT regexp_matches(seg, '[#@*]|^/$')
  GROUP BY host, seg
  HAVING 1.0 - sum(least(n::DOUBLE / seg_n, tail_n::DOUBLE / host_n))
         <= {TOLERANCE} + 0.5 * sqrt(any_value(kinds)::DOUBLE / any_value(seg_n))),
close AS (SELECT host, seg FROM (SELECT *, count(*) OVER (PARTITION BY host) AS k FROM near) WHERE k > 1),
labelled AS (
  SELECT host, shape, n, n_block, n_allow,
         CASE WHEN (host, seg) IN (SELECT (host, seg) FROM close)
              THEN '/~' ELSE seg END || substr(whole, length(seg) + 1) AS template FROM general),
prior AS (SELECT least({PRIOR}, coalesce(sum(n_block)::DOUBLE / nullif(sum(n_block) + sum(n_allow), 0), 0)) AS prior FROM labelled),
judged AS (
  SELECT host, template,
         (sum(n_block) + ({ALPHA} + sum(n) - sum(n_block) - sum(n_allow)) * any_value(prior))::DOUBLE
           / (sum(n) + {ALPHA}) >= {PURITY} AS reject
  FROM labelled, prior GROUP BY host, template)
SELECT page_id, u.host, path, rule, coalesce(said, CASE WHEN reject THEN 'block' ELSE 'allow' END) AS verdict
FROM urls u JOIN labelled l ON u.host = l.host AND u.shape = l.shape
JOIN judged j ON l.host = j.host AND l.template = j.template
"""


OP9_SQL = _op9_sql()
