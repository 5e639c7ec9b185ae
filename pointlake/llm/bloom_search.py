"""Ranked lexical search over bit-sliced Bloom signatures, with exact results.

Index (``build_index``). A task cuts its documents into blocks of similar size. A block is a bit matrix: a column per
document, and rows that (term, level) pairs hash to; a document sets the rows of a term at every level of
``LEVELS`` that its number of occurrences reaches. The rows are the slices: the AND of a pair's rows has a
bit for every document that holds the term that often, and for a few more (a Bloom filter errs on
this side only). A block also keeps its documents' lengths and keys, and its terms with their document counts.

Search (``search``). Exact document counts of the query's terms come from the blocks' vocabularies. Per block and query the slices
are summed by weight: each term adds the most it can contribute in a document of that length at the level its
slices show. That sum is an upper bound of the document's score.
1. The ``SEEDS`` documents of the largest bound per query are scored exactly; the k-th best score is the
   query's threshold.
2. Every document whose bound reaches the threshold (and that could win the tie by its id) is rescored from
   its whole text; all others are provably not among the k best.

Scores are 64-bit integers, so bounds and scores compare exactly. Queries come in blocks of about
``QUERY_BYTES`` bytes: a block of queries, their term weights and thresholds travel to the tasks; documents never do. Candidates are
named by a hash of id and text; an accidental equal hash only rescores one document more.

Edge cases: a null or empty text has no terms and is never found; a query without terms, or whose
terms occur nowhere, has no rows; queries that repeat an id and a text are one query (different texts under
one id, or without an id, are queries of their own); repeated documents are ranked each, and a null doc_id
is larger than any id; texts of any length are indexed and scored whole (the rows of a block are
bounded, so an extreme text only has looser bounds); empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, LOWER, UPPER, read_table, store
from .superminhash import mix64

TOP = 10
#: Occurrences from which a document sets a term's rows of the next level.
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 256, 512, 1024, 4096, 16384, 65536], np.int64)
#: Rows of a block per pair of its largest document, and rows that a pair sets.
ROWS_PER_PAIR, HASHES = 12, 4
#: Documents of a block, cells (documents x rows) of its matrix, and most rows.
BLOCK_DOCS, BLOCK_CELLS, MOST_ROWS = 2_048, 1 << 24, 1 << 22
#: Documents, and their distinct terms, that a task sorts by size at once.
HELD_DOCS, HELD_TERMS = 8_192, 2_000_000
#: Documents whose bounds set the threshold, per result wanted.
SEEDS = 2
#: Bytes of query texts that are searched at once; of these, queries and terms that a task bounds at once.
QUERY_BYTES = 4 << 20
GROUP_QUERIES, TERMS_AT_ONCE = 256, 1_024

_TERM_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).translate(
    bytes.maketrans(UPPER.encode(), LOWER.encode()))
_GOLD = 0x9E3779B97F4A7C15


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of digits, letters A-Z (lower-cased) and characters beyond ASCII, from UTF-8."""
    return text.translate(_TERM_BYTES).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def lengths_to_m(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 10 + 90 * n * n_docs // max(1, n_terms)


def gain(tf: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | int:
    """What a weight is multiplied by; rises with tf, falls with m."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


# ---------------------------------------------------------------- index

@dataclass
class Index:
    blocks: DataFrame      # keys, ids, lengths, rows, bits, terms, counts: a row per block
    n_docs: int            # documents with a term
    n_terms: int           # all their terms, repeats included


def term_hashes(found: Collection[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def pair_rows(hashes: np.ndarray, level: int, rows: int) -> np.ndarray:
    """terms x HASHES: the rows that terms set at a level, in a matrix of ``rows`` rows."""
    a = mix64(hashes + np.uint64(level * _GOLD & 0xFFFFFFFFFFFFFFFF))
    b = mix64(a ^ np.uint64(_GOLD)) | np.uint64(1)
    return ((a[:, None] + np.arange(HASHES, dtype=np.uint64) * b[:, None]) % np.uint64(rows)).astype(np.int64)


class Numbers(dict):
    """Numbers terms in the order they come."""

    def __missing__(self, term: bytes) -> int:
        n = self[term] = len(self)
        return n


@dataclass
class Doc:
    key: int
    id: int | None
    length: int
    terms: np.ndarray    # numbers of its distinct terms
    top: np.ndarray      # highest level reached by each

    @property
    def pairs(self) -> int:
        return int(self.top.sum(dtype=np.int64)) + len(self.top)


def sized_blocks(docs: list[Doc]) -> Iterator[list[Doc]]:
    """Blocks of documents whose numbers of pairs differ by a factor of two at most."""
    docs = sorted(docs, key=lambda d: d.pairs)
    at = 0
    while at < len(docs):
        low, end = docs[at].pairs, at
        while end < len(docs) and end - at < BLOCK_DOCS and docs[end].pairs <= 2 * low + 32 and (
                end == at or (end - at + 1) * docs[end].pairs * ROWS_PER_PAIR <= BLOCK_CELLS):
            end += 1
        yield docs[at:end]
        at = end


def block_row(docs: list[Doc], names: pa.Array, hashes: np.ndarray) -> pa.RecordBatch:
    rows = min(MOST_ROWS, max(64, ROWS_PER_PAIR * docs[-1].pairs))
    cells = np.zeros((rows, -(-len(docs) // 8) * 8), np.uint8)
    for i, d in enumerate(docs):
        for level in range(int(d.top.max()) + 1):
            cells[pair_rows(hashes[d.terms[d.top >= level]], level, rows).reshape(-1), i] = 1
    held, counts = np.unique(np.concatenate([d.terms for d in docs]), return_counts=True)

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays(
        [one(pa.array([d.key for d in docs], pa.int64())), one(pa.array([d.id for d in docs], pa.int64())),
         one(pa.array([d.length for d in docs], pa.int64())), pa.array([rows], pa.int64()), pa.array([np.packbits(cells, axis=1).tobytes()], pa.binary()),
         one(names.take(pa.array(held))), one(pa.array(counts.astype(np.int64)))], names=["keys", "ids", "lengths", "rows", "bits", "terms", "counts"])


BLOCK = "keys array<bigint>, ids array<bigint>, lengths array<bigint>, rows bigint, bits binary, terms array<binary>, counts array<bigint>"


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers, held, size = Numbers(), [], 0

    def blocks() -> Iterator[pa.RecordBatch]:
        names, hashes = pa.array(list(numbers), pa.binary()), term_hashes(numbers)
        for part in sized_blocks(held):
            yield block_row(part, names, hashes)

    for batch in batches:
        for lo in range(0, len(batch), 500):
            part = batch.slice(lo, 500)
            for key, id_, text in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                found = terms(text)
                if not found:
                    continue
                tf = Counter(found)
                counts = np.fromiter(tf.values(), np.int64, len(tf))
                held.append(Doc(key, id_, len(found), np.fromiter(map(numbers.__getitem__, tf), np.int32, len(tf)),
                                (np.searchsorted(LEVELS, counts, "right") - 1).astype(np.int8)))
                size += len(tf)
                if len(held) >= HELD_DOCS or size >= HELD_TERMS:
                    yield from blocks()
                    numbers, held, size = Numbers(), [], 0
    yield from blocks()


def document_key() -> Column:
    return F.xxhash64("doc_id", "text")


def build_index(docs: DataFrame) -> Index:
    """Index of all rows of ``docs`` (doc_id, text), written into the shared folder."""
    rows = docs.select(document_key().alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    blocks = store(rows.mapInArrow(_indexed, BLOCK), "bloom-index")
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    n_docs, n_terms = blocks.agg(F.coalesce(F.sum(F.size("lengths")), F.lit(0)), F.coalesce(F.sum(total), F.lit(0))).first()
    return Index(blocks, int(n_docs), int(n_terms))


# ---------------------------------------------------------------- queries

@dataclass
class Queries:
    """A block of queries: their distinct terms, the terms' weights, and the places of each query's terms."""

    ids: list
    uses: list[np.ndarray]
    terms: list[bytes]
    weights: np.ndarray


def queries_of(items: list, index: Index) -> Queries:
    """The block with its terms' weights by their exact document counts."""
    place: dict[bytes, int] = {}
    uses = []
    for r in items:
        found = dict.fromkeys(terms(r.text.encode() if r.text else None))
        uses.append(np.array([place.setdefault(t, len(place)) for t in found], np.int64))
    wanted = pa.array(list(place), pa.binary())

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            at = pc.index_in(batch.column(0).flatten(), wanted)
            here = at.is_valid().to_numpy(zero_copy_only=False)
            np.add.at(total, at.drop_null().to_numpy(), batch.column(1).flatten().to_numpy()[here])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    counts = index.blocks.select("terms", "counts").mapInArrow(held, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    weights = np.zeros(len(place), np.int64)
    for r in counts.collect():  # at most a row per term of the block of queries
        weights[r.term] = weight(index.n_docs, r.df)
    return Queries([r.item_id for r in items], uses, list(place), weights)


def query_blocks(items: DataFrame) -> Iterator[list]:
    """Distinct queries (item_id, text), in blocks of about QUERY_BYTES bytes of text."""
    items = items.select("item_id", "text").distinct()
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    n = max(1, -(-(items.agg(F.sum(size)).first()[0] or 0) // QUERY_BYTES))
    for b in range(n):
        if rows := items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect():
            yield rows


# ---------------------------------------------------------------- bounds

@dataclass
class Plan:
    """The block of queries as tasks use it: groups of queries with the hashes of the terms that count."""

    groups: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]  # queries, term hashes, weights, places per query

    @classmethod
    def of(cls, q: Queries) -> Plan:
        every = term_hashes(q.terms)
        counted = [np.sort(u[q.weights[u] > 0]) for u in q.uses]
        asked = [i for i, u in enumerate(counted) if len(u)]
        groups = []
        for lo in range(0, len(asked), GROUP_QUERIES):
            some = asked[lo:lo + GROUP_QUERIES]
            names = np.unique(np.concatenate([counted[i] for i in some]))
            groups.append((np.array(some), every[names], q.weights[names], [np.searchsorted(names, counted[i]) for i in some]))
        return cls(groups)


def added(bits: np.ndarray, hashes: np.ndarray, weights: np.ndarray, lengths: np.ndarray, m: np.ndarray) -> np.ndarray:
    """terms x documents: the most each term adds to a score, by the highest level that its slices show."""
    rows, docs = len(bits), len(lengths)
    out = np.zeros((len(hashes), docs), np.int64)
    slices = np.bitwise_and.reduce(bits[pair_rows(hashes, 0, rows)], axis=1)
    live = np.arange(len(hashes))
    for level in range(len(LEVELS)):
        on = slices.any(axis=1)
        live, slices = live[on], slices[on]
        if not len(live):
            break
        seen = np.unpackbits(slices, axis=1, count=docs).astype(bool)
        most = np.minimum(LEVELS[level + 1] - 1, lengths) if level + 1 < len(LEVELS) else lengths
        out[live] = np.where(seen, weights[live][:, None] * gain(most, m)[None, :], out[live])
        if level + 1 < len(LEVELS):
            slices = slices & np.bitwise_and.reduce(bits[pair_rows(hashes[live], level + 1, rows)], axis=1)
    return out


def block_bounds(block: dict, plan: Plan, n_docs: int, n_terms: int) -> Iterator[tuple[int, np.ndarray]]:
    """(query, upper bound of each document's score)."""
    bits = np.frombuffer(block["bits"], np.uint8).reshape(block["rows"], -1)
    lengths = block["lengths"].to_numpy()
    m = lengths_to_m(lengths, n_docs, n_terms)
    for queries, hashes, weights, places in plan.groups:
        bounds = np.zeros((len(queries), len(lengths)), np.int64)
        for lo in range(0, len(hashes), TERMS_AT_ONCE):
            adds = added(bits, hashes[lo:lo + TERMS_AT_ONCE], weights[lo:lo + TERMS_AT_ONCE], lengths, m)
            for i, place in enumerate(places):
                a, b = np.searchsorted(place, [lo, lo + TERMS_AT_ONCE])
                if a < b:
                    bounds[i] += adds[place[a:b] - lo].sum(axis=0)
        yield from zip(queries.tolist(), bounds, strict=True)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            row = {c: batch.column(j)[i] for j, c in enumerate(batch.schema.names)}
            yield {c: v.as_py() if c in ("rows", "bits") else v.values for c, v in row.items()}


#: Stands for the lack of an id, which is larger than any id.
NO_ID = np.iinfo(np.int64).max


def _ids(block: dict) -> np.ndarray:
    return block["ids"].fill_null(NO_ID).to_numpy()


def _seeded(plan: Plan, n_docs: int, n_terms: int, seeds: int) -> Callable:
    """(query, key, bound, id): per task the documents of the largest bound for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        for block in _blocks(batches):
            keys, ids = block["keys"].to_numpy(), _ids(block)
            for i, bound in block_bounds(block, plan, n_docs, n_terms):
                top = np.argpartition(-bound, seeds)[:seeds] if len(bound) > seeds else np.arange(len(bound))
                top = np.flatnonzero(bound >= max(1, bound[top].min()))  # all that tie with the last
                for j in top[np.lexsort((ids[top], -bound[top]))][:seeds].tolist():
                    heap = best.setdefault(i, [])
                    heapq.heappush(heap, (int(bound[j]), -int(ids[j]), int(keys[j])))
                    if len(heap) > seeds:
                        heapq.heappop(heap)
        rows = [(i, key, bound, -id_) for i, found in best.items() for bound, id_, key in found]
        cols = list(zip(*rows, strict=True)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query", "key", "bound", "id"])

    return run


def _reaching(plan: Plan, n_docs: int, n_terms: int, least: np.ndarray, least_id: np.ndarray) -> Callable:
    """(key, query): documents that are not excluded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            keys, ids, out_keys, out_queries = block["keys"].to_numpy(), _ids(block), [], []
            for i, bound in block_bounds(block, plan, n_docs, n_terms):
                may = np.flatnonzero((bound > least[i]) | (bound == least[i]) & (bound > 0) & (ids <= least_id[i]))
                out_keys.append(keys[may])
                out_queries.append(np.full(len(may), i, np.int64))
            if out_keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_keys)), pa.array(np.concatenate(out_queries))], names=["key", "query"])

    return run


def _scored(q: Queries, n_docs: int, n_terms: int) -> Callable:
    """(query, doc_id, score) from whole texts, for the queries of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(lo, 500) for b in batches for lo in range(0, len(b), 500)):
            rows = []
            for doc_id, text, queries in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                tf = Counter(found := terms(text))
                m = 10 + 90 * len(found) * n_docs // n_terms
                for i in queries:
                    score = sum(int(q.weights[t]) * gain(n, m) for t in q.uses[i].tolist() if (n := tf.get(q.terms[t])))
                    if score > 0:
                        rows.append((i, doc_id, score))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query", "doc_id", "score"])

    return run


# ---------------------------------------------------------------- search

def ranked(scores: DataFrame, k: int) -> DataFrame:
    """(query, doc_id, score, rank): the k best; each task cuts to k rows a query before anything moves."""
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _rescored(docs: DataFrame, wanted: DataFrame, q: Queries, index: Index) -> DataFrame:
    """Exact scores of the documents in ``wanted`` (key, query)."""
    wanted = store(wanted.distinct().groupBy("key").agg(F.collect_list("query").alias("queries")), "bloom-wanted")
    size = wanted.agg(F.sum(F.size("queries") * 8 + 48)).first()[0] or 0
    rows = docs.select(document_key().alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = rows.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, "key").select("doc_id", "text", "queries")
    return rows.mapInArrow(_scored(q, index.n_docs, index.n_terms), "query bigint, doc_id bigint, score bigint")


@dataclass
class Found:
    """``best`` (query, doc_id, score, rank) and the number of documents that were scored exactly per query."""

    best: DataFrame
    candidates: DataFrame


def search_block(docs: DataFrame, q: Queries, index: Index, k: int) -> Found:
    slices, plan = index.blocks.select("keys", "ids", "lengths", "rows", "bits"), Plan.of(q)
    order = W.partitionBy("query").orderBy(F.desc("bound"), F.asc("id"))
    seeds = slices.mapInArrow(_seeded(plan, index.n_docs, index.n_terms, SEEDS * k), "query bigint, key bigint, bound bigint, id bigint")
    seeds = seeds.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= SEEDS * k).select("key", "query")
    least, least_id = np.zeros(len(q.ids), np.int64), np.full(len(q.ids), NO_ID)
    for r in ranked(_rescored(docs, seeds, q, index), k).filter(F.col("rank") == k).collect():  # at most a row per query of the block
        least[r["query"]], least_id[r["query"]] = r.score, NO_ID if r.doc_id is None else r.doc_id
    wanted = store(slices.mapInArrow(_reaching(plan, index.n_docs, index.n_terms, least, least_id), "key bigint, query bigint"), "bloom-candidates")
    best = store(ranked(_rescored(docs, wanted, q, index), k), "bloom-best")
    return Found(best, wanted.groupBy("query").agg(F.count(F.lit(1)).alias("n")))


def search(docs: DataFrame, items: DataFrame, k: int = TOP, index: Index | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best rows of ``docs`` (doc_id, text) for every query of ``items`` (item_id, text)."""
    index = index or build_index(docs)
    spark, kind = docs.sparkSession, T.StructType([T.StructField("query", T.LongType()), items.schema["item_id"]])
    out = None
    for rows in query_blocks(items) if index.n_docs else ():
        q = queries_of(rows, index)
        names = spark.createDataFrame(list(enumerate(q.ids)), kind)
        found = search_block(docs, q, index, k).best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], T.StructType([items.schema["item_id"], *T.StructType.fromDDL("rank int, doc_id bigint, score bigint").fields]))
    return out


def op11(spark, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
i AS (
  SELECT row_number() OVER () AS q, item_id,
         list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
total AS (SELECT count(*)::BIGINT AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
asked AS (SELECT q, item_id, unnest(ts) AS t FROM i),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY t, n),
m AS (SELECT r, doc_id, 100 - 90 + ((90 * len(ts) * n) // l) AS m FROM d, total WHERE len(ts) > 0),
scored AS (
  SELECT a.q, a.item_id, m.doc_id, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m)))::BIGINT AS score
  FROM asked a JOIN tf ON tf.t = a.t JOIN w ON w.t = a.t JOIN m ON m.r = tf.r GROUP BY a.q, a.item_id, m.r, m.doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
