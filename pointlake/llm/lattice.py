"""Embedding near-duplicates by lattice hashing on E8.

Vectors are normalised in double precision. Each of ``TABLES`` tables projects them
with its own random 8 x d matrix, scales by 1 / ``SCALE`` and decodes to the nearest point of
the lattice E8, the cell; cell and label make the home bucket. A vector
also probes the ``PROBES`` nearest neighbouring cells: those of the 240 minimal
vectors that its offset from the cell's centre points to most. Two vectors meet where one
probes or inhabits the home cell of the other; every meeting is verified by the cosine.

Equal vectors of a label are one node with a multiplicity, so copies are
counted, never paired. A large bucket is cut into a grid of chunks, every
query chunk meets every member chunk once, and tasks return counts per vector and a
spanning forest, not pairs. A pair that meets in several tables is counted at its first
meeting only: both vectors carry all their cells, so every task can tell.

Edge cases: a vector that is null, empty, zero or has null or non-finite parts, or whose
label is null, links with nothing (component_id is its own id, kept is true); vectors of different length do not link;
rows that repeat an id are vectors of their own; a null id sorts last; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, store
from .components import UnionFind, connected_components

COSINE = 0.93
TABLES = 6
PROBES = 3
SCALE = 1.4
SEED = 20_240_229
#: Vectors of one chunk of a large bucket.
CHUNK = 2_000


def e8_round(y: np.ndarray) -> np.ndarray:
    """Nearest E8 points times 2 (integers): the better of D8 and D8 + 1/2."""

    def d8(x: np.ndarray) -> np.ndarray:
        near = np.rint(x)
        off = x - near
        odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
        worst = np.abs(off[odd]).argmax(axis=1)
        near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
        return near

    whole, half = d8(y), d8(y - 0.5) + 0.5
    better = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.rint(2 * np.where(better[:, None], whole, half)).astype(np.int64)


@cache
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, times 2."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((-2, 2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            found.append(v)
    found += [v for v in itertools.product((-1, 1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(found, np.int64)


@cache
def projection(table: int, dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, table, dim]).standard_normal((dim, 8)) / SCALE


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """n x tables x (1 + probes) cell hashes; the first of each table is the home cell."""
    mult = np.random.default_rng(SEED).integers(1, 1 << 62, 8, dtype=np.int64) | 1
    out = np.empty((len(unit), tables, 1 + probes), np.int64)
    for t in range(tables):
        y = unit @ projection(t, unit.shape[1])
        home = e8_round(y)
        # nearer neighbours have the larger inner product with the offset (all have norm 2)
        pull = (2 * y - home) @ minimal_vectors().T
        best = np.argsort(-pull, axis=1, kind="stable")[:, :probes]
        near = home[:, None, :] + minimal_vectors()[best]
        every = np.concatenate([home[:, None, :], near], axis=1)
        out[:, t] = (every * mult).sum(axis=2) + t
    return out


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), dim)
    v = v / np.abs(v).max(axis=1)[:, None]
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label (text), node (16 bytes of label and vector), vec (float64 bytes); null node: links with nothing."""
    for batch in batches:
        nodes, vecs = [], []
        for v, label in zip(batch.column(2), batch.column(1).to_pylist(), strict=True):
            raw = node = None
            if label is not None and v.is_valid and len(v.values) and v.values.null_count == 0:
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                if np.isfinite(x).all() and x.any():
                    raw = x.tobytes()
                    node = xxhash.xxh3_128_digest(label.encode() + b"\0" + raw)
            nodes.append(node)
            vecs.append(raw)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(vecs, pa.binary())],
            names=["vec_id", "label", "node", "vec"])


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, label_hash, copies, vec, codes (all cells, int64 bytes)."""
    for batch in batches:
        raw = batch.column(3).to_pylist()
        codes: list[bytes] = [b""] * len(raw)
        for size in {len(r) for r in raw}:
            at = [i for i, r in enumerate(raw) if len(r) == size]
            # cells of vectors of another length never meet: their projections differ
            found = cells(_unit([raw[i] for i in at], size // 8)) ^ np.int64(size * 0x9E3779B97F5)
            for i, c in zip(at, found, strict=True):
                codes[i] = c.tobytes()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())],
                                         names=["node", "label_hash", "copies", "vec", "codes"])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, node, home) per cell that a node inhabits or probes."""
    for batch in batches:
        codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64).reshape(len(batch), -1)
        home = np.zeros(TABLES * (1 + PROBES), bool)
        home[::1 + PROBES] = True
        labels = batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array((codes ^ labels[:, None]).reshape(-1)), pa.array(np.repeat(np.array(batch.column(0).to_pylist(), object), codes.shape[1]), pa.binary()),
             pa.array(np.tile(home, len(batch)))], names=["bucket", "node", "home"])


@dataclass
class Side:
    """The queries or the members of one bucket chunk."""

    nodes: np.ndarray   # object array of 16-byte keys
    copies: np.ndarray
    unit: np.ndarray
    cells: np.ndarray   # n x TABLES x (1 + PROBES)

    @classmethod
    def of(cls, rows: dict, at: np.ndarray) -> Side:
        raw = [rows["vec"][k] for k in at]
        codes = b"".join(rows["codes"][k] for k in at)
        return cls(rows["node"][at], rows["copies"][at], _unit(raw, len(raw[0]) // 8),
                   np.frombuffer(codes, np.int64).reshape(-1, TABLES, 1 + PROBES))


def links_of(q: Side, m: Side, cell: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (query, member) of the pairs at or above the cosine whose first
    meeting is: this query probing or sharing this member's home ``cell``."""
    i, j = np.nonzero(q.unit @ m.unit.T >= cosine)
    other = q.nodes[i] != m.nodes[j]
    i, j = i[other], j[other]
    keep = np.ones(len(i), bool)
    for lo in range(0, len(i), 100_000):
        at = slice(lo, lo + 100_000)
        a, b = q.cells[i[at]], m.cells[j[at]]
        forward = (a == b[:, :, :1]).any(axis=2)   # the query probes or shares the member's home
        backward = (b == a[:, :, :1]).any(axis=2)
        here = (b[:, :, 0] == cell).argmax(axis=1)
        first = (forward | backward).argmax(axis=1)
        # a meeting that exists both ways counts from the lower node
        keep[at] = (first == here) & ((q.nodes[i[at]] < m.nodes[j[at]]) | ~backward[np.arange(len(a)), here])
    return i[keep], j[keep]


def _chunk_links(rows: dict, lo: int, hi: int, cosine: float) -> list[tuple[bytes, bytes, int]]:
    at = np.arange(lo, hi)
    role = rows["role"][lo:hi]
    if role.all() or not role.any():
        return []
    q, m = Side.of(rows, at[role == 0]), Side.of(rows, at[role == 1])
    i, j = links_of(q, m, int(rows["bucket"][lo] ^ rows["label_hash"][lo]), cosine)
    if not len(i):
        return []
    count: dict[bytes, int] = defaultdict(int)
    for side, mine, theirs in ((q, i, m.copies[j]), (m, j, q.copies[i])):
        for n, c in zip(side.nodes, np.bincount(mine, theirs, minlength=len(side.nodes)).astype(np.int64), strict=True):
            count[n] += int(c)
    uf = UnionFind()
    for x, y in zip(q.nodes[i], m.nodes[j], strict=True):
        uf.union(x, y)
    return [(n, uf.find(n), c) for n, c in count.items() if c]


def _verifier(cosine: float) -> Callable:
    """Streams rows sorted by (bucket, label, i, j); holds one bucket chunk and one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in itertools.chain(batches, [None]):
            table = pa.Table.from_batches([b for b in (rest, batch) if b is not None]) if rest is not None or batch is not None else None
            if table is None or not table.num_rows:
                continue
            rows = {c: table[c].to_numpy() for c in ("bucket", "label_hash", "i", "j", "role", "copies")}
            node = np.empty(table.num_rows, object)
            node[:] = table["node"].to_pylist()
            rows |= {"node": node, "vec": table["vec"].to_pylist(), "codes": table["codes"].to_pylist()}
            new = np.zeros(table.num_rows, bool)
            for c in ("bucket", "label_hash", "i", "j"):
                new[1:] |= rows[c][1:] != rows[c][:-1]
            starts = [0, *np.flatnonzero(new).tolist()]
            ends = [*starts[1:], table.num_rows]
            if batch is not None:  # the last chunk may go on in the next batch
                rest = table.slice(starts[-1]).combine_chunks().to_batches()[0]
                starts, ends = starts[:-1], ends[:-1]
            found = [r for lo, hi in zip(starts, ends, strict=True) for r in _chunk_links(rows, lo, hi, cosine)]
            n, r, c = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.binary()), pa.array(r, pa.binary()), pa.array(c, pa.int64())],
                                             names=["node", "root", "links"])

    return run


def lattice_links(nodes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(node, root, links): per bucket chunk, each node's links found there (copies
    counted) and a node of its group; ``nodes`` has node, label, copies, vec."""
    nodes = nodes.select("node", F.xxhash64("label").alias("label_hash"), "copies", "vec")
    coded = nodes.mapInArrow(_code, "node binary, label_hash long, copies long, vec binary, codes binary")
    coded = store(coded, "e8-nodes")
    meet = store(coded.select("node", "label_hash", "codes").mapInArrow(_meetings, "bucket long, node binary, home boolean"), "e8-cells")
    # buckets where a member meets another node; both counts fix the grid of a large bucket
    size = meet.groupBy("bucket").agg(F.count_if("home").alias("m"), F.count(F.lit(1)).alias("q")).filter("m > 0 and q > 1")
    size = size.select("bucket", F.ceil(F.col("m") / CHUNK).cast("int").alias("mc"), F.ceil(F.col("q") / CHUNK).cast("int").alias("qc"))
    places = meet.join(size, "bucket")
    spot = F.xxhash64("node", "bucket")
    own_q, own_m = F.pmod(spot, F.col("qc")).cast("int"), F.pmod(spot, F.col("mc")).cast("int")
    asks = places.select("bucket", "node", F.lit(0).alias("role"), own_q.alias("i"), F.explode(F.sequence(F.lit(0), F.col("mc") - 1)).alias("j"))
    lives = places.filter("home").select("bucket", "node", F.lit(1).alias("role"),
                                         F.explode(F.sequence(F.lit(0), F.col("qc") - 1)).alias("i"), own_m.alias("j"))
    rows = asks.unionAll(lives.select("bucket", "node", "role", "i", "j")).join(coded, "node")
    chunk = ["bucket", "label_hash", "i", "j"]
    rows = rows.select(*chunk, "role", "node", "copies", "vec", "codes").repartition(*chunk).sortWithinPartitions(*chunk)
    return rows.mapInArrow(_verifier(cosine), "node binary, root binary, links long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label)."""
    kind = dict(vectors.dtypes)["vec_id"]
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), "embedding")
    rows = store(rows.mapInArrow(_encode, f"vec_id {kind}, label string, node binary, vec binary"), "e8-rows")
    nodes = (rows.filter("node is not null").groupBy("node")
             .agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec")))
    nodes = store(nodes, "e8-distinct")
    found = store(lattice_links(nodes.select("node", "label", "copies", "vec"), cosine), "e8-links")
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = store(roots, "e8-components")
    per = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = (nodes.select("node", "low", "copies").join(per, "node", "left").join(roots, "node", "left")
             .select("node", "low", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("root", "node").alias("root")))
    nodes = store(nodes, "e8-groups")
    least = nodes.groupBy("root").agg(F.min("low").alias("component"))
    nodes = nodes.join(least, "root").select("node", "n_links", "component")
    out = rows.select("vec_id", "node").join(nodes, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))


def op5(spark, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))
