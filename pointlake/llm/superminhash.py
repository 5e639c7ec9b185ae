"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

Signature. Every shingle draws, for j = 0, 1, ..., a number in [j, j+1) and the
j-th place of its own random permutation of the slots (Fisher-Yates); a slot keeps
the least number it is given. The permutation correlates the slots, which lowers
the variance against independent MinHash, and all draws of step j exceed those of
step j - 1, so a document stops as soon as every slot holds less than j. Steps run
for all shingles of a block of documents at once.

Search. Documents with equal shingle sets are one node (the fingerprint of the set)
from the start, so copies cost nothing later. Nodes that agree in all rows of
a band share a bucket. A bucket is not expanded into pairs: its most central node
(the one that shares most bucket places overall) is verified against every other, and
what links is one component. Where a bucket still spans several components, the
members not compared yet get another center, round by round, as long as a round at
least halves the pairs left. Then buckets with few pairs left (at most ``PAIRS_LEFT`` per
member) have those verified, and larger ones are compared in tasks, chunk by chunk, where
only members outside the largest component are compared with the rest and no pair becomes a row. So
every pair of a bucket ends up verified or already connected.

Verification compares whole shingle sets (64-bit hashes), rebuilt from the
texts of candidate documents only. Components: ``components``.

Misses. A pair at similarity 0.8 shares no bucket with probability
(1 - 0.8**ROWS)**BANDS = 7e-6; a link is lost only if no other path joins the two.

Edge cases: a null or blank text has an empty set, is linked with nothing and kept;
fewer words than a shingle: the whole sequence is the one shingle; repeated rows are copies of each other; a
null id counts as larger than any id (its row is kept only where no row with
an id is in its component); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, broadcast_if_small, read_table, released, scratch, store
from .components import UnionFind, connected_components

BANDS, ROWS = 30, 5
#: Shingles of documents that are signed together (a longer document is alone).
BLOCK = 200_000
#: Pairs left per member up to which a bucket's pairs are verified as rows.
PAIRS_LEFT = 4
#: Hashes of one chunk of a large bucket.
CHUNK = 2_000_000

_U = np.uint64
_GOLD, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of the SplitMix64 generator."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


class WordHashes(Recent):
    """64-bit hash of a word."""

    def of(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)


def shingle_set(text: bytes | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles.

    ``bytes.lower`` and ``bytes.split`` touch exactly A-Z and the six ASCII blanks."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(k, len(words))
    acc = np.full(len(h) - k + 1, _U(k))
    for i in range(k):
        acc = mix64((acc ^ h[i:len(h) - k + 1 + i]) + _GOLD)
    return np.unique(acc)


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """len(sets) x m signatures: step in the upper bits, 40 random bits below."""
    sig = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    perm: np.ndarray | None = None
    for j in range(m):
        if not len(x):
            break
        r = mix64(x + _U((j + 1) * int(_GOLD) & 0xFFFFFFFFFFFFFFFF))
        k = j + ((r & _U(0xFFFFFF)) * _U(m - j) >> _U(24)).astype(np.int64)
        if j == 0:
            slot, first = k, k
        else:
            if perm is None:
                perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(x), 1))
                each = np.arange(len(x))
                perm[each, first], perm[:, 0] = 0, first
            each = np.arange(len(x))
            slot = perm[each, k].astype(np.int64)
            perm[each, k] = perm[:, j]
            perm[:, j] = slot
        np.minimum.at(sig.reshape(-1), doc * m + slot, (_U(j) << _U(40)) | (r >> _U(24)))
        going = (sig.max(axis=1) >= (_U(j + 1) << _U(40)))[doc]
        if not going.all():
            x, doc = x[going], doc[going]
            first = first[going]
            perm = perm[going] if perm is not None else None
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket key per band."""
    cut = sig[:, :bands * rows].reshape(len(sig), bands, rows)
    key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD), cut.shape[:2]).copy()
    for i in range(rows):
        key = mix64((key ^ cut[:, :, i]) + _GOLD)
    return key.view(np.int64)


def fingerprint(s: np.ndarray) -> bytes:
    """128 bits that only equal sets share."""
    return xxhash.xxh3_128_digest(s.tobytes())


def _blocks(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, s in enumerate(sets):
        if size and size + len(s) > BLOCK:
            yield start, i
            start, size = i, 0
        size += len(s)
    if start < len(sets):
        yield start, len(sets)


def _signer(k: int, bands: int, rows: int) -> Callable:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for lo in range(0, len(batch), 1000):
                part = batch.slice(lo, 1000)
                sets = [shingle_set(t, k, hashes) for t in part.column(1).to_pylist()]
                keys = np.concatenate([band_keys(super_minhash(sets[a:b], bands * rows), bands, rows) for a, b in _blocks(sets)])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, len(sets) * bands + 1, bands, dtype=np.int32), pa.array(keys.reshape(-1))),
                    part.column(2)],
                    names=["doc_id", "n_shingles", "fp", "bands", "code"])

    return lambda batches: released(sign(batches))


def _setter(k: int) -> Callable:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for lo in range(0, len(batch), 500):
                part = batch.slice(lo, 500)
                fps, kept = [], []
                for text, wanted in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    s = shingle_set(text, k, hashes)
                    if len(s) and fingerprint(s) == wanted:
                        fps.append(wanted)
                        kept.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(fps, pa.binary()),
                    pa.ListArray.from_arrays(np.cumsum([0, *map(len, kept)]).astype(np.int32),
                                             pa.array(np.concatenate(kept) if kept else np.empty(0, np.int64)))],
                    names=["fp", "hashes"])

    return build


def _coded(docs: DataFrame) -> DataFrame:
    """(doc_id, text, code): ``code`` tells apart the texts of rows that share an id or have none."""
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("code"))


def signatures(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, fp, bands, code) per row of ``docs``; fp is null for an empty set."""
    kind = dict(docs.dtypes)["doc_id"]
    return _coded(docs).mapInArrow(_signer(k, bands, rows), f"doc_id {kind}, n_shingles long, fp binary, bands array<long>, code long")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Rows of ``pairs`` (a, b) whose sets have den * |intersection| >= num * |union|.
    Only the sets of these pairs move."""
    pairs = store(pairs, "smh-pairs")
    wanted = store(pairs.select(F.col("a").alias("fp")).unionAll(pairs.select("b")).distinct(), "smh-wanted")
    sets = sets.join(broadcast_if_small(wanted, 48), "fp", "left_semi")
    left = sets.select(F.col("fp").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("fp").alias("b"), F.col("hashes").alias("hb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ha", "hb")).cast("long")
    both = both.select("a", "b", shared.alias("s"), (F.size("ha") + F.size("hb")).cast("long").alias("n"))
    return both.filter(F.col("s") * den >= (F.col("n") - F.col("s")) * num).select("a", "b")


def candidate_sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(fp, hashes) of the nodes (fp, doc_id, code; stored): the text of one representing document per node."""
    rows, n = _coded(docs).alias("t"), broadcast_if_small(nodes, 128).alias("n")
    same = (F.col("t.code") == F.col("n.code")) & F.col("t.doc_id").eqNullSafe(F.col("n.doc_id"))
    return rows.join(n, same).select("text", "fp").mapInArrow(_setter(k), "fp binary, hashes array<long>")


@dataclass
class Chunk:
    """The members of a bucket chunk: their sets as one sorted list of (hash, owner)."""

    fps: list[bytes]
    roots: list[bytes]
    side: np.ndarray     # chunk number of each member
    sizes: np.ndarray
    sets: list[np.ndarray]

    def links(self, cross: bool, num: int, den: int) -> list[tuple[bytes, bytes]]:
        """Links that connect members of different roots: of each pair within the chunk, or with
        ``cross`` of each pair on different sides. Members outside the component of the
        commonest root are compared with all others, the most central first."""
        flat = np.concatenate(self.sets)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], np.repeat(np.arange(len(self.sets)), self.sizes)[order]
        uf, out = UnionFind(), []
        common = np.zeros(len(self.sets), np.int64)   # how often a member's hashes occur in the chunk
        starts = np.searchsorted(flat, flat, "left")
        np.add.at(common, owner, np.searchsorted(flat, flat, "right") - starts)
        central = np.argsort(-(common / self.sizes), kind="stable").tolist()
        # members of the anchor's component are not compared among each other; all others are compared with everyone
        anchor, n = Counter(self.roots[i] for i in central).most_common(1)[0]
        for turn, i in enumerate(central):
            if uf.find(self.roots[i]) == uf.find(anchor) and (turn or n > 1):
                continue
            own = self.sets[i]
            lo, hi = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
            n = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            shared = np.bincount(owner[at], minlength=len(self.sets))
            alike = den * shared >= num * (self.sizes + self.sizes[i] - shared)
            if cross:
                alike &= self.side != self.side[i]
            for j in np.flatnonzero(alike).tolist():
                if uf.find(self.roots[j]) != uf.find(self.roots[i]):
                    uf.union(self.roots[j], self.roots[i])
                    out.append((min(self.fps[i], self.fps[j]), max(self.fps[i], self.fps[j])))
        return out


def _chunk_links(num: int, den: int) -> Callable:
    """Streams rows sorted by (band, i, j); holds the members of one chunk pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in range(6)], b.column(6), strict=True))
        for (_, i, j), group in itertools.groupby(rows, key=lambda r: r[:3]):
            chunk = list(group)
            sets = [r[6].values.to_numpy().view(np.uint64) for r in chunk]
            sets = [np.sort(x) for x in sets]
            found = Chunk([r[4] for r in chunk], [r[5] for r in chunk], np.array([r[3] for r in chunk]), np.array([len(x) for x in sets]),
                          sets).links(i != j, num, den)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def bucket_links(left: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): links that connect what is not connected yet in the buckets of ``left`` (band,
    fp, size, root). Buckets are cut into chunks of about CHUNK hashes; each pair of
    chunks is compared in one place, and no pair of members becomes a row."""
    chunks = left.groupBy("band").agg(F.ceil(F.sum("size") / CHUNK).cast("int").alias("chunks"))
    rows = left.join(chunks, "band").withColumn("c", F.pmod(F.xxhash64("fp", "band"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("band", F.least("c", "other").alias("i"), F.greatest("c", "other").alias("j"), "c", "fp", "root")
    rows = rows.join(sets, "fp").select("band", "i", "j", "c", "fp", "root", "hashes")
    rows = rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return rows.mapInArrow(_chunk_links(num, den), "a binary, b binary")


def hubs(found: DataFrame, score: DataFrame) -> DataFrame:
    """(fp, root): where a node gets by two steps along links, each to the most central node.
    Nodes of equal root are connected; it need not tell all that are."""
    def step(a: str, b: str) -> DataFrame:
        return found.join(score.withColumnRenamed("fp", b), b).select(F.col(a).alias("fp"), F.struct("score", F.col(b).alias("to")).alias("up"))

    own = score.select("fp", F.struct("score", F.col("fp").alias("to")).alias("up"))
    up = own.unionAll(step("a", "b")).unionAll(step("b", "a")).groupBy("fp").agg(F.max("up").alias("up"))
    up = store(up.select("fp", F.col("up.to").alias("to")), "smh-hubs")
    return up.join(up.select(F.col("fp").alias("to"), F.col("to").alias("root")), "to").select("fp", "root")


def stray_pairs(few: DataFrame) -> DataFrame:
    """(a, b): the pairs of different roots in buckets (band, fp, root, common). Members of the bucket's
    commonest root are not compared with each other: one side is always a member of another root."""
    stray = few.filter(F.col("root") != F.col("common")).select("band", F.col("fp").alias("x"), "root")
    every = few.select("band", F.col("fp").alias("y"), F.col("root").alias("other"))
    return stray.join(every, "band").filter("root <> other").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def links(docs: DataFrame, signed: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b): verified links that connect the nodes of every component."""
    with scratch(docs.sparkSession):
        return store(_links(docs, signed, k, num, den), "smh-found", keep=True)


def _links(docs: DataFrame, signed: DataFrame, k: int, num: int, den: int) -> DataFrame:
    reps = signed.filter("fp is not null").groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "code")).alias("rep"),
        F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))
    nodes = store(reps.select("fp", "rep.doc_id", "rep.code", "size", "bands"), "smh-nodes")
    places = nodes.select("fp", "size", F.explode("bands").alias("band"))
    shared = store(places.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "smh-shared")
    members = store(places.join(broadcast_if_small(shared, 48), "band"), "smh-members")
    score = store(members.groupBy("fp").agg(F.sum("n").alias("score")), "smh-scores")
    # the score comes first: max picks the most central member, then the fingerprint decides
    members = store(members.select("band", "fp", "size").join(score, "fp"), "smh-scored")
    wanted = store(members.select("fp").distinct().join(nodes.select("fp", "doc_id", "code"), "fp"), "smh-texts")
    sets = store(candidate_sets(docs, wanted, k).dropDuplicates(["fp"]), "smh-sets")
    left = members.withColumn("root", F.col("fp"))
    found, before = None, None
    while True:
        # members per bucket that have not been a center yet, by component
        per = left.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("score", "fp")).alias("best"))
        per = per.groupBy("band").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"),
                                      F.count(F.lit(1)).alias("kinds"), F.max("best").alias("best"),
                                      F.max(F.struct("n", "root")).alias("top"))
        cross = (F.col("n") * F.col("n") - F.col("same")) / 2
        open_bands = store(per.filter("kinds > 1").select("band", F.col("best.fp").alias("center"), (cross <= PAIRS_LEFT * F.col("n")).alias("few"),
                                                          F.col("top.root").alias("common"), "n", cross.alias("pairs")), "smh-open")
        rows, pairs = open_bands.agg(F.sum("n"), F.sum("pairs")).first()
        if not rows:
            break
        joined = left.join(open_bands.select("band", "center", "few", "common"), "band")
        last = pairs <= PAIRS_LEFT * rows or before is not None and pairs > before / 2
        if last:
            cand = stray_pairs(joined.filter("few"))
        else:
            roots = left.select("fp", "root").distinct().select(F.col("fp").alias("center"), F.col("root").alias("other"))
            cand = joined.join(roots, "center").filter("root <> other").select(
                F.least("fp", "center").alias("a"), F.greatest("fp", "center").alias("b"))
        new = verified(cand.select("a", "b").distinct(), sets, num, den)
        if last:
            new = new.unionAll(bucket_links(joined.filter("not few").select("band", "fp", "size", "root"), sets, num, den))
        found = store(new if found is None else found.unionAll(new), "smh-links")
        if last:
            break
        before = pairs
        left = joined.filter("fp <> center").drop("center", "few", "common", "root")
        left = store(left.join(hubs(found, score), "fp"), "smh-left")
    return members.sparkSession.createDataFrame([], "a binary, b binary") if found is None else found


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text).

    Linked: sets with den * |intersection| >= num * |union|. component_id is the
    smallest doc_id reachable over links, kept = it is the row's own."""
    signed = store(signatures(docs, k), "smh-signed")
    rows = signed.select("doc_id", "n_shingles", "fp")
    comp = connected_components(links(docs, signed, k, num, den))
    least = rows.filter("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("low"))
    least = least.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = store(least, "smh-least")
    groups = least.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = least.select("fp", "root").join(groups, "root").select("fp", "component_id")
    alone = rows.filter("fp is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    out = rows.join(ids, "fp").select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return out.unionAll(alone)


def op10(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), k=4)
