import random

import numpy as np

from pointlake.llm import components as C
from pointlake.llm import lattice as L
from pointlake.llm import superminhash as S


class Groups(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def union(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1120)] + [(5000, i) for i in range(2000, 2100)]
    want = Groups()
    for a, b in edges:
        want.union(a, b)
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.root for r in C.connected_components(df).collect()}
    assert got == {x: want.find(x) for a, b in edges if a != b for x in (a, b)}
    assert C.connected_components(df.limit(0)).count() == 0


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)]) if 0 < len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(docs, k):
    """Least id reachable over pairs at 0.8, by comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t in docs]
    groups = Groups()
    for x, (i, a) in enumerate(sets):
        groups.find(i)
        for j, b in sets[x + 1:]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                groups.union(i, j)
    return {i: groups.find(i) for i, _ in sets}


def _corpus():
    rnd = random.Random(9)
    vocab = [f"v{i}" for i in range(3000)]
    docs = []

    def add(words):
        docs.append((len(docs) + 10, " ".join(words)))

    for n in (5, 12, 60, 300, 1500):
        for _ in range(3):
            base = rnd.choices(vocab, k=n)
            add(base)
            for share in (0.0, 0.01, 0.03, 0.05, 0.2):
                add([w if rnd.random() > share else rnd.choice(vocab) for w in base])
            add([*base, *rnd.choices(vocab, k=max(1, n // 20))])
    # a chain: each text links with the next only
    step = rnd.choices(vocab, k=400)
    for _ in range(8):
        add(step)
        step = step[30:] + rnd.choices(vocab, k=30)
    # a large group around one text, and texts that share half their words
    base, shared = rnd.choices(vocab, k=250), rnd.choices(vocab, k=120)
    for _ in range(60):
        cut = rnd.randrange(240)
        add(base[:cut] + rnd.choices(vocab, k=4) + base[cut + 4:])
        add(shared + rnd.choices(vocab, k=100))
    rnd.shuffle(docs)
    return docs


def test_near_duplicates_match_brute_force(spark):
    docs = [*_corpus(), (1, None), (2, ""), (3, "two words"), (4, "Two WORDS"), (5, " \t ")]
    want = brute(docs, 4)
    df = spark.createDataFrame([(i, t, "f", "b", "r") for i, t in docs], "doc_id long, text string, fp string, band string, root string")
    got = S.near_duplicates(df.repartition(6), k=4).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(shingles(t, 4)) for r in got for i, t in docs if i == r.doc_id)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_every_pair_of_a_bucket_is_settled_in_rounds_too(spark, monkeypatch):
    monkeypatch.setattr(S, "PAIRS_LEFT", 0)
    docs = _corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in S.near_duplicates(df, k=4).collect()} == brute(docs, 4)


def test_odd_rows(odd_docs, no_docs):
    got = S.near_duplicates(odd_docs).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[1].kept and by[2].kept
    assert by[6].component_id == 5 and not by[6].kept and by[5].kept
    assert by[4].n_shingles > 30_000 and by[None].kept
    assert [r.kept for r in got if r.doc_id == 7] == [True, True]
    assert S.near_duplicates(no_docs).count() == 0


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(2)
    for n in (1, 3, 20, 100, 2000):
        a = rnd.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64)
        b = a.copy()
        b[: n // 5] = rnd.integers(0, 1 << 63, n // 5, dtype=np.int64).astype(np.uint64)
        sig = S.super_minhash([a, b, a[::-1], np.empty(0, np.uint64)], 150)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert (sig[0] == sig[2]).all() and abs((sig[0] == sig[1]).mean() - true) < 0.15
        assert (sig[:3] < np.uint64(150) << np.uint64(40)).all()
    # blocks of documents are signed as each alone
    sets = [rnd.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64) for n in (5, 900, 40)]
    assert (S.super_minhash(sets, 150) == np.concatenate([S.super_minhash([s], 150) for s in sets])).all()


# --- vectors

def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, "n", "r", 1) for i, v, lab in rows],
                                 "vec_id long, embedding array<float>, label int, node string, root string, copies int")


def brute_vectors(rows):
    good = []
    groups, n = Groups(), {}
    for i, v, lab in rows:
        groups.find(i)
        n[i] = 0
        if v is not None and lab is not None and None not in v and len(v) and np.isfinite(v).all() and np.any(v):
            x = np.array(v, np.float32).astype(float)
            good.append((i, x / np.linalg.norm(x), lab))
    for a, (i, x, p) in enumerate(good):
        for j, y, q in good[a + 1:]:
            if p == q and len(x) == len(y) and x @ y >= 0.93:
                groups.union(i, j)
                n[i] += 1
                n[j] += 1
    return {i: (n[i], groups.find(i)) for i in n}


def _cloud(seed=3):
    rnd = np.random.default_rng(seed)
    rows = []
    for lab in (0, 1):
        for _ in range(25):
            base = rnd.standard_normal(64)
            base /= np.linalg.norm(base)
            for c in (1.0, 0.99, 0.95, 0.935, 0.925, 0.9, 0.5):
                o = rnd.standard_normal(64)
                o -= (o @ base) * base
                rows.append((c * base + np.sqrt(1 - c * c) * o / np.linalg.norm(o)).tolist())
    rows += [rows[0]] * 4 + [[2 * x for x in rows[7]]]
    return [(i, v, i % 2) for i, v in enumerate(rows)]


def test_links_match_brute_force(spark, monkeypatch):
    rows = [(i, v, i // 175 if i < 350 else 0) for i, v, _ in _cloud()]
    rows += [(900, None, 1), (901, [0.0] * 64, 1), (902, [float("nan")] * 64, 1), (903, [None] * 64, 1), (904, rows[0][1], None), (905, [], 1),
             (906, [1.0, 0.0], 1), (907, [1.0, 0.0], 1)]
    want = brute_vectors(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in L.near_vectors(_vectors(spark, rows).repartition(5)).collect()}
    links = sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.98 * links > 100
    assert all(got[i] == want[i] for i in range(900, 908))
    assert got[0][0] >= 4  # its four copies


def test_chunks_of_a_bucket_give_the_same(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    base = rnd.standard_normal(64)
    rows = [(i, (base + 0.02 * rnd.standard_normal(64)).tolist(), 3) for i in range(120)]
    monkeypatch.setattr(L, "CHUNK", 16)
    got = L.near_vectors(_vectors(spark, rows)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(119, 0)}


def test_no_vectors(spark):
    assert L.near_vectors(_vectors(spark, [])).count() == 0


def test_decoding_finds_the_nearest_lattice_point():
    rnd = np.random.default_rng(6)
    y = rnd.standard_normal((200, 8)) * 2
    got = L.e8_round(y) / 2
    near = (got[:, None, :] + np.concatenate([L.minimal_vectors() / 2, np.zeros((1, 8))])[None]) - y[:, None, :]
    assert ((near**2).sum(axis=2).min(axis=1) >= ((got - y) ** 2).sum(axis=1) - 1e-9).all()
    assert len(L.minimal_vectors()) == 240 and (np.abs(got.sum(axis=1) % 2) < 1e-9).all()


def test_rows_without_an_id_meet_their_own_node_only(spark):
    rnd = random.Random(4)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(30)) for _ in range(1500)]
    docs = spark.createDataFrame([(i, t) for t in texts for i in (None, None)] + [(7, t + " end") for t in texts], "doc_id long, text string")
    signed = S.signatures(docs, 4)
    nodes = signed.groupBy("fp").agg(S.F.min(S.F.struct(S.F.col("doc_id").isNull().alias("no_id"), "doc_id", "code")).alias("rep"))
    nodes = S.store(nodes.select("fp", "rep.doc_id", "rep.code"), "test-nodes")
    found = S.candidate_sets(docs, nodes, 4)
    assert nodes.count() == found.select("fp").distinct().count() == 3000
    assert found.count() == 4500  # a row per document that repeats its node's id and text, none across texts
    got = S.near_duplicates(docs, k=4).collect()
    assert len(got) == 4500 and {r.component_id for r in got} == {7}


def test_members_of_the_commonest_root_are_not_compared_with_each_other(spark):
    rows = [("b", f"m{i:05}".encode(), b"r") for i in range(3000)] + [("b", x, x) for x in (b"s1", b"s2", b"a3")]
    few = spark.createDataFrame(bytearrays(rows), "band string, fp binary, root binary").withColumn("common", S.F.lit(b"r"))
    pairs = S.stray_pairs(few)
    assert pairs.count() == 3 * 3000 + 2 * 3 and pairs.distinct().count() == 3 * 3000 + 3
    # with strays inside real buckets, in the last round
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(base[:190] + [f"x{i}"])) for i in range(40)] + [(100 + i, " ".join(base[:150] + [f"y{i}-{rnd.random()}" for _ in range(10)])) for i in range(3)]
    got = {r.doc_id: r.component_id for r in S.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=4).collect()}
    assert got == brute(docs, 4)


def bytearrays(rows):
    return [tuple(bytearray(x) if isinstance(x, bytes) else x for x in r) for r in rows]


def test_scratch_tables_go_when_the_result_is_stored(spark):
    from pathlib import Path

    from pointlake.llm.common import scratch, store
    with scratch(spark):
        inner = store(spark.range(5).toDF("n"), "gone")
        kept = store(inner.filter("n > 2"), "kept", keep=True)
        path = Path(inner.inputFiles()[0].removeprefix("file:")).parent
        assert path.exists()
    assert not path.exists() and kept.count() == 2
