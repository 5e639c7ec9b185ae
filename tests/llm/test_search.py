import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pointlake.llm import bloom_search as B

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, query long, score long, key string"
ITEMS = "item_id long, text string, rank int"


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    found = [(i, Counter(split(t))) for i, t in docs]
    found = [(i, tf, sum(tf.values())) for i, tf in found if tf]
    n_docs, total, df = len(found), sum(n for _, _, n in found), Counter(t for _, tf, _ in found for t in tf)
    out = []
    for item, text in set(items):
        scores = []
        for i, tf, n in found:
            m = 10 + 90 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in set(split(text)) if t in tf)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def got(spark, docs, items, **kw):
    found = B.search(spark.createDataFrame([(*d, 1, 2, "x") for d in docs], DOCS), spark.createDataFrame([(*i, 0) for i in items], ITEMS), **kw)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


def corpus(seed, n, words=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Élan", "ünïcode", "日本", "x1", "A", "b"]
    zipf = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda most: rng.choice([" ", "-", "_\n"]).join(rng.choices(vocabulary, zipf, k=rng.randint(1, most)))
    docs = [(i, text(rng.choice([5, 60, 400]))) for i in range(n)]
    docs += [(n + i, docs[i % 7][1]) for i in range(20)] + [(None, docs[3][1]), (None, None), (None, "own text w0 w1"), (5, docs[5][1]), (n + 50, ""), (n + 51, " -- ")]
    return docs, [(i, text(12)) for i in range(25)] + [(30, None), (31, "nowhere"), (32, ""), (None, "w3 w5 W5"), (None, "w7"), (33, "w0 W0 w0"), (33, "w0 W0 w0")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_scoring_everything(spark, seed):
    docs, items = corpus(seed, 150)
    assert got(spark, docs, items) == brute(docs, items)


def test_many_blocks_of_queries_and_documents(spark, monkeypatch):
    monkeypatch.setattr(B, "QUERY_BYTES", 300)
    monkeypatch.setattr(B, "GROUP_QUERIES", 2)
    docs, items = corpus(3, 60)
    assert got(spark, docs, items, k=3) == brute(docs, items, 3)


def test_bounds_are_never_below_the_score_and_exclude_most():
    docs, items = corpus(4, 300)
    rows = pa.RecordBatch.from_arrays([pa.array([j for j, _ in enumerate(docs)], pa.int64()), pa.array([i for i, _ in docs], pa.int64()),
                                       pa.array([t.encode() if t else None for _, t in docs], pa.binary())], names=["key", "doc_id", "text"])
    found = [(Counter(split(t))) for _, t in docs]
    n_docs, total, df = sum(map(bool, found)), sum(sum(x.values()) for x in found), Counter(t for x in found for t in x)
    names = sorted({t for _, text in items for t in split(text)})
    uses = [np.array([names.index(t) for t in dict.fromkeys(split(text))], np.int64) for _, text in items]
    weights = np.array([B.weight(n_docs, df[t]) if t in df else 0 for t in names], np.int64)
    q = B.Queries([i for i, _ in items], uses, [t.encode() for t in names], weights)
    close = pairs = 0
    for block in B._blocks(B._indexed(iter([rows]))):
        for i, bound in B.block_bounds(block, B.Plan.of(q), n_docs, total):
            for key, b in zip(block["keys"].to_pylist(), bound.tolist()):
                m = 10 + 90 * sum(found[key].values()) * n_docs // total
                score = sum(int(weights[t]) * B.gain(found[key][names[t]], m) for t in uses[i].tolist() if found[key][names[t]])
                assert b >= score
                close += b <= 1.1 * score + 10**9
                pairs += 1
    assert pairs and close > 0.8 * pairs


def test_documents_out_of_reach_are_not_rescored(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    index = B.build_index(docs)
    (rows,) = B.query_blocks(items)
    found = B.search_block(docs, B.queries_of(rows, index), index, 10)
    most = found.candidates.agg({"n": "sum"}).first()[0]
    assert found.best.count() <= most < 0.5 * index.n_docs * len(rows)


def test_blocks_hold_documents_of_like_size():
    docs = [B.Doc(i, i, n, np.arange(n, dtype=np.int32), np.zeros(n, np.int8)) for i, n in enumerate([1, 3, 9000, 2, 40, 80, 170, 10**6])]
    blocks = list(B.sized_blocks(docs))
    assert sorted(d.id for b in blocks for d in b) == list(range(8))
    assert all(b[-1].pairs <= 2 * b[0].pairs + 32 for b in blocks)


def test_odd_documents_and_a_very_long_one(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(1, "word5x5 two Three"), (2, "the same row"), (3, "id")]
    assert got(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a")], []) == [] and got(spark, [(1, None)], [(1, "a")]) == []
