import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pointlake.llm import extendible as X


def norm(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def brute(rows):
    """(doc_id, keep_id, group_size, digest) per row, and the number of rows kept per group."""
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    low = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, low[norm(t)], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows), key=repr)


def check(spark, rows, **kw):
    got = X.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **kw).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = X.exact_duplicates(odd_docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect()), key=repr) == brute(rows)


def test_empty_table(spark, no_docs):
    assert X.exact_duplicates(no_docs).collect() == []


def test_rows_without_an_id_and_repeated_rows_keep_one(spark):
    check(spark, [(None, "a  b")] * 5 + [(None, "c"), (3, "c"), (3, "c"), (2, " c"), (9, ""), (8, None), (7, "\n\t"), (None, None)])


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_colliding_keys_are_chained_and_told_apart_by_their_bytes(spark, bits):
    rows = [(i, f"text  {i % 40}" if i % 3 else f"text {i % 40}") for i in range(200)]
    check(spark, rows, bits=bits, capacity=1)
    index = X.build_index(spark.createDataFrame(rows, "doc_id long, text string"), bits, 1)
    places = [(r.key, r.place) for r in index.entries.collect()]
    assert len(set(places)) == len(places) == 40 and max(p for _, p in places) > 1
    assert index.depth == bits


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.none() | st.integers(0, 6), st.none() | st.text(" \t\n\x0b ab", max_size=4)), min_size=1, max_size=25),
       bits=st.integers(1, 5))
def test_equal_to_grouping_by_hand(spark, rows, bits):
    check(spark, rows, bits=bits, capacity=2)


def test_directory_splits_overfull_buckets_only(spark):
    # keys of 10 bits: 64 share the first five bits, the others are spread
    keys = sorted({*range(0b1011000000 >> 5 << 5, (0b1011000000 >> 5 << 5) + 32), *range(0, 1024, 37)})
    directory, depth = X.build_directory(spark.createDataFrame([(k,) for k in keys], "key long"), 10, 4)
    slots = {r.slot: (r.bucket, r.depth) for r in directory.collect()}
    assert set(slots) == {k >> (10 - depth) for k in keys}
    held = {}
    for k in keys:
        held.setdefault(slots[k >> (10 - depth)], []).append(k)
    for (bucket, own), inside in held.items():
        span = 1 << (10 - own)
        low = bucket << (10 - depth)
        assert all(low <= k < low + span for k in inside)     # a bucket holds exactly its key range
        assert sum(low <= k < low + span for k in keys) == len(inside) <= 4
        if own:                                               # and it was split only because its parent was overfull
            up = low & ~(2 * span - 1)
            assert sum(up <= k < up + 2 * span for k in keys) > 4
    assert len({d for _, d in slots.values()}) > 1


def test_owner_tasks_hold_key_ranges(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    index = X.build_index(docs, capacity=8)
    parts = index.entries.select(F.input_file_name().alias("f"), "bucket").groupBy("f").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    spans = sorted((r.a, r.b) for r in parts.collect())
    assert len(spans) > 1 and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    assert index.depth > X.SPARE_BITS and index.directory.agg(F.max("depth")).first()[0] >= 3


def test_large_groups_are_broadcast_with_equal_results(spark, monkeypatch):
    monkeypatch.setattr(X, "HOT_ROWS", 5)
    check(spark, [(i, "copy  of one" if i % 2 else f"own {i // 6}") for i in range(120)])


def test_a_digest_that_names_two_texts_fails(spark, monkeypatch):
    monkeypatch.setattr(X, "digest", lambda c: F.unhex(F.lit("00")))
    with pytest.raises(Exception, match="one digest names two texts"):
        X.exact_duplicates(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"), bits=1, capacity=1).collect()


def test_very_long_texts_are_compared_whole(spark):
    long = "word " * 300_000
    check(spark, [(1, long + "x"), (2, long + "y"), (3, long.replace(" ", "\t") + "x")])
