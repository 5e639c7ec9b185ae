import pytest
from pyspark.sql import functions as F

from pointlake.llm import mixing as M


def _rows(df):
    return [r.asDict() for r in df.collect()]


def test_targets_are_water_filled(spark):
    base = spark.createDataFrame([("a", 100), ("b", 900), ("c", 50), (None, 10)], "source string, size long")
    got = {r["source"]: r for r in _rows(M.source_targets(base))}
    # weights 3, 1, 2, 3 by name, null last; total 1.5 * 1060 = 1590; a, c and null stop at twice their size
    assert {k: v["weight"] for k, v in got.items()} == {"a": 3, "b": 1, "c": 2, None: 3}
    assert {k: v["target"] for k, v in got.items()} == {"a": 200.0, "b": 1270.0, "c": 100.0, None: 20.0}


def test_taken_meets_the_target_to_the_word(spark, sf):
    got = _rows(M.mix_sources(spark.read.parquet(f"{sf}/documents.parquet")))
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["copies"] in (0, 1, 2)
    for rows in by.values():
        assert sum(r["size"] for r in rows) == rows[0]["source_size"]
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 1
        # complete epochs come first: nobody has two more than another, one document at most is cut
        epochs = {r["taken"] // r["size"] for r in rows if r["size"]}
        assert max(epochs) - min(epochs) <= 1
        assert sum(r["taken"] % r["size"] > 0 for r in rows if r["size"]) <= 1
    again = _rows(M.mix_sources(spark.read.parquet(f"{sf}/documents.parquet").repartition(5)))
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_higher_quality_is_taken_more_often(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x y z").alias("text"), F.lit("s").alias("source"))
    extra = spark.range(1).select(F.lit(-1).alias("doc_id"), F.repeat(F.lit("w "), 60_000).alias("text"), F.lit("t").alias("source"))
    got = M.mix_sources(docs.unionAll(extra), weights=(1, 30), total=0.5, max_epochs=2,
                        quality=F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0))
    rows = got.filter("source = 's'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum(F.col("taken") / 3).alias("n")).collect()
    n = {r.odd: r.n for r in rows}
    assert n[0] > 1.5 * n[1] > 0


def test_odd_rows(odd_docs, no_docs):
    got = _rows(M.mix_sources(odd_docs))
    assert len(got) == 11
    assert {r["doc_id"]: r["taken"] for r in got if not r["size"]} == {1: 0, 2: 0, 3: 0, 9: 0}
    both = [r["taken"] for r in got if r["doc_id"] == 7]
    assert len(both) == 2 and both[0] == both[1]
    mixed = M.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    copies = sum(r["copies"] for r in got)
    assert mixed.count() == copies
    assert M.mix_sources(no_docs).count() == 0 and M.mixed_documents(no_docs).count() == 0


def test_no_words_at_all(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [(r["taken"], r["target"]) for r in _rows(M.mix_sources(docs))] == [(0, 0.0), (0, 0.0)]


@pytest.mark.parametrize("buckets", [1, 7])
def test_buckets_do_not_change_the_mix(spark, sf, monkeypatch, buckets):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = sorted(map(str, _rows(M.mix_sources(docs))))
    monkeypatch.setattr(M, "MIN_BUCKETS", buckets)
    assert sorted(map(str, _rows(M.mix_sources(docs)))) == want
