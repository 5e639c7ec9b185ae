import math

import corpus_pipeline as C
from test_decontam import brute as leaks
from test_neardup import brute as groups


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = {}
    for name, stage in C.STAGES[:4]:
        before = docs
        docs = C.store(stage(spark, before, sf), "test")
        assert docs.columns == before.columns
        rows = [(r.doc_id, r.text) for r in before.collect()]
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "near_duplicates":
            want = groups(rows, 5)
            assert sorted(kept[name]) == sorted((i, t) for i, t in rows if want[i] == i)
        if name == "decontamination":
            bad = {d for d, _ in leaks(rows, bench)}
            assert sorted(kept[name]) == sorted((i, t) for i, t in rows if i not in bad)
        if name == "source_mix":
            assert set(kept[name]) <= set(rows)
            assert all(1 <= kept[name].count(x) <= 2 for x in set(kept[name]))
            sizes = [sum(len(t.split()) for _, t in x) for x in (kept[name], rows)]
            assert math.isclose(sizes[0] / sizes[1], 1.5, rel_tol=0.1)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    gone = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()} - {i for i, _ in kept["toxicity"]}
    assert sum(labels.get(i, 1) for i in gone) > 0.9 * len(gone) > 0
    tokens = C.write_tokens(spark, docs, sf).collect()
    assert sorted(r.doc_id for r in tokens) == sorted(i for i, _ in kept["source_mix"])


def test_empty_and_odd_tables_pass_through(spark, sf, odd_docs, no_docs):
    for start in (no_docs, odd_docs):
        docs = start
        for _, stage in C.STAGES:
            docs = C.store(stage(spark, docs, sf), "test")
        assert "ids_crc32" in docs.columns
    assert C.store(C.drop_near_duplicates(spark, odd_docs, sf), "t").count() == 10


def test_documents_without_an_id_or_with_a_shared_one_are_judged_alone(spark, sf):
    item = next(r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if len(r.text.split()) >= 15)
    text = lambda name: " ".join(f"{name}{i}" for i in range(40))
    half = len(item.split()) // 2
    parts = [" ".join(item.split()[:half + 2]), " ".join(item.split()[half - 2:])]  # together, but not alone, the item
    rows = [(1, text("a")), (None, text("a")), (None, text("b")), (None, f"{text('c')} {item}"), (None, text("d")),
            (None, text("d") + " more"), (5, text("a") + " more"), (5, text("e")), (6, f"{text('f')} {item}"), (6, text("g")),
            (7, text("h")), (7, text("h")), (None, f"{text('i')} {parts[0]}"), (None, f"{text('j')} {parts[1]}"), (None, None),
            (8, text("k")), (9, text("k") + " more"), (9, text("l")), (10, text("l") + " more")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    once = C.store(C.drop_near_duplicates(spark, docs, sf), "test")
    kept = [(r.doc_id, r.text) for r in once.collect()]
    several = [(None, text("d")), (None, text("d") + " more")]  # one of them stays
    assert sum(kept.count(x) for x in several) == 1
    gone = [rows[1], rows[6], rows[16], rows[18], *several]
    assert sorted(map(str, (x for x in kept if x not in several))) == sorted(map(str, (x for x in rows if x not in gone)))
    clean = [(r.doc_id, r.text) for r in C.drop_contaminated(spark, once, sf).collect()]
    assert sorted(map(str, clean)) == sorted(map(str, (x for x in kept if x not in (rows[3], rows[8]))))
