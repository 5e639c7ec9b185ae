import zlib

import numpy as np

from pointlake.llm import toxicity as T


def _fit(penalty):
    """Toxic texts that often name one group: the classifier must not learn the name."""
    rnd = np.random.default_rng(0)
    normal, texts, swaps, y = T.Normalised(), [], {}, []
    for i in range(600):
        toxic = i % 3 == 0
        words = {f"w{k}" for k in rnd.integers(0, 400, 30)} | ({f"slur{rnd.integers(0, 4)}"} if toxic and rnd.random() < 0.9 else set())
        if rnd.random() < (0.6 if toxic else 0.05):
            words.add("muslim")
        swap = T.counterfactual(words)
        texts.append(np.array([f for w in sorted(words) for f in T.word_features(w)], np.int32))
        if swap:
            swaps[i] = tuple([f for w in sorted(s) for f in T.word_features(w)] for s in swap)
        y.append(float(toxic))
    y = np.array(y)
    model = T.train(texts, swaps, np.full(600, 30), y, np.ones(600), penalty)
    score = lambda t: T.score_text(t, model, T.WordScores(model), normal)
    return score


def test_penalty_evens_out_identity_terms():
    plain, fair = _fit(0.0), _fit(20.0)
    neutral, other = "a muslim went to w1 and w2", "a hindu went to w1 and w2"
    logit = lambda p: np.log(p / (1 - p))
    gap = {f: abs(logit(f(neutral)) - logit(f(other))) for f in (plain, fair)}
    assert gap[plain] > 1 and gap[fair] < 0.3 * gap[plain]
    assert fair("you slur1 slur2 w3") > 0.5 > fair("w1 w2 w3")


def test_counterfactual_swaps_within_a_group():
    assert T.counterfactual({"a", "muslim"}) == ({"muslim"}, {"christian"})
    assert T.counterfactual({"women", "men"}) == (set(), set())
    assert T.counterfactual({"x"}) is None


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    rows = T.op7(spark, path).join(labels, "doc_id").filter("held_out").select("predicted", "toxic", "score").collect()
    assert docs.count() > len(rows) > 500
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.85
    assert sum(r.predicted for r in clean) / len(clean) < 0.01
    assert all(0 <= r.score <= 1 for r in rows)


def test_sample_leaves_held_out_ids(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    ids = [r.doc_id for r in T.training_sample(docs, labels).collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 5 for i in ids)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 0), (8, 1), (8, 0), (99, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    model = T.fit(odd_docs, labels)
    got = T.score_documents(odd_docs, model).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (1, 2, 3, 9)}
    assert len(empty) == 1
    assert T.without_toxic(odd_docs, model).columns == odd_docs.columns
    assert T.without_toxic(odd_docs, None).count() == 11
    assert T.score_documents(no_docs, model).count() == 0
    assert T.fit(odd_docs, labels.filter("toxic = 0")) is None and T.fit(no_docs, labels) is None


def test_sample_bounds_rows_not_only_ids(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(600)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    rows = {(r.doc_id, r.text) for r in T.training_sample(docs, labels).collect()}
    assert rows <= {(1, "text 0"), (2, "other")} and rows


def test_word_caches_are_bounded_and_keep_the_words_that_come_again(monkeypatch):
    monkeypatch.setattr(T.WordScores, "LIMIT", 10)
    asked = []
    monkeypatch.setattr(T, "word_features", lambda w: asked.append(w) or [len(w)])
    scores = T.WordScores(T.Model(0.0, 0.0, np.arange(T.DIM, dtype=float)))
    for i in range(200):
        assert scores["often"] == 5.0 and scores[f"once{i}"] == len(f"once{i}")
        assert len(scores) <= 10 and len(scores.before) <= 10
    assert asked.count("often") == 1
