import random
import re

from pointlake.llm import decontam as D


def shingles(text):
    w = [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = [x for x in re.split(r"[^\w]+|_", (t or "").lower()) if x]
        for i, x in items:
            want = shingles(x)
            n = len(next(iter(want), ()))
            have = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
            if want and len(want & have) / len(want) >= 0.8:
                out[d, i] = (len(want), len(want & have))
    return out


def _run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, hash string, n_item int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    return {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in D.contaminated(d, b).collect()}


def _corpus():
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choices(vocab, k=n))) for i, n in enumerate((4, 6, 9, 17, 40, 90, 260, 700))]
    docs = [(i, " ".join(rnd.choices(vocab, k=rnd.choice((3, 50, 400))))) for i in range(30)]
    for i, t in items:
        words = t.split()
        docs.append((100 + i, " ".join(rnd.choices(vocab, k=300)) + " " + t.upper().replace(" ", ", ") + " " + " ".join(rnd.choices(vocab, k=5000))))
        cut = words[:]
        if len(cut) > 20:
            cut[len(cut) // 2] = "changed"
        docs.append((200 + i, "start " + " ".join(cut) + " end"))
        docs.append((300 + i, " ".join(words[: len(words) // 2])))
    docs += [(400, items[0][1]), (401, None), (402, ""), (403, " .,; "), (404, items[4][1]), (404, items[4][1]), (None, items[5][1])]
    items += [(50, None), (51, ""), (52, items[4][1])]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = _corpus()
    got, want = _run(spark, docs, items), brute(docs, items)
    assert got == want
    assert (104, 4) in got and (204, 4) in got and (300, 0) not in got and (400, 0) in got and (None, 5) in got and (404, 52) in got


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs, items = _corpus()
    monkeypatch.setattr(D, "BLOCK_ROWS", 100)
    assert _run(spark, docs, items) == brute(docs, items)


def test_items_of_one_to_four_words_inside_long_documents(spark):
    rnd = random.Random(9)
    fill = " ".join(rnd.choices([f"x{i}" for i in range(90)], k=4000))
    items = [(1, "Unique"), (2, "two words"), (3, "just three words"), (4, "Exactly four words here"), (5, "exactly four words")]
    docs = [(i, f"{fill} {t.upper()}, {fill}") for i, t in items]
    docs += [(10, "words two"), (11, "two  words"), (12, fill), (13, "exactly four"), (14, "just-three-words"), (15, None), (16, "unique")]
    got = _run(spark, docs, items)
    assert got == brute(docs, items)
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 4), (4, 5), (5, 5), (11, 2), (14, 3), (16, 1)}


def test_empty_tables(spark):
    docs, items = _corpus()
    assert _run(spark, [], items) == {} and _run(spark, docs, []) == {}


def test_hits_asked_are_safe():
    assert D.least_hits(10, 10) == 8          # the whole set is the sketch: nothing is estimated
    assert D.least_hits(40, 24) >= 1
    assert all(D.class_hits(k) >= 1 for k in range(24))
