import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pointlake.llm import token_planes as P

VOCABULARY = P._default_vocabulary()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(VOCABULARY)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 65535), min_size=1, max_size=70), st.sampled_from(["<u2", "<u4"]), st.sampled_from(["bit", "byte"]))
def test_planes_round_trip(ids, dtype, mode):
    ids = np.array(ids, dtype)
    assert (P.from_planes(P.to_planes(ids, mode), len(ids), np.dtype(dtype), mode) == ids).all()


@pytest.mark.parametrize("mode", ["bit", "byte"])
def test_file_round_trip(tmp_path, monkeypatch, mode):
    monkeypatch.setattr(P, "CHUNK", 64)
    rnd = np.random.default_rng(1)
    docs = [(None, 3), (-5, 1), (0, 64), (7, 200), (7, 0), (1 << 60, 31)]
    docs = [(d, rnd.integers(0, 60_000, n).astype("<u2")) for d, n in docs]
    with open(tmp_path / "x", "wb") as out:
        w = P.PlaneWriter(out, np.dtype("<u2"), mode)
        for d, ids in docs:
            w.add(d, ids)
        w.close()
    r = P.PlaneReader(str(tmp_path / "x"))
    assert len(r.index) == 5 and r.footer["mode"] == mode
    got = list(r.documents())
    assert [d for d, _ in got] == [d for d, _ in docs]
    assert all((a == b).all() for (_, a), (_, b) in zip(got, docs, strict=True))
    (tmp_path / "y").write_bytes(b"no such file at all, but long enough")
    with pytest.raises(ValueError):
        P.PlaneReader(str(tmp_path / "y"))


def test_runs_are_encoded_as_in_the_whole_text(tokenizer):
    rnd = random.Random(3)
    parts = ["a", "B", "I", "'s", "é", "İ", "　", "\u0085", "​", "\t", "\n", "\x0b", "\x1c", "\x00", "一", "二", "3", "0", "²", "<|endoftext|>",
             "<|ENDOFTEXT|>", "ﬁ", "각", "ß", "Σ", "🙂", "̸", " ", ". ", "! ", ",", "'re", '"', "x", "<", "***", "'", "_", "-", "»", "…", "é,", "ß's", "&&&", ")."]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(4000)]
    words = P.WordIds(VOCABULARY, 2)
    for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_full_caches_are_emptied(tokenizer, monkeypatch):
    monkeypatch.setattr(P, "WORD_CACHE", 50)
    monkeypatch.setattr(P, "CORE_CACHE", 60)
    words = P.WordIds(VOCABULARY, 2)
    for lo in range(0, 400, 20):
        texts = [f"word{i} Word{i}. and {i}" for i in range(lo, lo + 20)]
        for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
            assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def _check(df, docs, tokenizer):
    got = sorted((r.start, -1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in df.collect())
    at = 0
    texts = {}
    for r in docs.collect():
        texts.setdefault(-1 if r.doc_id is None else r.doc_id, []).append(r.text)
    assert [d for _, d, _, _ in got] == sorted(d for d, ts in texts.items() for _ in ts)
    for start, d, n, crc in got:
        choices = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for t in texts[d]]
        assert start == at and (n, crc) in [(len(c), zlib.crc32(c.tobytes())) for c in choices]
        at += n


def test_odd_rows(odd_docs, no_docs, tokenizer):
    _check(P.tokenised(odd_docs), odd_docs, tokenizer)
    assert P.tokenised(no_docs).count() == 0


def test_whole_table_and_small_files(spark, sf, tokenizer, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    _check(P.op1(spark, sf), docs, tokenizer)
