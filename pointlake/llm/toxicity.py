"""Toxicity: a logistic classifier regularised by counterfactual identity swaps.

Features of a text are its distinct lower-cased words, each with its own
weight and the weights of its proper prefixes of PREFIXES letters (inflected
forms share them), hashed into DIM places; the mean over distinct words beside
the sum keeps one odd word in a long text apart from many in a short one.

Training takes a bounded sample of labelled documents (``PER_CLASS`` of each class, by hash of
the id; the classes are weighted back to their shares). For every
training text with identity terms each term is swapped for another of its group, and
the squared difference of the two logits is added to the loss, so a neutral
mention of one group moves the score no more than of another. Labels, language, source and id are not inputs.

Edge cases: a null or empty text scores by the intercept alone; a text of any length is
scored whole; labels that are null, or whose document is missing, are not used, and
neither are ids with both labels; an id with several texts is one training row, its least text; with one class or none every score is 0.0; repeated rows score alike; rows keep
a null id (held_out is false for it); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Recent, read_table, released

DIM = 1 << 18
PREFIXES = (4, 5, 6, 7, 8)
#: Bound of the training sample: documents per class.
PER_CLASS = {1: 1500, 0: 4500}
#: A feature must occur in this many training texts.
MIN_TEXTS = 3
MIN_Z = 3.5
L2 = 0.2
PENALTY = 1.0
STEPS = 150
FOLDS = 5
STRIP = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”‘’«»…¡¿"

#: Identity terms by group; a counterfactual replaces a term by the next of its group.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual"),
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"),
    ("transgender", "cisgender"), ("disabled", "deaf", "blind"),
    ("immigrants", "refugees", "foreigners", "locals"), ("immigrant", "refugee", "foreigner", "local"),
)


@dataclass
class Model:
    """bias, weights by feature, weight of log(1 + distinct words)."""

    bias: float
    length: float
    weights: np.ndarray = field(repr=False)


def _hash(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) & (DIM - 1)


def word_features(word: str) -> list[int]:
    """Hashed features of one normalised word."""
    return [_hash(f"w {word}"), *[_hash(f"p {word[:n]}") for n in PREFIXES if len(word) > n]]


class Normalised(Recent):
    """Raw token to word: lower case without outer punctuation."""

    def of(self, token: str) -> str:
        return token.lower().strip(STRIP)


def distinct_words(text: str | None, normal: Normalised) -> set[str]:
    found = set(map(normal.__getitem__, set(text.split()))) if text else set()
    found.discard("")
    return found


def counterfactual(words: set[str], groups: Sequence[Sequence[str]] = IDENTITY_GROUPS) -> tuple[set[str], set[str]] | None:
    """(terms taken out, terms put in) when every identity term is swapped; None without any."""
    out, put = set(), set()
    for group in groups:
        for i, term in enumerate(group):
            if term in words:
                out.add(term)
                put.add(group[(i + 1) % len(group)])
    return (out - put, put - out) if out else None


def telling(texts: Sequence[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Features in at least MIN_TEXTS texts whose share of toxic texts differs from the
    share of all by MIN_Z standard errors (two-proportion test)."""
    n, n1 = np.zeros(DIM), np.zeros(DIM)
    for own, label in zip(texts, y, strict=True):
        own = np.unique(own)
        n[own] += 1
        n1[own] += label
    with_f, without = n1 / np.maximum(1, n), (y.sum() - n1) / np.maximum(1, len(y) - n)
    error = np.sqrt(max(1e-12, y.mean() * (1 - y.mean())) * (1 / np.maximum(1, n) + 1 / np.maximum(1, len(y) - n)))
    return (n >= MIN_TEXTS) & (np.abs(with_f - without) >= MIN_Z * error)


def train(texts: Sequence[np.ndarray], swaps: Mapping[int, tuple[Sequence[int], Sequence[int]]], lengths: np.ndarray,
          y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY) -> Model:
    """Full-batch gradient descent (Adam) on the weighted log loss, L2, and the
    counterfactual penalty. ``texts``: features with repeats; ``swaps``: features out and in."""
    seen = telling(texts, y)
    texts = [t[seen[t]] for t in texts]
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    cols = np.concatenate([*texts, np.empty(0, np.int32)]).astype(np.int64)
    s_rows, s_cols, s_sign = [], [], []
    for i, (_, (out, put)) in enumerate(sorted(swaps.items())):
        s_rows += [i] * (len(out) + len(put))
        s_cols += [*out, *put]
        s_sign += [1.0] * len(out) + [-1.0] * len(put)
    s_rows, s_cols, s_sign = np.asarray(s_rows, np.int64), np.asarray(s_cols, np.int64), np.asarray(s_sign)
    n_swaps = max(1, len(swaps))
    w, bias, length = np.zeros(DIM), 0.0, 0.0
    long = np.log1p(lengths) - 4.0
    m, v = np.zeros(DIM + 2), np.zeros(DIM + 2)
    weight = weight / weight.sum()
    used = np.unique(np.concatenate([cols, s_cols]))
    for step in range(1, STEPS + 1):
        z = bias + length * long + np.bincount(rows, w[cols], minlength=len(texts))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        grad = np.zeros(DIM + 2)
        grad[:DIM] = np.bincount(cols, g[rows], minlength=DIM)
        if len(s_rows):
            gap = np.bincount(s_rows, w[s_cols] * s_sign, minlength=n_swaps)
            grad[:DIM] += 2 * penalty / n_swaps * np.bincount(s_cols, gap[s_rows] * s_sign, minlength=DIM)
        grad[used] += L2 / len(texts) * w[used]
        grad[DIM], grad[DIM + 1] = g.sum(), g @ long
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        w -= move[:DIM]
        bias -= move[DIM]
        length -= move[DIM + 1]
    return Model(float(bias), float(length), w)


class WordScores(Recent):
    """Raw token's word and the word's summed weight."""

    LIMIT = 250_000  # a weight costs far more than a look-up

    def __init__(self, model: Model):
        super().__init__()
        self.w = model.weights

    def of(self, word: str) -> float:
        return float(self.w[word_features(word)].sum())


def score_text(text: str | None, model: Model, scores: WordScores, normal: Normalised) -> float:
    words = distinct_words(text, normal)
    z = model.bias + model.length * (np.log1p(len(words)) - 4.0) + sum(map(scores.__getitem__, sorted(words)))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def in_fold(c: Column, folds: int = FOLDS) -> Column:
    """True where crc32 of the id as text is a multiple of ``folds``."""
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % folds == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, text) of at most PER_CLASS documents per class, a row each; held-out ids never.
    Of several texts under one id the least is taken, so that the bound holds for rows too."""
    usable = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~in_fold(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
              .filter("toxic = other").drop("other"))
    parts = [usable.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in PER_CLASS.items()]
    chosen = parts[0].unionAll(parts[1])  # at most sum(PER_CLASS) rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    normal = Normalised()
    for batch in batches:
        rows = {"doc_id": batch.column(0).to_pylist(), "toxic": batch.column(1).to_pylist(), "n": [], "own": [], "out": [], "put": []}
        for text in batch.column(2).to_pylist():
            words = distinct_words(text, normal)
            swap = counterfactual(words)
            rows["n"].append(len(words))
            rows["own"].append([f for w in sorted(words) for f in word_features(w)])
            rows["out"].append([f for w in sorted(swap[0]) for f in word_features(w)] if swap else None)
            rows["put"].append([f for w in sorted(swap[1]) for f in word_features(w)] if swap else None)
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["toxic"], pa.int32()), pa.array(rows["n"], pa.int32()),
             pa.array(rows["own"], ints), pa.array(rows["out"], ints), pa.array(rows["put"], ints)],
            names=["doc_id", "toxic", "n", "own", "out", "put"])


def fit(docs: DataFrame, labels: DataFrame, penalty: float = PENALTY) -> Model | None:
    """The model of the bounded training sample; None without both classes."""
    counts = dict(labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~in_fold(F.col("doc_id")))
                  .groupBy("toxic").agg(F.count(F.lit(1))).collect())
    sample = training_sample(docs, labels).select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"), "text")
    table = sample.mapInArrow(_features, "doc_id long, toxic int, n int, own array<int>, out array<int>, put array<int>").toArrow()
    table = table.sort_by([("doc_id", "ascending"), ("n", "ascending")])
    y = table["toxic"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return None
    own = table["own"].combine_chunks()
    flat, at = own.values.to_numpy(), own.offsets.to_numpy()
    texts = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    swaps = {i: (o, p) for i, (o, p) in enumerate(zip(table["out"].to_pylist(), table["put"].to_pylist(), strict=True)) if o is not None}
    weight = np.where(y == 1, counts[1] / max(1, (y == 1).sum()), counts[0] / max(1, (y == 0).sum()))
    return train(texts, swaps, table["n"].to_numpy(), y, weight, penalty)


def _scorer(model: Model | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normal, scores = Normalised(), WordScores(model) if model else None
        for batch in batches:
            for lo in range(0, len(batch), 1000):
                part = batch.slice(lo, 1000)
                s = [score_text(t, model, scores, normal) if model else 0.0 for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64())], names=[*part.schema.names, "toxic_score"])

    return lambda batches: released(run(batches))


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select("doc_id", "text")
    kinds = f"doc_id {dict(docs.dtypes)['doc_id']}, text string, toxic_score double"
    return rows.mapInArrow(_scorer(model), kinds).select("doc_id", F.col("toxic_score").alias("score"))


def without_toxic(docs: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` (same columns) whose text scores below the threshold."""
    text = F.col("text")
    own = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("own"), text)
    kinds = T.StructType([*rows.schema.fields, T.StructField("toxic_score", T.DoubleType())])
    kept = rows.mapInArrow(_scorer(model), kinds).filter(F.col("toxic_score") < threshold)
    return kept.select(*[text if c == "text" else F.col(f"own.`{c}`") for c in docs.columns])


def op7(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
