from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from pointlake.functions.text import java_comma_split, java_space_split, split_lines
from pointlake.operators import wordcount as W
from pointlake.sources.text import lines_of_documents, read_lines


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first()["r"]


def test_java_space_split_edges(spark):
    assert _one(spark, java_space_split, "") == [""]
    assert _one(spark, java_space_split, "   ") == []
    assert _one(spark, java_space_split, " a  b  ") == ["", "a", "", "b"]
    assert _one(spark, java_space_split, "a\tb c") == ["a\tb", "c"]


def test_java_comma_split_drops_trailing_empties(spark):
    assert _one(spark, java_comma_split, "a,,b,,") == ["a", "", "b"]
    assert _one(spark, java_comma_split, ",,") == []


def test_split_lines(spark):
    assert _one(spark, split_lines, "a\r\nb\n") == ["a", "b"]
    assert _one(spark, split_lines, "") == []
    assert _one(spark, split_lines, "a\n\nb") == ["a", "", "b"]
    assert _one(spark, split_lines, "\n") == [""]
    assert _one(spark, split_lines, "x\ry") == ["x", "y"]


def test_read_lines_dense_ids(spark, fixture_path):
    lines = read_lines(spark, fixture_path("words_5.txt"), with_ids=True).orderBy("line_id").collect()
    assert [r.line_id for r in lines] == [0, 1, 2, 3, 4]
    assert lines[0].value == "test dataset for TemplateHW1"


def test_word_count_fixture(spark, fixture_path):
    docs = read_lines(spark, fixture_path("words_5.txt"), with_ids=True)
    expected = {"dataset": 5, "TemplateHW1": 4, "documents": 2, "number": 2, "prints": 2,
                "words": 2}
    for w in ["also", "average", "contains", "distinct", "five", "for", "length", "run",
              "test", "using"]:
        expected[w] = 1
    plans = [W.word_count(docs), W.word_count_salted(docs, ["line_id"], 3),
             W.word_count_partitioned(docs)]
    for counts in plans:
        assert {r.word: r.n for r in counts.collect()} == expected
    per_doc = W.doc_term_freq(docs, ["line_id"])
    assert per_doc.filter("word = 'dataset'").agg(F.sum("n")).first()[0] == 5
    assert W.distinct_word_count(W.word_count(docs)).first()[0] == 16
    avg = W.avg_word_length(W.word_count(docs)).first()
    assert (avg.distinct_words, avg.total_length, avg.avg_length) == (16, 96, 6)
    assert avg.avg_length_exact == 6.0


def test_empty_text_gives_null_mean(spark):
    docs = spark.createDataFrame([], "line_id bigint, value string")
    avg = W.avg_word_length(W.word_count(docs)).first()
    assert avg.distinct_words == 0 and avg.avg_length is None


def test_documents_as_lines(spark):
    docs = spark.createDataFrame([(1, "a b\r\nc\n"), (2, ""), (3, None)], "doc_id bigint, text string")
    rows = lines_of_documents(docs).orderBy("doc_id", "line_no").collect()
    assert [(r.doc_id, r.line_no, r.value) for r in rows] == [(1, 0, "a b"), (1, 1, "c")]
    assert {r.word: r.n for r in W.word_count(lines_of_documents(docs)).collect()} == \
        {"a": 1, "b": 1, "c": 1}


def test_utf16_length(spark):
    from pointlake.functions.text import utf16_length
    df = spark.createDataFrame([("a\U0001F600b",), ("héllo",)], "w string")
    rows = df.select(utf16_length("w").alias("u"), F.length("w").alias("c")).collect()
    assert [(r.u, r.c) for r in rows] == [(4, 3), (5, 5)]


def test_partition_combine_passes_on_when_full(monkeypatch):
    monkeypatch.setattr(W, "HELD_ROWS", 10)
    words = [f"w{i % 7}" for i in range(60)] + [f"x{i}" for i in range(40)] + [None, None, ""]
    batches = [pa.RecordBatch.from_arrays([pa.array(words[i:i + 9], pa.string())], names=["word"]) for i in range(0, len(words), 9)]
    out = [(w, n) for b in W._combined(iter(batches)) for w, n in zip(*(c.to_pylist() for c in b.columns))]
    got = Counter()
    for w, n in out:
        got[w] += n
    assert got == Counter(words) and len(out) < len(words)
    assert list(W._combined(iter([]))) == []
