"""Word count over text files arriving in a folder (Structured Streaming).

The reference has no streaming; this is the batch word-count operator applied
to a file-stream source, so documents appended as new files update the counts.
State is the per-word count kept by Spark's streaming aggregation (checkpointed
by the query's checkpoint location).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.wordcount import word_count


def stream_lines(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(folder)


def stream_word_count(spark: SparkSession, folder: str, **kw) -> DataFrame:
    """Streaming ``(word, n)``; write it with output mode ``complete`` or ``update``."""
    return word_count(stream_lines(spark, folder, **kw))
