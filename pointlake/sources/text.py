"""Text sources: one row per line, from files or from a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rowindex import with_dense_index
from ..functions.text import split_lines


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None,
               with_ids: bool = False) -> DataFrame:
    """``DataFrame[value STRING]`` — every line of the file(s), blank lines
    included. ``with_ids`` adds ``line_id BIGINT`` in front, dense in (file, line)
    order; only then are the lines counted. ``min_partitions`` deals the rows anew."""
    df = spark.read.text(path)
    if with_ids:
        df = with_dense_index(df, "line_id")
    if min_partitions:
        df = df.repartition(int(min_partitions))
    return df


def lines_of_documents(docs: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``DataFrame[doc_id, line_no INT, value STRING]``: every document's text
    split into lines (whole texts; each line is one word-count document)."""
    return docs.select(
        id_col, F.posexplode(split_lines(text_col)).alias("line_no", "value"))
