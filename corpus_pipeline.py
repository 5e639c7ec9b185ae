"""The training-data pipeline: what a corpus goes through before training.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame; ``run`` writes each stage's rows as Parquet into the
shared folder, deletes the stage's own tables, and reads the rows again as the next stage's docs. All but
the last return the columns of ``documents``.

Stages 1 to 4 decide on rows: toxic documents go, one document of each near-duplicate
group stays (the one with the smallest id), documents that contain a benchmark item go, and the rest is repeated or
left out as the mix of sources asks. The last writes the token files and
returns their documents (doc_id, start, n_tokens, ids_crc32): a document that the mix holds twice is there twice.

Stages 2 and 3 know a document by its id and its text together (``document_key``), never by the id
alone: rows without an id, and different texts under one id, are documents of their own.

Edge cases: a null id comes after all others; an empty table passes through every stage as an empty table;
rows that repeat an id (or the lack of one) and a text are one document: all of them stay or
all go, as a mix that repeats documents needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlake.llm import decontam, mixing, superminhash, token_planes, toxicity
from pointlake.llm.common import broadcast_if_small, read_table, scratch, store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    with scratch(spark):  # the search's tables go when its decision is stored
        gone = superminhash.near_duplicates(_by_key(docs)).filter("not kept").select("doc_id").distinct()
        gone = store(gone, "pipeline-copies", keep=True)
    return _without(docs, gone)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    with scratch(spark):
        found = decontam.contaminated(_by_key(docs), read_table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
        found = store(found, "pipeline-contaminated", keep=True)
    return _without(docs, found)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources holds it."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_planes.tokenised(docs).select("doc_id", "start", "n_tokens", "ids_crc32")


def document_key() -> Column:
    """Id and text of a row as one value that is never null; smaller ids are smaller, no id is the largest."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                    F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).alias("code"))


def _by_key(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the key in the place of the id."""
    return docs.select(document_key().alias("doc_id"), "text")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``gone`` (doc_id; stored). Texts only move where the keys are too many to broadcast."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    d, g = docs.select(document_key().alias("key"), own).alias("d"), broadcast_if_small(gone, 128).alias("g")
    return d.join(g, F.col("d.key").eqNullSafe(F.col("g.doc_id")), "left_anti").select("own.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]

#: The classifier of the first stage and the tokeniser of the last have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):  # what a stage stored on its way goes when its rows are written
            docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
