"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Hashable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import ensure_checkpoint_dir, read_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: White space that ends a word: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: A relation is broadcast only when its measured size is below this many bytes.
BROADCAST_BYTES = 32 << 20

__all__ = ["BLANKS", "BROADCAST_BYTES", "Recent", "ascii_lower", "broadcast_if_small", "open_store", "read_table", "released",
           "scratch", "shared_folder", "store", "word_count", "words", "writing"]


class Recent(dict):
    """``of`` a key, kept for the keys used last: at least LIMIT of them, at most twice as many. Keys that
    come once only, as most do in large texts, do not push out those that come again."""

    LIMIT = 25_000

    def __init__(self):
        super().__init__()
        self.before: dict = {}

    def of(self, key: Hashable):
        raise NotImplementedError

    def __missing__(self, key: Hashable):
        if len(self) >= self.LIMIT:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.of(key)
        self[key] = value
        return value


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; after the last, what Arrow holds unused goes back, as idle workers stay for other stages."""
    yield from batches
    pa.default_memory_pool().release_unused()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Tables stored in the scratch scopes that are open, innermost last.
_SCOPES: list[list[str]] = []


def store(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage, survives lost executors, and lets later scans prune columns. ``keep``:
    the table outlives the innermost ``scratch`` scope (but not one around it)."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    if len(_SCOPES) > keep:
        _SCOPES[-1 - keep].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables stored inside at its end, when what was made of them is stored with ``keep`` or outside."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for name in _SCOPES.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of a stored table only if its counted rows fit the
    limit; beyond it the join is left to shuffle. Results are the same."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, everything else unchanged."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Runs of characters other than the six ASCII blanks; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(c, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def word_count(c: Column) -> Column:
    return F.size(words(c)).cast("long")


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a folder or file below the shared folder, in any
    store that Arrow opens (file, hdfs, s3, gs). Called inside tasks."""
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def writing(uri: str) -> Iterator[pa.NativeFile]:
    """Write ``uri`` under a name of this attempt, then move it: a file appears whole or not
    at all, and an attempt that is run again replaces it by the same bytes."""
    fs, path = open_store(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temp) as out:
        yield out
    fs.move(temp, path)
