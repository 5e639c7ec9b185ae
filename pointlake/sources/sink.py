"""Result sink: a Parquet table that readers see whole or not at all.

``publish`` writes a new version in a folder of its own below the table's path and then
replaces the pointer file ``CURRENT`` by a rename, which Hadoop's local and HDFS file systems
do in one step. A job that dies before that leaves the table as it was; a reader follows the pointer once and keeps the
version it opened. The version before the new one is kept for such readers, older ones are deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


def _files(spark: SparkSession, path: str):
    """(Hadoop Path class, FileContext of the path)."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    uri = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri()
    return jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the current version and the one before it (none, if nothing was published)."""
    make, files = _files(spark, path)
    if not files.util().exists(make(f"{path}/{POINTER}")):
        return []
    return [r.value for r in spark.read.text(f"{path}/{POINTER}").collect()]  # two lines


def publish(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` as the table's new version; returns the version's folder. Concurrent publishers
    both write whole versions, and the last rename wins."""
    spark = df.sparkSession
    make, files = _files(spark, path)
    version = f"v-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{version}")
    before = _versions(spark, path)
    lines = spark.createDataFrame([(v,) for v in [version, *before[:1]]], "value string").coalesce(1)
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    lines.write.text(draft)
    part = next(s.getPath() for s in files.util().listStatus(make(draft)) if s.getPath().getName().startswith("part-"))
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    flags = spark.sparkContext._gateway.new_array(rename, 1)
    flags[0] = rename.OVERWRITE
    files.rename(part, make(f"{path}/{POINTER}"), flags)
    files.delete(make(draft), True)
    for old in before[1:]:
        files.delete(make(f"{path}/{old}"), True)
    return f"{path}/{version}"


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version; an error if nothing was published."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"nothing was published at {path}")
    return spark.read.parquet(f"{path}/{versions[0]}")
