"""Session helpers: building a local session for tests/bench, reading the
cluster's checkpoint folder, and cutting lineage reliably.

On a cluster the caller owns the session; nothing here overrides settings that
are already present (notably ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Settings used for local runs (tests, bench). On a cluster, size
# spark.sql.shuffle.partitions to the data (≈ input bytes / 128 MB) and keep AQE on
# so it can coalesce small shuffle partitions and split skewed ones.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pointlake", driver_memory: str = "8g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the session.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset on
    a local-mode session (tests) is a fresh scratch folder created; on a
    cluster an unset folder is an error (a machine-local folder is not shared).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        # local run (tests): a scratch folder on this machine is the shared folder
        configured = tempfile.mkdtemp(prefix="pointlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and return a
    DataFrame reading from it (survives executor loss, bounds plan depth)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@dataclass
class Stored:
    """A table written into the checkpoint folder, deleted when it is superseded."""

    df: DataFrame
    path: str

    @classmethod
    def write(cls, df: DataFrame, name: str) -> Stored:
        spark = df.sparkSession
        path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return cls(spark.read.schema(df.schema).parquet(path), path)

    def delete(self) -> None:
        spark = self.df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dealt(df: DataFrame, path: str) -> DataFrame:
    """A table that is one single file is dealt over all cores once, before
    per-row work; a folder of files is read as it lies, without a shuffle."""
    spark = df.sparkSession
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    if file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file).isFile():
        return df.repartition(spark.sparkContext.defaultParallelism)
    return df


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
