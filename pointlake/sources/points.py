"""Point sources: ``DataFrame[point_id BIGINT, point ARRAY<DOUBLE>, weight BIGINT]``.

``point_id`` carries the identity the reference gets from list position (file
order, 0-based): it breaks ties and defines "the first k+z+1 points".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rowindex import with_dense_index


def parse_point(value: Column | str) -> Column:
    """Comma-separated coordinates → ``array<double>``.

    Trailing commas are forgiven (Java ``split`` drops trailing empty fields);
    blanks around numbers are accepted; anything else unparsable fails the job,
    whatever the session's ANSI mode. A null value gives a null point.
    """
    v = F.col(value) if isinstance(value, str) else value
    numbers = F.transform(F.split(F.regexp_replace(v, ",+$", ""), ",", -1), lambda x: x.try_cast("double"))
    return F.when(F.exists(numbers, lambda x: x.isNull()),
                  F.raise_error(F.concat(F.lit("malformed point: "), v))).otherwise(numbers)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Points from a text file (one point per line), ids in file order."""
    lines = with_dense_index(spark.read.text(path), "point_id")
    return lines.select("point_id", parse_point("value").alias("point"),
                        F.lit(1).cast("bigint").alias("weight"))


def points_from_columns(df: DataFrame, id_col: str, coords: Sequence[Column | str]) -> DataFrame:
    cols = [F.col(c) if isinstance(c, str) else c for c in coords]
    return df.select(F.col(id_col).cast("bigint").alias("point_id"),
                     F.array(*[c.cast("double") for c in cols]).alias("point"),
                     F.lit(1).cast("bigint").alias("weight"))


def points_from_array(df: DataFrame, id_col: str, array_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("point_id"),
                     F.col(array_col).cast("array<double>").alias("point"),
                     F.lit(1).cast("bigint").alias("weight"))


def with_unit_weight(points: DataFrame) -> DataFrame:
    return points.withColumn("weight", F.lit(1).cast("bigint"))
