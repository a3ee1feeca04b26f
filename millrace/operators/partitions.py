"""Partition profiles, range partitions, checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import checkpointed


def with_partition(df: DataFrame, to: str = "part") -> DataFrame:
    return df.withColumn(to, F.spark_partition_id())


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return with_partition(df).groupBy("part").agg(F.count("*").alias("n_rows"))


def range_bounds(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Least and greatest key of each range partition."""
    return (
        with_partition(df.repartitionByRange(partitions, key))
        .groupBy("part")
        .agg(
            F.min(key).alias("least"), F.max(key).alias("greatest"), F.count("*").alias("n_rows")
        )
    )


def range_summary(bounds: DataFrame) -> DataFrame:
    """Partitions, key range, rows, and how many partitions begin before the last one ended.

    `bounds` has one row per partition, which is what its single-task window runs over.
    """
    before = F.lag("greatest").over(Window.orderBy("part"))
    return bounds.withColumn("__before", before).agg(
        F.count("*").cast("int").alias("n_parts"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.sum("n_rows").alias("n_rows"),
        F.count_if(F.col("__before") >= F.col("least")).cast("int").alias("overlaps"),
    )


def widen(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    return df.repartition(partitions, *keys)


def narrow(df: DataFrame, partitions: int) -> DataFrame:
    return df.coalesce(partitions)


def times(df: DataFrame, value: Column | str, factor: int, to: str) -> DataFrame:
    value = F.col(value) if isinstance(value, str) else value
    return df.withColumn(to, value * factor)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    return checkpointed(df)


def id_range(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """All whole numbers between the least and greatest key, generated on the executors; none without keys."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return df.sparkSession.range(0)
    return df.sparkSession.range(low, high + 1, 1, partitions)
