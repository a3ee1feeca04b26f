"""Additive tables that stay right under replays: rows are kept per batch and summed on read."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN, BATCH = "run", "batch_id"


class BatchKey(NamedTuple):
    """What names a batch: the run it belongs to and its number in that run.

    The run of a stream is its query id, which is kept with the checkpoint: a replayed batch has
    the same key again, while a new checkpoint or another query writes beside what is there.
    """

    run: str
    number: int

    @property
    def folder(self) -> str:
        return f"{RUN}={self.run}/{BATCH}={self.number}"


def put_batch(df: DataFrame, path: str, key: BatchKey) -> None:
    """Store a batch's rows in its own folder; a replay of the batch replaces them."""
    df.write.mode("overwrite").parquet(f"{path}/{key.folder}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def summed(table: DataFrame, keys: list[str], counters: list[str]) -> DataFrame:
    """Counters per key over all batches."""
    return table.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])


def newest(table: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Running values per key: those of the latest batch that touched it, summed over runs."""
    last = table.groupBy(RUN, *keys).agg(F.max_by(F.struct(*values), BATCH).alias("v"))
    return last.groupBy(*keys).agg(*[F.sum(f"v.{v}").alias(v) for v in values])


def folded(table: DataFrame, keys: list[str], counters: list[str]) -> DataFrame:
    """Finished batches of additive counters as one base batch (number -1) per run.

    Store it under the base's key, then drop the folded batches: sums stay what they were, and
    a replay of a later batch still replaces only its own rows.
    """
    return table.groupBy(RUN, *keys).agg(*[F.sum(c).alias(c) for c in counters]).withColumn(
        BATCH, F.lit(-1)
    )


def append_jdbc_batch(
    report: DataFrame, key: BatchKey, url: str, table: str, properties: dict[str, str]
) -> None:
    """Append a batch's counters with its key to a staging table of an external database.

    A replay appends the same key again: read the table with one row per key and counter row.
    """
    named = report.withColumns({RUN: F.lit(key.run), BATCH: F.lit(key.number)})
    named.write.mode("append").jdbc(url, table, properties=properties)
