"""What a stateful query knows now, read from its checkpoint by the state data source.

The state store keeps a snapshot and the changes since, so reading it costs as much as the keys it
holds, however many batches have run. Nothing else has to be stored by the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def last_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """Number of the last finished batch, by the checkpoint's commits."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    names = [s.getPath().getName() for s in files.listStatus(path)]
    return max((int(n) for n in names if n.isdigit()), default=None)


def totals(spark: SparkSession, checkpoint: str, keys: list[str], counters: dict[str, int]) -> DataFrame:
    """The grouping keys and the running counters (name to place among the aggregates) of all keys."""
    state = spark.read.format("statestore").load(checkpoint)
    return _columns(state, keys, counters)


def changed(
    spark: SparkSession, checkpoint: str, keys: list[str], counters: dict[str, int], batch: int
) -> DataFrame:
    """The same for the keys that one batch has changed, with the values it left."""
    feed = (
        spark.read.format("statestore")
        .option("readChangeFeed", "true")
        .option("changeStartBatchId", batch)
        .option("changeEndBatchId", batch)
        .load(checkpoint)
    )
    return _columns(feed.filter(F.col("change_type") == "update"), keys, counters)


def _columns(state: DataFrame, keys: list[str], counters: dict[str, int]) -> DataFrame:
    values = state.schema["value"].dataType.names
    named = state.schema["key"].dataType.names
    return state.select(
        *[F.col(f"key.`{k}`").alias(name) for k, name in zip(named, keys)],
        *[F.col(f"value.`{values[at]}`").alias(name) for name, at in counters.items()],
    )
