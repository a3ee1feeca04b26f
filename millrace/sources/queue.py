"""Log-queue source and sink: option builders, payloads, routing columns.

The queue connector is an external package; everything here is plain options and columns, so
it is usable as soon as that package is on the class path.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import col_of

Offsets = Mapping[str, Mapping[int, int]]


def offsets_json(offsets: Offsets) -> str:
    """Offsets in the queue source's JSON form, partitions in order."""
    return json.dumps(
        {topic: {str(p): parts[p] for p in sorted(parts)} for topic, parts in sorted(offsets.items())}
    )


def _base(servers: str, group_prefix: str | None, min_partitions: int | None) -> dict[str, str]:
    given = {"kafka.bootstrap.servers": servers, "failOnDataLoss": "true"}
    if group_prefix:
        given["groupIdPrefix"] = group_prefix
    if min_partitions:
        given["minPartitions"] = str(min_partitions)
    return given


def subscribe_options(
    servers: str,
    topics: Iterable[str],
    starting: str = "latest",
    group_prefix: str | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Subscribe to topics, starting at `earliest` or `latest`."""
    if starting not in ("earliest", "latest"):
        raise ValueError("starting is earliest or latest; use offset_options for offsets")
    return _base(servers, group_prefix, min_partitions) | {
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }


def assign_options(
    servers: str, partitions: Mapping[str, Iterable[int]], starting: str = "latest"
) -> dict[str, str]:
    """Read assigned partitions; one source carries any number of them."""
    assigned = {topic: sorted(parts) for topic, parts in sorted(partitions.items())}
    return _base(servers, None, None) | {
        "assign": json.dumps(assigned),
        "startingOffsets": starting,
    }


def offset_options(servers: str, offsets: Offsets) -> dict[str, str]:
    """Read from explicit offsets, as recovered by `operators.offsets`."""
    assigned = {topic: sorted(parts) for topic, parts in sorted(offsets.items())}
    return _base(servers, None, None) | {
        "assign": json.dumps(assigned),
        "startingOffsets": offsets_json(offsets),
    }


def read_queue(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def decode_payload(
    records: DataFrame, schema: str | T.StructType, value: str = "value", to: str = "payload"
) -> DataFrame:
    """Decode JSON payloads to a struct; a null payload stays null."""
    return records.withColumn(to, F.from_json(F.col(value).cast("string"), schema))


def queue_records(
    df: DataFrame,
    key: Column | str | None = None,
    partition: Column | None = None,
    topic: str | None = None,
) -> DataFrame:
    """Shape rows for the queue sink: all columns as a JSON `value`, optional key and partition."""
    shaped = [F.to_json(F.struct(*df.columns)).alias("value")]
    if key is not None:
        shaped.insert(0, col_of(key).cast("string").alias("key"))
    if partition is not None:
        shaped.append(partition.cast("int").alias("partition"))
    if topic is not None:
        shaped.append(F.lit(topic).alias("topic"))
    return df.select(*shaped)


def write_queue(records: DataFrame, servers: str, topic: str) -> None:
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
