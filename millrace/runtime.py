"""Session helpers: shared scratch folder, reliable checkpoints, size-checked lookup joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
#: Salts of rows whose key is null: they match nothing and only have to be spread.
NULL_SALTS = 16

_local_base: str | None = None
_owners: list[str] = []


def shared_base(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary folder only for a local master."""
    global _local_base
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="millrace-", dir="/tmp")
    return _local_base


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, or under that of the owner at work."""
    base = _owners[-1] if _owners else f"{shared_base(spark)}/millrace"
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextmanager
def owned_scratch(spark: SparkSession, name: str = "owned") -> Iterator[str]:
    """A scratch folder for the work inside, removed with all it holds when the work ends.

    Results that are still needed then must have been written elsewhere.
    """
    folder = scratch(spark, name)
    _owners.append(folder)
    try:
        yield folder
    finally:
        _owners.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: written to the shared folder, so lost executors do not matter."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_base(spark)}/checkpoints")
    return df.checkpoint(eager=True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside go when the query ends, not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP_KEY, None)
    spark.conf.set(SHUFFLE_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_KEY)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_KEY, before)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: a stable, lineage-free table."""
    path = scratch(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan at least one task per core before CPU-heavy work.

    `scan` is a file scan without shuffles. Large inputs have more splits than cores and pass
    unchanged; only a scan of few splits is redistributed.
    """
    wanted = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= wanted else scan.repartition(wanted)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values, rendered as JSON; one small aggregate job."""
    row = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()
    return int(row["b"] or 0)


def hot_keys(big: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """Keys with more rows than an even partition holds, and how many partitions they would fill.

    Counting starts on the map side. There are fewer such keys than partitions.
    """
    counts = materialized(
        big.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("__n")), "key-counts"
    )
    rows = counts.agg(F.sum("__n")).first()[0] or 0
    even = max(1, rows // partitions)
    return counts.filter(F.col("__n") > even).select(
        *keys, F.ceil(F.col("__n") / even).cast("int").alias("__salts")
    )


def salted_join(
    big: DataFrame, lookup: DataFrame, keys: list[str], how: str, moved: bool = True
) -> DataFrame:
    """Join with both sides shuffled on (key, salt).

    Unless they are `moved` by all means, Spark may broadcast a lookup by the size of its files, which says
    little of its rows when values repeat.

    Hot keys are counted first. Only they are salted, over as many tasks as their share asks for,
    and only their lookup rows are repeated. The large side takes its salt from its map partition, so
    a re-run task produces the same salts again.
    """
    if how not in ("left", "inner"):
        raise ValueError("a salted join is a left or inner join")
    salt = "__salt"
    partitions = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(big, keys, partitions)  # fewer rows than partitions
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salts = F.coalesce("__salts", F.when(no_key, NULL_SALTS), F.lit(1))
    salted = big.join(F.broadcast(hot), keys, "left").withColumn(
        salt, F.pmod(F.spark_partition_id(), salts)
    )
    repeated = lookup.join(F.broadcast(hot), keys, "left").withColumn(
        salt, F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))
    )
    repeated = repeated.drop("__salts")
    return salted.drop("__salts").join(
        repeated.hint("merge") if moved else repeated, [*keys, salt], how
    ).drop(salt)


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Join a large table with a lookup of one row per key.

    The lookup is measured first, unless its `size` is known. Within the limit it is broadcast
    and the large side never moves; beyond the limit hot keys are salted.
    """
    if (measured_bytes(lookup) if size is None else size) <= limit_bytes:
        return big.join(F.broadcast(lookup), keys, how)
    return salted_join(big, lookup, keys, how)


def session(app: str = "millrace", **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; extra settings override."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
        "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
