"""Exact dedup as a stream with keyed state.

Rows arrive in micro-batches as (digest, id, locator). State, kept on disk by the state store and
never expired, holds per digest the row that stays, its locator and the number of rows so far.
Digests that are hit again get a check of the full bytes: the smallest and the largest text of a
digest are equal only if all are. Should a digest hold different texts, its rows are grouped by
the text itself, so no result rests on a digest alone.

Texts are equal when identical after `normalise` (by default nothing changes); of equal texts the
row with the largest id stays. Texts are never moved but for the check, where they are reduced
before the shuffle.

Cases: a null text counts as empty, and empty texts are equal; a null id is below all others;
of rows with equal id and text one stays; repeated rows count each; an empty table gives an
empty result; other columns of the input are not read; a text of any length is digested whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.runtime import freed_shuffles, lookup_join, materialized, owned_scratch, scratch

#: Micro-batches that a stored table is replayed in.
BATCHES = 4
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

TextRule = Callable[[Column], Column]


def unchanged(text: Column) -> Column:
    return text


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def stream_session(spark: SparkSession, width: int | None) -> SparkSession:
    """A session of its own for the state settings; the caller's session stays as it is."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # Many small stores: no space set aside for each, and changes instead of whole snapshots.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.shuffle.partitions", width or spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def keeper_state(arrivals: DataFrame) -> DataFrame:
    """Per digest the row that stays (largest id, then smallest locator) and the rows so far."""
    best = F.max(F.struct("key", (-F.col("locator")).alias("back")))
    return arrivals.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))


def run_stream(
    spark: SparkSession, arrivals: str, schema, out: str, checkpoint: str,
    files_per_batch: int, width: int | None = None,
) -> None:
    """Feed the files of folder `arrivals` through the state; changed keys go to `out` by batch.

    A batch that is replayed after a failure replaces its own folder. More files may be added to
    the folder and the call repeated with the same checkpoint: state goes on where it was.
    """
    own = stream_session(spark, width)
    stream = (
        own.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(arrivals)
    )

    def store(changed: DataFrame, batch_id: int) -> None:
        changed.select(
            "digest", F.col("best.key").alias("key"), (-F.col("best.back")).alias("locator"),
            "group_size",
        ).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (
        keeper_state(stream)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .queryName(f"dedup-{uuid.uuid4().hex}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_state(spark: SparkSession, out: str) -> DataFrame:
    """The last stored row of every digest."""
    stored = spark.read.parquet(out)
    last = F.max_by(F.struct("key", "locator", "group_size"), "batch").alias("last")
    return stored.groupBy("digest").agg(last).select("digest", "last.*")


def dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalise: TextRule = unchanged,
    digest: TextRule = sha256,
    width: int | None = None,
) -> DataFrame:
    """One row per document: `key`, keep_id, group_size, kept and text_sha256."""
    spark = docs.sparkSession
    content = normalise(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    read = docs.select(F.col(f"`{key}`").alias("key"), content.alias("text"))
    parts = {"digest": digest(F.col("text")), "text_sha256": sha256(F.col("text"))}
    if digest is sha256:
        parts.pop("text_sha256")
    folder = scratch(spark, "dedup")
    arrivals = f"{folder}/arrivals"
    read.select(
        F.monotonically_increasing_id().alias("locator"), "key",
        *[c.alias(n) for n, c in parts.items()],
    ).write.parquet(arrivals)
    stored = spark.read.parquet(arrivals)
    files = len(stored.inputFiles())
    if not files or stored.isEmpty():
        return shaped(stored.withColumns(
            {"keep_id": F.col("key"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
        ), key)
    run_stream(
        spark, arrivals, stored.schema, f"{folder}/state", f"{folder}/checkpoint",
        -(-files // BATCHES), width,
    )
    latest = latest_state(spark, f"{folder}/state")
    groups = materialized(latest, "dedup-groups")
    hits = groups.filter("group_size > 1").select(
        "digest", F.col("key").alias("keep_id"), F.col("locator").alias("keeper"), "group_size"
    )
    differing = differing_digests(read, hits, digest)
    judged = judge(stored, groups.filter("group_size = 1").select("digest"), hits)
    if differing is not None:
        judged = judged.join(differing, "digest", "left_anti").unionByName(
            by_text(read, differing, digest), allowMissingColumns=True
        )
    return shaped(judged, key)


def judge(stored: DataFrame, single: DataFrame, hits: DataFrame) -> DataFrame:
    """Every arrival with its group; rows that share no digest stay."""
    found = lookup_join(stored, hits, ["digest"], "left")
    alone = F.col("group_size").isNull()
    return found.withColumns(
        {
            "keep_id": F.when(alone, F.col("key")).otherwise(F.col("keep_id")),
            "kept": alone | (F.col("locator") == F.col("keeper")),
            "group_size": F.coalesce("group_size", F.lit(1).cast("long")),
        }
    )


def differing_digests(read: DataFrame, hits: DataFrame, digest: TextRule) -> DataFrame | None:
    """Digests with different texts, by their full bytes; None when there are none."""
    again = lookup_join(
        read.select("text", digest(F.col("text")).alias("digest")), hits.select("digest"),
        ["digest"], "inner",
    )
    bounds = again.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    differing = materialized(bounds.filter("low != high").select("digest"), "dedup-differing")
    return None if differing.isEmpty() else differing


def by_text(read: DataFrame, differing: DataFrame, digest: TextRule) -> DataFrame:
    """Rows of digests with different texts, grouped by the text itself."""
    rows = materialized(
        lookup_join(read.withColumn("digest", digest(F.col("text"))), differing, ["digest"], "inner")
        .withColumn("locator", F.monotonically_increasing_id()),
        "dedup-collided",
    )
    best = F.max(F.struct("key", (-F.col("locator")).alias("back"))).alias("best")
    groups = rows.groupBy("text").agg(best, F.count("*").alias("group_size"))
    return rows.join(groups, "text").select(
        "digest", "locator", "key", sha256(F.col("text")).alias("text_sha256"),
        F.col("best.key").alias("keep_id"), "group_size",
        (F.col("locator") == -F.col("best.back")).alias("kept"),
    )


def shaped(judged: DataFrame, key: str) -> DataFrame:
    named = "text_sha256" if "text_sha256" in judged.columns else "digest"
    return judged.select(
        F.col("key").alias(key), "keep_id", "group_size", "kept", F.col(named).alias("text_sha256")
    )


def survivors(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int | None = None
) -> DataFrame:
    """The documents that stay, with their columns.

    Only dropped rows are looked up, by id and digest. Of rows equal in both, dropped by count, the
    surplus goes: one of them stays when the group keeps that id.
    """
    spark, path = docs.sparkSession, scratch(docs.sparkSession, "dedup-repeated")
    with owned_scratch(spark, "dedup"):  # the stream's tables and state go with it
        judged = materialized(dedup(docs, key, text, width=width), "dedup-judged")
        listed = (
            judged.groupBy(key, "text_sha256")
            .agg(F.count("*").alias("rows"), F.max("kept").alias("any_kept"))
            .filter("rows > 1 OR NOT any_kept")
            .select(
                F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__id"),
                F.col(key).isNull().alias("__null"),
                F.col("text_sha256").alias("__sha"), "any_kept",
            )
        )
        with freed_shuffles(spark):
            listed.write.parquet(path)
    repeated = spark.read.schema(listed.schema).parquet(path)
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("__id"),
        F.col(f"`{key}`").isNull().alias("__null"),
        sha256(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("__sha"),
    )
    found = lookup_join(marked, repeated, ["__id", "__null", "__sha"], "left")
    once = found.filter("any_kept").groupBy("__id", "__null", "__sha").agg(
        F.first("__row").alias("__row")
    )
    return found.filter("any_kept IS NULL").select("__row.*").unionByName(once.select("__row.*"))
