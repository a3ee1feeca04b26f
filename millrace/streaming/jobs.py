"""Streaming jobs: per-batch counts, running totals, windows, joins, refreshed lookups."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.text import java_split, norm_null
from millrace.operators.counts import match_counts, value_count, words
from millrace.operators.joins import union_many
from millrace.operators.offsets import offset_ranges
from millrace.runtime import lookup_join, materialized, measured_bytes
from millrace.sinks.ledger import BATCH, BatchKey, put_batch

SHUFFLE_WIDTH = "spark.sql.shuffle.partitions"

BatchWork = Callable[[DataFrame, BatchKey], None]

_starting = threading.Lock()


def start(
    stream: DataFrame,
    work: BatchWork,
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    skip_empty: bool = True,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Run `work(batch, key)` per micro-batch. Offsets are committed after the work.

    `state_partitions` is the width of a stateful query: it is fixed by the first start and
    kept by the checkpoint, so choose it for the data to come, not for the first batch.
    """

    run: list[str] = []
    named = threading.Event()

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if skip_empty and batch.isEmpty():
            return
        named.wait()  # the first batch may come before the start has returned the query's id
        work(batch, BatchKey(run[0], batch_id))

    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    with _starting:  # the width is a setting of the session: one start at a time
        conf = stream.sparkSession.conf
        session_width = conf.get(SHUFFLE_WIDTH)
        try:
            if state_partitions is not None:
                conf.set(SHUFFLE_WIDTH, str(state_partitions))
            query = writer.start()
        finally:
            conf.set(SHUFFLE_WIDTH, session_width)
    run.append(query.id)
    named.set()
    return query


def to_ledger(out: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchWork:
    """Work that stores the shaped batch under its key, so a replay replaces it."""
    return lambda batch, key: put_batch(shape(batch), out, key)


def batch_word_count(lines: DataFrame, out: str, checkpoint: str, sep: str = " ") -> StreamingQuery:
    """Counts of each micro-batch on its own."""
    return start(
        lines, to_ledger(out, lambda b: value_count(words(b, sep=sep), "word")), checkpoint,
        skip_empty=False,
    )


def running_total(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    sep: str = " ",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Totals per word over all batches so far; each batch stores the words it changed.

    State lives in the state store and the checkpoint, so a restarted query goes on.
    """
    totals = value_count(words(lines, sep=sep), "word")
    return start(
        totals, to_ledger(out), checkpoint, mode="update", skip_empty=False,
        state_partitions=state_partitions,
    )


def union_word_count(
    streams: list[tuple[DataFrame, str]], out: str, checkpoint: str
) -> StreamingQuery:
    """Per-batch value counts of streams with different separators."""
    tokens = union_many([words(lines, sep=sep) for lines, sep in streams])
    return start(tokens, to_ledger(out, lambda b: value_count(b, "word")), checkpoint, skip_empty=False)


def window_sum(
    events: DataFrame,
    out: str,
    checkpoint: str,
    key: str,
    size: str,
    slide: str,
    ts: str = "ts",
    watermark: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Sliding-window counts over event time; each batch stores the windows it changed.

    The watermark bounds the state. It must exceed the disorder of the source, or late rows
    are dropped.
    """
    stream = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark is not None:
        stream = stream.withWatermark(ts, watermark)
    return start(
        windowed_count(stream, key, size, slide, ts), to_ledger(out), checkpoint, "update",
        skip_empty=False, state_partitions=state_partitions,
    )


def windowed_count(events: DataFrame, key: str, size: str, slide: str, ts: str = "ts") -> DataFrame:
    """Count per (sliding window, key); only windows with rows appear."""
    counted = events.groupBy(F.window(ts, size, slide), key).agg(F.count("*").alias("n"))
    return counted.select(
        F.col("window.start").alias("win_start"), F.col("window.end").alias("win_end"), key, "n"
    )


def batch_counts(events: DataFrame, key: str, batch: str, ts: str = "ts") -> DataFrame:
    """Count per (tumbling batch interval, key)."""
    counted = events.groupBy(F.window(ts, batch), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("batch_start"), key, "n")


def window_concat(batches: DataFrame, key: str, size: str, slide: str) -> DataFrame:
    """Per-batch counts repeated in every window that holds the batch; nothing is summed."""
    return batches.select(
        F.window("batch_start", size, slide).alias("w"), "batch_start", key, "n"
    ).select(F.col("w.start").alias("win_start"), "batch_start", key, "n")


def window_concat_stream(
    events: DataFrame, out: str, checkpoint: str, key: str, batch: str, size: str, slide: str,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running counts per (batch interval, key); each micro-batch stores those it changed.

    `window_concat` over the newest counts is the windowed view: nothing is summed over intervals.
    """
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return start(
        batch_counts(stamped, key, batch), to_ledger(out), checkpoint, "update", skip_empty=False,
        state_partitions=state_partitions,
    )


def code_name_join(
    tagged: DataFrame, out: str, checkpoint: str
) -> StreamingQuery:
    """Join of two inputs inside each micro-batch: code to name with code to count.

    `tagged` is the union of both streams: `kind` is `name` (line `code name`) or `code` (line
    of codes). One query carries both, so they share batches.
    """

    def join_batch(batch: DataFrame) -> DataFrame:
        fields = java_split("value", " ")
        names = (
            batch.filter(F.col("kind") == "name")
            .filter(F.size(fields) >= 2)
            .select(F.get(fields, F.lit(0)).alias("word"), F.get(fields, F.lit(1)).alias("name"))
        )
        counts = value_count(words(batch.filter(F.col("kind") == "code")), "word")
        return names.join(counts, "word").select(F.col("word").alias("code"), "name", "n")

    return start(tagged, to_ledger(out, join_batch), checkpoint, skip_empty=False)


def interval_join(
    names: DataFrame, codes: DataFrame, delay: str = "10 minutes"
) -> DataFrame:
    """Stream-stream join on code within a time range; watermarks bound both states.

    `names` has code, name, name_ts; `codes` has code, code_ts.
    """
    left = names.withWatermark("name_ts", delay)
    right = codes.withColumnRenamed("code", "__code").withWatermark("code_ts", delay)
    near = F.col("code_ts").between(
        F.col("name_ts") - F.expr(f"INTERVAL {delay}"), F.col("name_ts") + F.expr(f"INTERVAL {delay}")
    )
    return left.join(right, (F.col("code") == F.col("__code")) & near).drop("__code")


class RefreshedLookup:
    """A lookup read again once it is older than the interval; the whole map is replaced.

    Reading it takes a snapshot and its size, so the source's files may be replaced or removed
    at any time and are read once an interval.
    """

    def __init__(
        self,
        load: Callable[[SparkSession], DataFrame],
        interval_seconds: float = 10.0,
        clock: Callable[[], float] = time.time,
    ) -> None:
        self.load, self.interval, self.clock = load, interval_seconds, clock
        self.read_at: float | None = None
        self.frame: DataFrame | None = None
        self.size = 0

    def current(self, spark: SparkSession) -> tuple[DataFrame, int]:
        """The snapshot and its measured bytes."""
        now = self.clock()
        if self.frame is None or now - self.read_at >= self.interval:
            self.frame, self.read_at = materialized(self.load(spark), "lookup-snapshot"), now
            self.size = measured_bytes(self.frame)
        return self.frame, self.size


def lookup_stream(
    codes: DataFrame, lookup: RefreshedLookup, out: str, checkpoint: str
) -> StreamingQuery:
    """Names of streamed codes from a refreshed lookup, counted per batch, name and outcome.

    Batches are reduced to one row per code before the lookup.
    """

    def per_batch(batch: DataFrame) -> DataFrame:
        counted = value_count(batch.select(norm_null("code").alias("code")), "code")
        names, size = lookup.current(batch.sparkSession)
        return lookup_join(counted, names, ["code"], size=size)

    return start(codes, to_ledger(out, per_batch), checkpoint)


def lookup_counters(stored: DataFrame) -> DataFrame:
    """Codes with and without a name, per batch."""
    return match_counts(stored, F.col("name").isNotNull(), [BATCH])


def document_sink(lines: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """The first two words of a line as a document {course, tname}, stored as JSON per batch."""

    def store(batch: DataFrame, key: BatchKey) -> None:
        fields = java_split("value", " ")
        docs = batch.filter(F.size(fields) >= 2).select(
            F.get(fields, F.lit(0)).alias("course"), F.get(fields, F.lit(1)).alias("tname")
        )
        docs.write.mode("overwrite").json(f"{out}/{key.folder}")

    return start(lines, store, checkpoint)


def hourly_append(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    hour: Callable[[], str],
    writers: int | None = None,
) -> StreamingQuery:
    """Counts of each batch under run=id/batch_id=n/hour=yyyyMMddHH.

    The batch's folder is replaced as a whole, so a replay in a later hour leaves no copy. The
    number of files follows the size of the counts, unless `writers` fixes it.
    """

    def store(batch: DataFrame, key: BatchKey) -> None:
        counted = value_count(words(batch), "word")
        counted = counted.hint("rebalance") if writers is None else counted.repartition(writers)
        (
            counted.withColumn("hour", F.lit(hour()))
            .write.mode("overwrite")
            .partitionBy("hour")
            .parquet(f"{out}/{key.folder}")
        )

    return start(lines, store, checkpoint)


def offset_ledger(
    records: DataFrame, work: BatchWork, ledger: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Do the batch's work, then store its offset ranges: at least once, never ahead of the work."""

    def both(batch: DataFrame, key: BatchKey) -> None:
        work(batch, key)
        put_batch(offset_ranges(batch), ledger, key)

    return start(records, both, checkpoint, trigger=trigger)
