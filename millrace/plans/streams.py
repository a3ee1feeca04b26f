"""Queries of the streaming family. Each runs its stream to the end of the staged input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import suffix_route
from millrace.functions import keys as K
from millrace.operators.counts import lines_of
from millrace.operators.joins import union_many
from millrace.operators.offsets import as_mapping, reconcile, saved_offsets
from millrace.plans.inputs import (
    conversation_lines,
    event_lines,
    staged,
    staged_stream,
)
from millrace.plans.registry import query, table
from millrace.plans.tables import COGROUP_SQL, COGROUP_WIDTH, _tokens_sql, cogroup_columns, cogroup_sides
from millrace.runtime import materialized, scratch
from millrace.sinks.ledger import newest, read_batches, summed
from millrace.sources.files import read_dictionary
from millrace.sources.partition_log import append_log, read_log
from millrace.sources.queue import offsets_json
from millrace.streaming import jobs, state
from millrace.streaming.cogroup import cogroup_stream, newest_chunks
from millrace.streaming.sources import line_files, table_files
from millrace.streaming.windows import InverseWindow

STREAM_COUNT_SQL = f"""
WITH {_tokens_sql('conversations')}
SELECT word, count(*) AS n FROM tok GROUP BY word
"""


def _run(start, *args, **kwargs) -> None:
    start(*args, **kwargs).awaitTermination()


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    path, per_trigger = staged_stream(conversation_lines(spark, sf), "stream-lines")
    return line_files(spark, path, files_per_trigger=per_trigger)


def _out(spark: SparkSession, name: str) -> tuple[str, str]:
    return scratch(spark, name), scratch(spark, f"{name}-checkpoint")


def _batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = _out(spark, "batch-count")
    _run(jobs.batch_word_count, _lines(spark, sf), out, checkpoint)
    return read_batches(spark, out)


#: Batches of the streams whose batches have known content.
BUCKETS = 4


@query(
    "stream_batch_word_count",
    f"""
WITH lines AS (SELECT conv_id, unnest(string_split(text, chr(10))) AS line FROM conversations),
cut AS (SELECT conv_id, line, regexp_replace(line, ' +$', '') AS body FROM lines),
tok AS (SELECT conv_id, unnest(string_split(body, ' ')) AS word FROM cut WHERE body <> '' OR line = '')
SELECT CAST(conv_id % {BUCKETS} AS INTEGER) AS batch_id, word, count(*) AS n FROM tok GROUP BY 1, 2
""",
)
def stream_batch_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """A batch counts the conversations of one remainder of the id, which names it: their lines arrive
    and are read to the end before those of the next. Remainders of negative ids are negative, that
    of a null id is null; those without a text have no batch."""
    talks = table(spark, sf, "conversations").filter("text IS NOT NULL").withColumn(
        "rest", (F.col("conv_id") % BUCKETS).cast("int")
    )
    present = {r[0] for r in talks.select("rest").distinct().collect()}  # at most twice BUCKETS
    rests = [r for r in [*range(BUCKETS), *range(-1, -BUCKETS, -1), None] if r in present]
    if not rests:
        return spark.createDataFrame([], "batch_id int, word string, n long")
    path, (out, checkpoint) = scratch(spark, "batch-lines"), _out(spark, "batch-count")
    for r in rests:
        lines_of(talks.filter(F.col("rest").eqNullSafe(F.lit(r))), "text").write.mode("append").text(path)
        _run(jobs.batch_word_count, line_files(spark, path), out, checkpoint)
    name = F.get(F.array(*[F.lit(r).cast("int") for r in rests]), F.col("batch_id"))
    return read_batches(spark, out).select(name.alias("batch_id"), "word", "n")


@query("stream_word_count", STREAM_COUNT_SQL)
def stream_word_count(spark: SparkSession, sf: str) -> DataFrame:
    return summed(_batch_counts(spark, sf), ["word"], ["n"])


@query("stream_file_word_count", STREAM_COUNT_SQL)
def stream_file_word_count(spark: SparkSession, sf: str) -> DataFrame:
    path, per_trigger = staged_stream(conversation_lines(spark, sf), "stream-files")
    lines = line_files(spark, path, glob="*.txt", max_age="30d", files_per_trigger=per_trigger)
    out, checkpoint = _out(spark, "file-count")
    _run(jobs.batch_word_count, lines, out, checkpoint)
    return summed(read_batches(spark, out), ["word"], ["n"])


#: The running count is the first aggregate of the state.
RUNNING = (["word"], {"n": 0})


def _running(spark: SparkSession, sf: str) -> tuple[str, str]:
    out, checkpoint = _out(spark, "running")
    _run(jobs.running_total, _lines(spark, sf), out, checkpoint, state_partitions=_cores(spark))
    return out, checkpoint


@query("stream_running_total", STREAM_COUNT_SQL)
def stream_running_total(spark: SparkSession, sf: str) -> DataFrame:
    """Totals as the query's state has them: reading costs the same after any number of batches."""
    return state.totals(spark, _running(spark, sf)[1], *RUNNING)


@query(
    "stream_changed_keys",
    f"""
WITH {_tokens_sql('conversations')}
SELECT word, count(*) AS n, true AS grows FROM tok GROUP BY word
""",
)
def stream_changed_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Last value per key; `grows` holds when a key's value rose in every batch that names it."""
    changes = read_batches(spark, _running(spark, sf)[0])
    return changes.groupBy("word").agg(
        F.max_by("n", "batch_id").alias("n"),
        (F.countDistinct("n") == F.count("*")).alias("grows"),
    )


@query(
    "stream_changed_last",
    f"""
WITH lines AS (SELECT conv_id, unnest(string_split(text, chr(10))) AS line FROM conversations),
cut AS (SELECT conv_id, line, regexp_replace(line, ' +$', '') AS body FROM lines),
tok AS (SELECT conv_id, unnest(string_split(body, ' ')) AS word FROM cut WHERE body <> '' OR line = '')
SELECT word, count(*) AS n FROM tok GROUP BY word
HAVING bool_or(coalesce((conv_id % {BUCKETS} + {BUCKETS}) % {BUCKETS}, 0) = {BUCKETS} - 1)
""",
)
def stream_changed_last(spark: SparkSession, sf: str) -> DataFrame:
    """The keys that the last batch changed, with their totals, from the changes of the state.

    Conversations arrive by the remainder of their id, each in one batch; those without an id come with
    the first.
    """
    talks = table(spark, sf, "conversations").filter("text IS NOT NULL")
    path, (out, checkpoint) = scratch(spark, "changed-lines"), _out(spark, "changed")
    for k in range(BUCKETS):
        part = talks.filter(F.coalesce(F.pmod("conv_id", F.lit(BUCKETS)), F.lit(0)) == k)
        lines_of(part, "text").write.mode("append").text(path)
        _run(jobs.running_total, line_files(spark, path), out, checkpoint, state_partitions=_cores(spark))
    return state.changed(spark, checkpoint, *RUNNING, state.last_batch(spark, checkpoint))


@query(
    "stream_restart_total",
    f"""
WITH {_tokens_sql('conversations')}
SELECT word, 2 * count(*) AS n FROM tok GROUP BY word
""",
)
def stream_restart_total(spark: SparkSession, sf: str) -> DataFrame:
    """All lines arrive, the query ends; they arrive again, a new query resumes the totals."""
    lines = conversation_lines(spark, sf)
    path, per_trigger = staged_stream(lines, "restart")
    out, checkpoint = _out(spark, "restart-total")
    for round_ in range(2):
        if round_:
            lines.write.mode("append").text(path)
        stream = line_files(spark, path, files_per_trigger=per_trigger)
        _run(jobs.running_total, stream, out, checkpoint, state_partitions=_cores(spark))
    return state.totals(spark, checkpoint, *RUNNING)


BATCH, SIZE, SLIDE = "1 hour", "4 hours", "2 hours"


@query(
    "window_concat",
    """
WITH b AS (SELECT date_trunc('hour', ts) AS h, event_type, count(*) AS n FROM events GROUP BY 1, 2),
w AS (SELECT *, CAST(floor(epoch(h) / 7200) AS BIGINT) * 7200 AS s FROM b),
o AS (SELECT unnest([0, 7200]) AS back)
SELECT strftime(make_timestamp((s - back) * 1000000), '%Y-%m-%d %H:%M:%S') AS win_start,
       strftime(h, '%Y-%m-%d %H:%M:%S') AS batch_start, event_type, n
FROM w, o
""",
)
def window_concat(spark: SparkSession, sf: str) -> DataFrame:
    batches = jobs.batch_counts(table(spark, sf, "events"), "event_type", BATCH)
    windows = jobs.window_concat(batches, "event_type", SIZE, SLIDE)
    return windows.select(
        K.second_stamp("win_start").alias("win_start"),
        K.second_stamp("batch_start").alias("batch_start"),
        "event_type",
        "n",
    )


@query(
    "stream_window_concat",
    """
WITH b AS (SELECT date_trunc('hour', ts) AS h, event_type, count(*) AS n FROM events GROUP BY 1, 2),
w AS (SELECT *, CAST(floor(epoch(h) / 7200) AS BIGINT) * 7200 AS s FROM b),
o AS (SELECT unnest([0, 7200]) AS back)
SELECT strftime(make_timestamp((s - back) * 1000000), '%Y-%m-%d %H:%M:%S') AS win_start,
       strftime(h, '%Y-%m-%d %H:%M:%S') AS batch_start, event_type, n
FROM w, o
""",
)
def stream_window_concat(spark: SparkSession, sf: str) -> DataFrame:
    """The same windows over batch counts that a stream has kept up to date."""
    events = table(spark, sf, "events").select("ts", "event_type")
    path, per_trigger = staged_stream(events, "concat-events", "parquet")
    stream = table_files(spark, path, events.schema, per_trigger)
    out, checkpoint = _out(spark, "window-concat")
    _run(
        jobs.window_concat_stream, stream, out, checkpoint, "event_type", BATCH, SIZE, SLIDE,
        state_partitions=_cores(spark),
    )
    counts = newest(read_batches(spark, out), ["batch_start", "event_type"], ["n"])
    return jobs.window_concat(counts, "event_type", SIZE, SLIDE).select(
        K.second_stamp("win_start").alias("win_start"),
        K.second_stamp("batch_start").alias("batch_start"),
        "event_type",
        "n",
    )


WINDOW_SUM_SQL = """
WITH e AS (SELECT event_type, CAST(floor(epoch(ts) / 7200) AS BIGINT) * 7200 AS s FROM events),
o AS (SELECT unnest([0, 7200]) AS back)
SELECT strftime(make_timestamp((s - back) * 1000000), '%Y-%m-%d %H:%M:%S') AS win_start,
       strftime(make_timestamp((s - back + 14400) * 1000000), '%Y-%m-%d %H:%M:%S') AS win_end,
       event_type, count(*) AS n
FROM e, o GROUP BY 1, 2, 3
"""


def _stamped(windows: DataFrame) -> DataFrame:
    return windows.select(
        K.second_stamp("win_start").alias("win_start"),
        K.second_stamp("win_end").alias("win_end"),
        "event_type",
        "n",
    )


@query("window_sum", WINDOW_SUM_SQL)
def window_sum(spark: SparkSession, sf: str) -> DataFrame:
    return _stamped(jobs.windowed_count(table(spark, sf, "events"), "event_type", SIZE, SLIDE))


@query("stream_window_sum", WINDOW_SUM_SQL)
def stream_window_sum(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts from a stream whose files are not in time order.

    The input is finite, so no watermark drops rows that come late.
    """
    events = table(spark, sf, "events").select("ts", "event_type")
    path, per_trigger = staged_stream(events, "stream-events", "parquet")
    stream = table_files(spark, path, events.schema, per_trigger)
    out, checkpoint = _out(spark, "window-sum")
    _run(
        jobs.window_sum, stream, out, checkpoint, "event_type", SIZE, SLIDE,
        state_partitions=_cores(spark),
    )
    windows = newest(read_batches(spark, out), ["win_start", "win_end", "event_type"], ["n"])
    return _stamped(windows)


@query("stream_window_inverse", WINDOW_SUM_SQL)
def stream_window_inverse(spark: SparkSession, sf: str) -> DataFrame:
    """The same windows by adding the slide that enters and subtracting the one that leaves.

    Files are not in time order, so most batches bring rows of windows that are closed already.
    """
    events = table(spark, sf, "events").select("ts", "event_type")
    path, per_trigger = staged_stream(events, "inverse-events", "parquet")
    sums = InverseWindow(spark, scratch(spark, "window-inverse"), "event_type", 4 * 3600, 2 * 3600, fold_after=3)
    _run(sums.start, table_files(spark, path, events.schema, per_trigger), scratch(spark, "inverse-checkpoint"))
    sums.close()
    return _stamped(sums.totals())


@query(
    "stream_union_count",
    """
WITH t AS (
  SELECT event_type AS word FROM events UNION ALL SELECT CAST(user_id AS VARCHAR) FROM events
  UNION ALL SELECT event_type FROM events UNION ALL SELECT CAST(user_id AS VARCHAR) FROM events)
SELECT word, count(*) AS n FROM t GROUP BY word
""",
)
def stream_union_count(spark: SparkSession, sf: str) -> DataFrame:
    streams = []
    for sep in (" ", "&"):
        path, per_trigger = staged_stream(event_lines(spark, sf, sep), "union")
        streams.append((line_files(spark, path, files_per_trigger=per_trigger), sep))
    out, checkpoint = _out(spark, "union-count")
    _run(jobs.union_word_count, streams, out, checkpoint)
    return summed(read_batches(spark, out), ["word"], ["n"])


@query(
    "stream_code_name_join",
    """SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def stream_code_name_join(spark: SparkSession, sf: str) -> DataFrame:
    """Names and codes of a key arrive in the same batch; there are several batches."""
    names = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("key"),
        F.concat_ws(" ", F.col("n_nationkey").cast("string"), "n_name").alias("value"),
    )
    codes = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("key"), F.col("c_nationkey").cast("string").alias("value")
    )
    inputs = [(kind, df, scratch(spark, kind)) for kind, df in (("name", names), ("code", codes))]
    out, checkpoint = _out(spark, "code-name")
    for k in range(BUCKETS):
        for _, df, path in inputs:
            df.filter(F.pmod("key", F.lit(BUCKETS)) == k).select("value").write.mode("append").text(path)
        tagged = union_many(
            [line_files(spark, path).withColumn("kind", F.lit(kind)) for kind, _, path in inputs]
        )
        _run(jobs.code_name_join, tagged, out, checkpoint)
    return read_batches(spark, out).select("code", "name", "n")


@query("stream_cogroup", COGROUP_SQL)
def stream_cogroup(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides arrive in several files; a chunk is given out anew by each batch that changes it."""
    streams = []
    for name, side in zip(("left", "right"), cogroup_sides(spark, sf)):
        path, per_trigger = staged_stream(side, f"cogroup-{name}", "parquet")
        streams.append(table_files(spark, path, side.schema, per_trigger))
    out, checkpoint = _out(spark, "cogroup")
    _run(
        cogroup_stream, *streams, out, checkpoint, "nation", "id", COGROUP_WIDTH,
        state_partitions=_cores(spark),
    )
    return cogroup_columns(newest_chunks(read_batches(spark, out), "nation"))


@query(
    "stream_interval_join",
    """SELECT a.event_id AS first_id, b.event_id AS second_id
FROM events a JOIN events b ON a.user_id = b.user_id
 AND b.ts BETWEEN a.ts - INTERVAL 10 MINUTE AND a.ts + INTERVAL 10 MINUTE
WHERE a.event_type = 'click' AND b.event_type = 'view'""",
)
def stream_interval_join(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks with the views of the same user within ten minutes, over several batches.

    A stretch of time arrives in as many files as its scan has tasks and is read to the end before the
    next, so rows are never behind the watermark.
    """
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    sides = []
    for kind, id_name, ts_name, code in (
        ("click", "first_id", "name_ts", "code"), ("view", "second_id", "code_ts", "code"),
    ):
        rows = events.filter(F.col("event_type") == kind).select(
            F.col("user_id").cast("string").alias(code), F.col("event_id").alias(id_name),
            F.col("ts").alias(ts_name),
        )
        sides.append((rows.schema, _time_parts(rows, ts_name, BUCKETS), scratch(spark, f"interval-{kind}")))
    if not all(parts for _, parts, _ in sides):
        return events.select(F.col("event_id").alias("first_id"), F.col("event_id").alias("second_id")).limit(0)
    out, checkpoint = _out(spark, "interval-join")
    for k in range(BUCKETS):
        for _, parts, path in sides:
            parts[k].write.mode("append").parquet(path)
        joined = jobs.interval_join(*[table_files(spark, path, schema) for schema, _, path in sides])
        _run(jobs.start, joined.select("first_id", "second_id"), jobs.to_ledger(out), checkpoint,
             skip_empty=False, state_partitions=_cores(spark))
    return read_batches(spark, out).select("first_id", "second_id")


def _time_parts(rows: DataFrame, ts: str, parts: int) -> list[DataFrame]:
    """Rows cut into equal stretches of time, in order; none without a time."""
    low, high = rows.agg(F.min(F.unix_micros(ts)), F.max(F.unix_micros(ts))).first()
    if low is None:
        return []
    width = (high - low) // parts + 1
    place = F.floor((F.unix_micros(ts) - low) / width)
    return [rows.filter(place == k) for k in range(parts)]


@query(
    "stream_lookup_refresh",
    """SELECT CAST(c_nationkey AS VARCHAR) AS code, n_name AS name, count(*) AS n
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3 GROUP BY 1, 2""",
)
def stream_lookup_refresh(spark: SparkSession, sf: str) -> DataFrame:
    lookup_lines = (
        table(spark, sf, "nation")
        .filter(F.col("n_regionkey") < 3)
        .select(F.concat_ws("\t", F.col("n_nationkey").cast("string"), "n_name").alias("value"))
    )
    folder = staged(lookup_lines, "refreshed", "text")
    codes = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("code"))
    path, per_trigger = staged_stream(codes, "codes")
    stream = line_files(spark, path, files_per_trigger=per_trigger).withColumnRenamed("value", "code")
    lookup = jobs.RefreshedLookup(lambda s: read_dictionary(s, folder), interval_seconds=10.0)
    out, checkpoint = _out(spark, "lookup")
    _run(jobs.lookup_stream, stream, lookup, out, checkpoint)
    return summed(read_batches(spark, out), ["code", "name"], ["n"])


@query(
    "stream_doc_sink",
    "SELECT event_type AS course, CAST(user_id AS VARCHAR) AS tname FROM events",
)
def stream_doc_sink(spark: SparkSession, sf: str) -> DataFrame:
    path, per_trigger = staged_stream(event_lines(spark, sf), "courses")
    out, checkpoint = _out(spark, "documents")
    _run(jobs.document_sink, line_files(spark, path, files_per_trigger=per_trigger), out, checkpoint)
    return spark.read.schema("course STRING, tname STRING").json(out).select("course", "tname")


@query(
    "stream_hourly_append",
    f"""
WITH {_tokens_sql('conversations')}
SELECT 2024010100 AS hour, word, count(*) AS n FROM tok GROUP BY word
""",
)
def stream_hourly_append(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = _out(spark, "hourly")
    _run(jobs.hourly_append, _lines(spark, sf), out, checkpoint, hour=lambda: "2024010100")
    return summed(spark.read.parquet(out), ["hour", "word"], ["n"])


@query(
    "offset_ledger",
    """SELECT event_type AS topic, CAST(event_id % 2 AS INTEGER) AS partition, max(event_id) + 1 AS "offset"
FROM events GROUP BY 1, 2""",
)
def offset_ledger(spark: SparkSession, sf: str) -> DataFrame:
    records = table(spark, sf, "events").select(
        F.col("event_type").alias("topic"),
        suffix_route(K.prefixed_key("msg", "event_id")).alias("partition"),
        F.col("event_id").alias("offset"),
    )
    path, per_trigger = staged_stream(records, "records", "parquet")
    stream = table_files(spark, path, records.schema, per_trigger)
    ledger, checkpoint = _out(spark, "ledger")
    work = jobs.to_ledger(scratch(spark, "work"))
    _run(jobs.offset_ledger, stream, work, ledger, checkpoint)
    return saved_offsets(read_batches(spark, ledger))


#: Events of a log partition, and offsets of a segment.
LOG_EVENTS, LOG_SEGMENT = 5_000, 1_000


@query(
    "stream_log_offsets",
    f"""
WITH e AS (SELECT event_type AS topic, CAST(coalesce(floor(event_id / {LOG_EVENTS}), 0) AS INTEGER) AS partition FROM events),
c AS (SELECT topic, partition, count(*) AS n FROM e GROUP BY ALL),
s AS (SELECT *, CASE WHEN partition % 2 = 0 THEN n // 3 ELSE 0 END AS first_offset FROM c)
SELECT topic, partition, first_offset, n - 1 AS last_offset, n - first_offset AS n, n - first_offset AS n_offsets,
       n AS saved FROM s
""",
)
def stream_log_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """A log read from saved offsets, ended when it has read all, and gone on with when more has come.

    Even partitions have saved offsets, a third into what is there; the others start at their earliest. The
    second query takes over from the ledger that the first one has written.
    """
    events = table(spark, sf, "events")
    place = F.coalesce(F.floor(F.col("event_id") / LOG_EVENTS), F.lit(0)).cast("int")
    by_id = Window.partitionBy("topic", "partition").orderBy("event_id")  # at most LOG_EVENTS rows
    records = materialized(
        events.select(
            F.col("event_type").alias("topic"), place.alias("partition"), "event_id",
            F.col("user_id").cast("string").alias("key"), F.col("event_id").cast("string").alias("value"),
        ).withColumn("offset", (F.row_number().over(by_id) - 1).cast("long")).drop("event_id"),
        "log-records",
    )
    counts = records.groupBy("topic", "partition").agg(F.count("*").alias("n"))
    saved = counts.filter("partition % 2 = 0").select("topic", "partition", F.floor(F.col("n") / 3).alias("offset"))
    earliest = counts.select("topic", "partition", F.lit(0).cast("long").alias("offset"))
    starts = as_mapping(reconcile(saved, earliest))
    path, (out, checkpoint) = scratch(spark, "log"), _out(spark, "log-read")
    ledger = scratch(spark, "log-ledger")
    if not starts:
        return spark.createDataFrame([], "topic string, partition int, first_offset long, last_offset long, "
                                         "n long, n_offsets long, saved long")
    limit = max(1, records.count() // 3)
    for arriving in (F.col("offset") < LOG_SEGMENT // 2, F.col("offset") >= LOG_SEGMENT // 2):
        append_log(records.filter(arriving), path, LOG_SEGMENT)
        lines = read_log(
            spark, path, subscribe=",".join(starts), startingOffsets=offsets_json(starts),
            maxOffsetsPerTrigger=str(limit), segment=str(LOG_SEGMENT),
        )
        running = jobs.offset_ledger(lines, jobs.to_ledger(out), ledger, checkpoint, {"processingTime": "0 seconds"})
        running.processAllAvailable()
        running.stop()
        starts = as_mapping(saved_offsets(read_batches(spark, ledger)))
    read = read_batches(spark, out).groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count("*").alias("n"), F.countDistinct("offset").alias("n_offsets"),
    )
    reached = saved_offsets(read_batches(spark, ledger)).withColumnRenamed("offset", "saved")
    return read.join(reached, ["topic", "partition"])
