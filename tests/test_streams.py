import glob
import os
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from millrace.operators.counts import value_count, words
from millrace.plans import streams as plans
from millrace.sinks.ledger import BatchKey, folded, newest, put_batch, read_batches, summed
from millrace.streaming import jobs
from millrace.streaming.sources import line_files, table_files
from tests.oracle import connect, differences


def bag(df):
    return sorted(tuple(r) for r in df.collect())


class Folder:
    """A watched folder plus the output and checkpoint of one query."""

    def __init__(self, root):
        self.root = root
        (root / "in").mkdir()
        self.source, self.out, self.checkpoint = (str(root / n) for n in ("in", "out", "cp"))

    def add(self, name, *texts):
        (self.root / "in" / name).write_text("".join(t + "\n" for t in texts))


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path)


def test_changed_keys_and_restart(spark, folder):
    for name, text in (("1.txt", "a a b"), ("2.txt", "b")):
        folder.add(name, text)
        jobs.running_total(line_files(spark, folder.source), folder.out, folder.checkpoint).awaitTermination()
    stored = read_batches(spark, folder.out)
    first, second = sorted(r[0] for r in stored.select("batch_id").distinct().collect())
    assert bag(stored.filter(F.col("batch_id") == first).select("word", "n")) == [("a", 2), ("b", 1)]
    assert bag(stored.filter(F.col("batch_id") == second).select("word", "n")) == [("b", 2)]
    assert bag(newest(stored, ["word"], ["n"])) == [("a", 2), ("b", 2)]


def test_batch_counts_are_per_batch(spark, folder):
    folder.add("1.txt", "a a b")
    folder.add("2.txt", "b")
    lines = line_files(spark, folder.source, files_per_trigger=1)
    jobs.batch_word_count(lines, folder.out, folder.checkpoint).awaitTermination()
    stored = read_batches(spark, folder.out)
    assert bag(stored.select("word", "n")) == [("a", 2), ("b", 1), ("b", 1)]
    assert bag(summed(stored, ["word"], ["n"])) == [("a", 2), ("b", 2)]


def test_file_names_and_age(spark, folder):
    folder.add("1.txt", "a")
    folder.add("2.tmp", "b")
    lines = line_files(spark, folder.source, glob="*.txt")
    jobs.batch_word_count(lines, folder.out, folder.checkpoint).awaitTermination()
    assert bag(read_batches(spark, folder.out).select("word")) == [("a",)]


def test_new_files_only(spark, folder):
    folder.add("1.txt", "a")
    later = datetime(2100, 1, 1)
    lines = line_files(spark, folder.source, newer_than=later)
    seen = []
    jobs.start(lines, lambda b, i: seen.append(i), folder.checkpoint).awaitTermination()
    assert seen == []


def test_empty_batches_are_skipped(spark, folder):
    folder.add("1.txt", "a")
    folder.add("2.txt")
    seen = []
    lines = line_files(spark, folder.source, files_per_trigger=1)
    jobs.start(lines, lambda b, i: seen.append(b.count()), folder.checkpoint).awaitTermination()
    assert seen == [1]


def test_union_of_separators(spark, folder, tmp_path):
    folder.add("1.txt", "a b&c")
    streams = [(line_files(spark, folder.source), " "), (line_files(spark, folder.source), "&")]
    jobs.union_word_count(streams, folder.out, folder.checkpoint).awaitTermination()
    assert bag(read_batches(spark, folder.out).select("word", "n")) == [
        ("a", 1), ("a b", 1), ("b&c", 1), ("c", 1),
    ]


def test_code_name_join_inside_a_batch(spark, folder):
    folder.add("names.txt", "CN China", "US America more", "X")
    folder.add("codes.txt", "CN CN DE", "US")
    tagged = line_files(spark, folder.source).withColumn(
        "kind", F.when(F.contains(F.col("_metadata.file_name"), F.lit("names")), "name").otherwise("code")
    )
    jobs.code_name_join(tagged, folder.out, folder.checkpoint).awaitTermination()
    assert bag(read_batches(spark, folder.out).select("code", "name", "n")) == [
        ("CN", "China", 2), ("US", "America", 1),
    ]


def test_lookup_is_replaced_after_the_interval(spark, folder):
    now, version = [0.0], [{"CN": "old", "US": "America"}]

    def load(session):
        return session.createDataFrame(list(version[0].items()), "code STRING, name STRING")

    lookup = jobs.RefreshedLookup(load, interval_seconds=10, clock=lambda: now[0])
    for step, (moment, names) in enumerate([(0, None), (5, {"CN": "China"}), (10, None)]):
        now[0] = moment
        version[0] = names or version[0]
        folder.add(f"{step}.txt", "CN", "US", "CN")
        codes = line_files(spark, folder.source).withColumnRenamed("value", "code")
        jobs.lookup_stream(codes, lookup, folder.out, folder.checkpoint).awaitTermination()
    stored = read_batches(spark, folder.out)
    assert bag(stored.select("batch_id", "code", "name", "n").na.fill("-")) == [
        (0, "CN", "old", 2), (0, "US", "America", 1),
        (1, "CN", "old", 2), (1, "US", "America", 1),
        (2, "CN", "China", 2), (2, "US", "-", 1),
    ]
    assert bag(jobs.lookup_counters(stored)) == [(0, 2, 0), (1, 2, 0), (2, 1, 1)]


def test_hourly_append_of_two_checkpoints_adds(spark, folder):
    folder.add("1.txt", "a a")
    for checkpoint, hour in (("cp1", "2024010100"), ("cp2", "2024010101")):
        jobs.hourly_append(
            line_files(spark, folder.source), folder.out, str(folder.root / checkpoint), lambda: hour
        ).awaitTermination()
    assert bag(spark.read.parquet(folder.out).select("hour", "word", "n")) == [
        (2024010100, "a", 2), (2024010101, "a", 2),
    ]


def test_hourly_append_replay_in_a_later_hour(spark, folder):
    """A batch whose commit was lost runs again in a later hour and replaces its own rows."""
    folder.add("1.txt", "a a")
    for hour in ("2024010100", "2024010101"):
        jobs.hourly_append(
            line_files(spark, folder.source), folder.out, folder.checkpoint, lambda: hour
        ).awaitTermination()
        for commit in (folder.root / "cp" / "commits").iterdir():
            commit.unlink()
    assert bag(spark.read.parquet(folder.out).select("hour", "word", "n")) == [(2024010101, "a", 2)]


def test_old_file_that_arrives_late_is_read(spark, folder):
    for name, text, days in (("1.txt", "a", 0), ("2.txt", "b", 60)):
        folder.add(name, text)
        moment = time.time() - days * 86400
        os.utime(folder.root / "in" / name, (moment, moment))
        jobs.batch_word_count(line_files(spark, folder.source), folder.out, folder.checkpoint).awaitTermination()
    assert bag(read_batches(spark, folder.out).select("word")) == [("a",), ("b",)]


def test_lookup_files_replaced_inside_the_interval(spark, folder):
    loads = []

    def load(session):
        loads.append(1)
        return session.read.schema("code STRING, name STRING").csv(str(folder.root / "names"))

    lookup = jobs.RefreshedLookup(load, interval_seconds=1000)
    for step in range(2):
        names = folder.root / "names"
        names.mkdir(exist_ok=True)
        for old in names.iterdir():
            old.unlink()
        (names / f"{step}.csv").write_text(f"CN,China{step}\n")
        folder.add(f"{step}.txt", "CN")
        codes = line_files(spark, folder.source).withColumnRenamed("value", "code")
        jobs.lookup_stream(codes, lookup, folder.out, folder.checkpoint).awaitTermination()
    assert bag(read_batches(spark, folder.out).select("name")) == [("China0",), ("China0",)]
    assert len(loads) == 1


def test_window_sums_keep_rows_of_any_age(spark, tmp_path):
    for i, day in enumerate(("2024-06-01", "2024-04-12", "2024-04-02")):
        rows = spark.sql(f"SELECT TIMESTAMP_NTZ '{day} 00:30:00' AS ts, 'a' AS k FROM range(3)")
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = table_files(spark, str(tmp_path / "in"), rows.schema)
        jobs.window_sum(
            stream, str(tmp_path / "out"), str(tmp_path / "cp"), "k", "4 hours", "2 hours", state_partitions=2
        ).awaitTermination()
    windows = newest(read_batches(spark, str(tmp_path / "out")), ["win_start", "win_end", "k"], ["n"])
    assert windows.agg(F.count("*"), F.sum("n")).first() == (6, 18)


def test_folded_batches_keep_sums_and_replays(spark, tmp_path):
    path, base = str(tmp_path / "t"), str(tmp_path / "base")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, n LONG")
    for number in range(3):
        put_batch(rows, path, BatchKey("r", number))
    before = bag(summed(read_batches(spark, path), ["k"], ["n"]))
    old = read_batches(spark, path).filter("batch_id < 2")
    folded(old, ["k"], ["n"]).drop("run", "batch_id").write.parquet(f"{base}/run=r/batch_id=-1")
    read_batches(spark, path).filter("batch_id = 2").drop("run", "batch_id").write.parquet(f"{base}/run=r/batch_id=2")
    put_batch(rows, base, BatchKey("r", 2))
    assert bag(summed(read_batches(spark, base), ["k"], ["n"])) == before


def test_document_sink(spark, folder):
    folder.add("1.txt", "java liu", "spark wang extra", "alone")
    jobs.document_sink(line_files(spark, folder.source), folder.out, folder.checkpoint).awaitTermination()
    assert bag(spark.read.json(folder.out).select("course", "tname")) == [("java", "liu"), ("spark", "wang")]


def test_window_kinds(spark):
    at = [datetime(2024, 1, 1, 0, 0, s) for s in (1, 6, 6, 12)]
    events = spark.createDataFrame([(t, "a") for t in at], "ts TIMESTAMP_NTZ, word STRING")
    batches = jobs.batch_counts(events, "word", "5 seconds")
    concat = jobs.window_concat(batches, "word", "20 seconds", "10 seconds")
    # Batches at :00, :05 and :10; each one appears once per window that holds it.
    assert sorted(r["n"] for r in concat.collect()) == [1, 1, 1, 1, 2, 2]
    total = jobs.windowed_count(events, "word", "20 seconds", "10 seconds")
    assert sorted((str(r["win_start"])[-8:], r["n"]) for r in total.collect()) == [
        ("00:00:00", 4), ("00:00:10", 1), ("23:59:50", 3),
    ]


def test_interval_join_plan_has_two_bounded_states(spark, tmp_path):
    at = datetime(2024, 1, 1)
    names = spark.createDataFrame([("CN", "China", at)], "code STRING, name STRING, name_ts TIMESTAMP")
    codes = spark.createDataFrame([("CN", at), ("DE", at)], "code STRING, code_ts TIMESTAMP")
    paths = []
    for i, df in enumerate((names, codes)):
        df.write.parquet(str(tmp_path / f"s{i}"))
        paths.append((str(tmp_path / f"s{i}"), df.schema))
    streams = [table_files(spark, p, s) for p, s in paths]
    out = str(tmp_path / "out")
    joined = jobs.interval_join(*streams)
    jobs.start(joined, jobs.to_ledger(out), str(tmp_path / "cp"), skip_empty=False).awaitTermination()
    assert bag(read_batches(spark, out).select("code", "name")) == [("CN", "China")]


def test_offset_ledger_is_written_after_the_work(spark, tmp_path):
    records = spark.createDataFrame([("t", 0, 5), ("t", 0, 6)], "topic STRING, partition INT, offset LONG")
    records.write.parquet(str(tmp_path / "in"))
    stream = table_files(spark, str(tmp_path / "in"), records.schema)
    ledger = tmp_path / "ledger"

    def failing(batch, batch_id):
        raise RuntimeError("work failed")

    with pytest.raises(Exception):
        jobs.offset_ledger(stream, failing, str(ledger), str(tmp_path / "cp")).awaitTermination()
    assert not ledger.exists()
    done = []
    jobs.offset_ledger(stream, lambda b, i: done.append(i), str(ledger), str(tmp_path / "cp")).awaitTermination()
    assert [key.number for key in done] == [0]
    assert bag(read_batches(spark, str(ledger)).select("from_offset", "until_offset")) == [(5, 7)]


def test_stream_equals_batch(spark, folder):
    for i in range(4):
        folder.add(f"{i}.txt", f"w{i % 2} x", "x")
    lines = line_files(spark, folder.source, files_per_trigger=1)
    jobs.batch_word_count(lines, folder.out, folder.checkpoint).awaitTermination()
    batch = value_count(words(spark.read.text(folder.source)), "word")
    assert bag(summed(read_batches(spark, folder.out), ["word"], ["n"])) == bag(batch)


def check_query(spark, name, folder, **tables):
    """The query against its SQL over these tables."""
    folder = str(folder)
    for kind, columns in tables.items():
        pq.write_table(pa.table(columns), f"{folder}/{kind}.parquet")
    assert differences(spark, name, queries()[name], oracle_sql()[name], connect(folder), folder) is None


EVENTS = "event_id LONG, user_id LONG, event_type STRING, ts TIMESTAMP"


def test_interval_join_spreads_a_stretch_over_many_files(spark, tmp_path, monkeypatch):
    """Nearly all rows lie in the first stretch of time."""
    at = datetime(2024, 1, 1)
    rows = [(i, i % 5, ("click", "view")[i // 5 % 2], at + timedelta(seconds=37 * i)) for i in range(400)]
    rows += [(900, 1, "click", at + timedelta(days=9)), (901, 1, "view", at + timedelta(days=9, minutes=-5)),
             (902, None, "click", at), (903, 1, "view", None)]
    spark.createDataFrame(rows, EVENTS).repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    made = []
    monkeypatch.setattr(plans, "scratch", lambda s, name: made.append(str(tmp_path / name)) or made[-1])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "2k")
    try:
        out = queries()["stream_interval_join"](spark, str(tmp_path))
        got = bag(out)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    near = timedelta(minutes=10)
    assert got == sorted(
        (a[0], b[0]) for a in rows for b in rows
        if a[2] == "click" and b[2] == "view" and a[1] is not None and a[1] == b[1]
        and b[3] is not None and abs(a[3] - b[3]) <= near
    )
    for side in ("interval-click", "interval-view"):
        assert len(glob.glob(f"{tmp_path}/{side}/*.parquet")) > 2 * plans.BUCKETS


def test_interval_join_of_empty_table(spark, tmp_path):
    spark.createDataFrame([], EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    out = queries()["stream_interval_join"](spark, str(tmp_path))
    assert out.columns == ["first_id", "second_id"] and out.collect() == []


@pytest.mark.parametrize("ids", [[0, 1, 5, None, -1, -6, None, 3], [2, 2, -4, None, 6, 10, 7, 7]])
def test_batch_counts_of_null_and_negative_ids(spark, tmp_path, ids):
    texts = ["a b", "b\nc ", "", "a a", "d", "a", None, "e"]
    check_query(spark, "stream_batch_word_count", tmp_path, conversations={"conv_id": pa.array(ids, pa.int64()), "text": texts})


def test_code_name_join_of_negative_keys(spark, tmp_path):
    keys = [-3, -1, 0, 2, 5]
    check_query(
        spark, "stream_code_name_join", tmp_path,
        nation={"n_nationkey": pa.array(keys, pa.int64()), "n_name": [f"N{k}" for k in keys]},
        customer={"c_custkey": pa.array(range(7), pa.int64()), "c_nationkey": pa.array([-3, -3, -1, 2, 5, None, 9], pa.int64())},
    )
