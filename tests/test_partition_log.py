"""The partition log as a stream: subscribe, assign, starts, limits, restarts."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.sources.partition_log import LogReader, append_log, read_log


def records(spark, n, parts=2, first=0):
    rows = [("a" if p % 2 else "b", p, o, None, f"{p}-{o}") for p in range(parts) for o in range(first, n)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string")


def drained(spark, log, root, **options):
    out, cp = str(root / "out"), str(root / "cp")
    query = (
        read_log(spark, log, segment="10", **options).writeStream.format("parquet")
        .option("checkpointLocation", cp).trigger(processingTime="0 seconds").start(out)
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return sorted((r.topic, r.partition, r.offset) for r in spark.read.parquet(out).collect()), query


def test_reads_all_goes_on_and_repeats_nothing(spark, tmp_path):
    log = str(tmp_path / "log")
    append_log(records(spark, 25), log, 10)
    got, query = drained(spark, log, tmp_path, subscribe="a,b", maxOffsetsPerTrigger="20")
    assert got == sorted((t, p, o) for t, p in (("b", 0), ("a", 1)) for o in range(25))
    assert all(p["numInputRows"] <= 20 for p in query.recentProgress)
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) >= 3
    append_log(records(spark, 32, first=25), log, 10)
    append_log(records(spark, 7, parts=3).filter("partition = 2"), log, 10)  # a partition that comes later
    got, _ = drained(spark, log, tmp_path, subscribe="a,b", maxOffsetsPerTrigger="9")
    assert got == sorted(
        [(t, p, o) for t, p in (("b", 0), ("a", 1)) for o in range(32)] + [("b", 2, o) for o in range(7)]
    )


def test_given_offsets_and_assigned_partitions(spark, tmp_path):
    log = str(tmp_path / "log")
    append_log(records(spark, 25, parts=4), log, 10)
    got, _ = drained(
        spark, log, tmp_path, assign=json.dumps({"a": [1], "b": [2]}), startingOffsets=json.dumps({"b": {"2": 17}})
    )
    assert got == [("a", 1, o) for o in range(25)] + [("b", 2, o) for o in range(17, 25)]


def test_latest_start_reads_what_comes_later(spark, tmp_path):
    log = str(tmp_path / "log")
    append_log(records(spark, 5), log, 10)
    options = {"path": log, "subscribe": "a,b", "startingOffsets": "latest", "segment": "10"}
    assert LogReader(options).initialOffset() == {"a": {"1": 5}, "b": {"0": 5}}


def test_lost_records_and_wrong_options_are_errors(spark, tmp_path):
    log = str(tmp_path / "log")
    append_log(records(spark, 12, parts=1).filter("offset <> 3"), log, 10)
    with pytest.raises(Exception, match="records in offsets"):
        drained(spark, log, tmp_path, subscribe="b")
    with pytest.raises(ValueError):
        LogReader({"path": log})
    reader = LogReader({"path": log, "subscribe": "b", "segment": "10"})
    with pytest.raises(RuntimeError, match="before offset"):
        reader.partitions({"b": {"0": 9}}, {"b": {"0": 4}})


def test_an_empty_log(spark, tmp_path):
    log = str(tmp_path / "log")
    (tmp_path / "log").mkdir()
    reader = LogReader({"path": log, "subscribe": "a"})
    assert reader.latestOffset() == {"a": {}} and reader.partitions({"a": {}}, {"a": {}}) == []
    assert read_log(spark, log, subscribe="a").columns == ["topic", "partition", "offset", "key", "value"]
    assert records(spark, 1).filter(F.col("offset") > 5).count() == 0


def test_files_and_tasks_follow_the_records_not_the_partitions(spark, tmp_path):
    """A log of many small partitions is a few files, read by a few tasks."""
    log = str(tmp_path / "log")
    rows = spark.range(6_000).select(
        F.lit("a").alias("topic"), (F.col("id") % 600).cast("int").alias("partition"),
        F.floor(F.col("id") / 600).alias("offset"), F.lit(None).cast("string").alias("key"),
        F.col("id").cast("string").alias("value"),
    )
    append_log(rows, log, 10)
    assert len(list((tmp_path / "log").rglob("*.parquet"))) <= 20
    reader = LogReader({"path": log, "subscribe": "a", "segment": "10"})
    assert len(reader.partitions(reader.initialOffset(), reader.latestOffset())) == 1
    got, _ = drained(spark, log, tmp_path, subscribe="a", startingOffsets=json.dumps({"a": {"7": 9}}))
    assert len(got) == 6_000 - 9 and ("a", 7, 9) in got and ("a", 7, 8) not in got


def test_an_append_is_seen_when_its_index_is_whole(spark, tmp_path):
    log = str(tmp_path / "log")
    append_log(records(spark, 5, parts=1), log, 10)
    reader = LogReader({"path": log, "subscribe": "b", "segment": "10"})
    append_log(records(spark, 9, parts=1, first=5), log, 10)
    (mark,) = [f for f in (tmp_path / "log" / "index").glob("*/_SUCCESS")
               if f.stat().st_mtime == max(g.stat().st_mtime for g in (tmp_path / "log" / "index").glob("*/_SUCCESS"))]
    kept = mark.read_bytes()
    mark.unlink()
    assert reader.latestOffset() == {"b": {"0": 5}}
    mark.write_bytes(kept)
    assert reader.latestOffset() == {"b": {"0": 9}}
