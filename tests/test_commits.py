"""Tables by commits, region builds, window sums with their inverse, totals from the state."""

import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.sinks import keyed
from millrace.sinks.commits import CommittedTable
from millrace.sinks.ledger import BatchKey
from millrace.streaming.sources import table_files
from millrace.streaming.windows import InverseWindow, HORIZON


def summing(spark, root, **more):
    merge = lambda rows, _: rows.groupBy("k").agg(F.sum("n").alias("n"))
    return CommittedTable(spark, root, merge, **more)


def rows_of(spark, **counts):
    return spark.createDataFrame([*counts.items()], "k string, n long")


def total(table):
    return {r.k: r.n for r in table.read().groupBy("k").agg(F.sum("n").alias("n")).collect()}


def test_replays_before_and_after_folding(spark, tmp_path):
    table = summing(spark, str(tmp_path / "t"), fold_after=3)
    assert table.read() is None
    for number in range(7):
        table.put(rows_of(spark, a=1, b=number), BatchKey("run", number))
        table.put(rows_of(spark, a=1, b=number), BatchKey("run", number))  # replayed at once
        assert len(table.latest().deltas) < 3
    for number in range(7):  # replayed when most are folded
        table.put(rows_of(spark, a=100), BatchKey("run", number))
    assert total(table) == {"a": 7, "b": 21}
    assert table.latest().folded == {"run": 5}


def test_two_writers_at_once_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "t")

    def write(run):
        table = summing(spark, root, fold_after=3)
        for number in range(5):
            table.put(rows_of(spark, **{"a": 1, run: 1}), BatchKey(run, number))

    threads = [threading.Thread(target=write, args=(r,)) for r in ("x", "y", "z")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    table = summing(spark, root)
    assert total(table) == {"a": 15, "x": 5, "y": 5, "z": 5}
    at = table.latest()
    assert len(at.deltas) <= 8 and sum(v + 1 for v in at.folded.values()) + len(at.deltas) == 15


def test_the_loser_of_a_commit_applies_its_change_again(spark, tmp_path):
    table = summing(spark, str(tmp_path / "t"))
    other = summing(spark, str(tmp_path / "t"))
    tried = []

    def change(now):
        if not tried:
            other.put(rows_of(spark, a=1), BatchKey("other", 0))
        tried.append(now.version)
        return keyed.Manifest(now.version, now.base, now.deltas, now.folded, {"mine": True}, now.schema)

    assert table.commit(change).note == {"mine": True}
    assert tried == [0, 1] and total(table) == {"a": 1}


def test_old_folders_go_after_the_grace(spark, tmp_path):
    now = [0.0]
    table = summing(spark, str(tmp_path / "t"), fold_after=2, keep_versions=2, grace=60, clock=lambda: now[0])
    for number in range(6):
        table.put(rows_of(spark, a=1), BatchKey("run", number))
    held = len([*(tmp_path / "t" / "data").iterdir()])
    import time

    now[0] = time.time() + 3600
    table.put(rows_of(spark, a=1), BatchKey("run", 6))
    assert len([*(tmp_path / "t" / "data").iterdir()]) < held
    assert total(table) == {"a": 7}
    assert len([p for p in (tmp_path / "t" / "_log").iterdir() if p.suffix == ".json"]) <= 2


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    rows = spark.range(1000).select(F.format_string("%05d", "id").alias("rowkey"))
    keyed.region_build(rows, ["00300"], table)
    broken = rows.withColumn("rowkey", F.when(F.col("rowkey") < "00900", F.col("rowkey")).otherwise(
        F.raise_error(F.lit("broken row"))))
    with pytest.raises(Exception, match="broken row"):
        keyed.region_build(broken, ["00500"], table)
    assert table.latest().note == {"splits": ["00300"]} and table.read().count() == 1000


def test_regions_are_cut_at_the_split_points(spark, tmp_path):
    keys = [f"{k:04d}" for k in range(0, 3000, 3)] + ["hot" + f"{k:05d}" for k in range(4000)] + [None, "0003"]
    rows = spark.createDataFrame([(k, "v") for k in keys], "rowkey string, cf string").repartition(5)
    splits = ["0003", "0600", "1", "hot", "zz"]
    table = CommittedTable(spark, str(tmp_path / "t"))
    keyed.region_build(rows, splits, table, tasks=8)
    want = {}
    for k in {k for k in keys if k is not None}:
        want.setdefault(sum(s <= k for s in splits), []).append(k)
    got = {r.region: r for r in keyed.region_bounds(table.read()).collect()}
    assert {r: (b.n, b.first_key, b.last_key, b.in_order) for r, b in got.items()} == {
        r: (len(ks), min(ks), max(ks), True) for r, ks in want.items()
    }
    hot_files = keyed.file_bounds(table.read()).filter("region = 4")
    assert hot_files.count() > 2  # a region with most of the rows is built by several tasks
    keyed.region_build(rows.limit(0), [], table)
    assert table.read().count() == 0
    with pytest.raises(ValueError):
        keyed.region_build(rows, ["b", "a"], table)


def plain_windows(events, slides):
    out = {}
    for slot, key in events:
        for w in range(slot, slot + slides):
            out[w, key] = out.get((w, key), 0) + 1
    return out


def stamped(spark, events):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(seconds=10 * s + 3), k) for s, k in events]
    return spark.createDataFrame(rows, "ts timestamp, k string")


def window_values(sums, spark):
    zero = int(datetime(2024, 1, 1).timestamp())
    out = {}
    for r in sums.totals().collect():
        assert (r.win_end - r.win_start).total_seconds() == sums.size
        out[int(r.win_end.timestamp() - zero) // 10 - 1, r.k] = r.n
    return out


def test_window_sums_restart_and_late_rows(spark, tmp_path):
    """Each batch is a query of its own over the same checkpoint; later batches hold earlier times."""
    source, root = str(tmp_path / "in"), str(tmp_path / "w")
    batches = [
        [(0, "a"), (1, "a"), (1, "b")], [(5, "a"), (6, "c")], [(0, "late"), (2, "a"), (5, "a")],
        [(40, "b"), (-3, "a")], [(38, "b"), (41, None), (39, "a")], [],
    ]
    for batch in batches:
        stamped(spark, batch).coalesce(1).write.mode("append").parquet(source)
        sums = InverseWindow(spark, root, "k", 30, 10, fold_after=2)
        stream = table_files(spark, source, stamped(spark, []).schema)
        sums.start(stream, str(tmp_path / "cp")).awaitTermination()
    sums.close()
    sums.close()
    want = plain_windows([e for b in batches for e in b], 3)
    assert window_values(sums, spark) == want


def test_window_batches_replayed_change_nothing(spark, tmp_path):
    sums = InverseWindow(spark, str(tmp_path / "w"), "k", 30, 10)
    events = [[(0, "a"), (4, "a")], [(5, "b"), (1, "a")]]
    for number in (0, 0, 1, 0, 1):
        sums.add(stamped(spark, events[number]), BatchKey("run", number))
    sums.close()
    assert window_values(sums, spark) == plain_windows(events[0] + events[1], 3)


def test_window_state_stays_bounded(spark, tmp_path):
    """New keys in every slide: keys whose windows are over leave the state."""
    sums = InverseWindow(spark, str(tmp_path / "w"), "k", 30, 10, fold_after=2)
    held = []
    for number in range(9):
        events = [(number, f"key{number}-{i}") for i in range(20)]
        sums.add(stamped(spark, events), BatchKey("run", number))
        held.append(sums.state.fold() and sums.state.read().count())
    assert sums.state.latest().note[HORIZON] > 0 and max(held) <= 20 * 2 * 4
    assert held[-1] <= max(held[3:6])


def test_windows_wait_for_the_delay(spark, tmp_path):
    sums = InverseWindow(spark, str(tmp_path / "w"), "k", 30, 10, delay=20)
    sums.add(stamped(spark, [(0, "a"), (4, "a")]), BatchKey("run", 0))
    assert window_values(sums, spark) == {(0, "a"): 1, (1, "a"): 1}
    with pytest.raises(ValueError):
        InverseWindow(spark, str(tmp_path / "x"), "k", 30, 20)


def test_totals_and_changes_from_the_state(spark, tmp_path):
    from millrace.streaming import jobs, state
    from millrace.streaming.sources import line_files

    source = tmp_path / "in"
    source.mkdir()
    checkpoint = str(tmp_path / "cp")
    assert state.last_batch(spark, checkpoint) is None
    for number, text in enumerate(("a a b", "b c", "c")):
        (source / f"{number}.txt").write_text(text + "\n")
        jobs.running_total(
            line_files(spark, str(source)), str(tmp_path / "out"), checkpoint, state_partitions=3
        ).awaitTermination()
    totals = {r.word: r.n for r in state.totals(spark, checkpoint, ["word"], {"n": 0}).collect()}
    assert totals == {"a": 2, "b": 2, "c": 2}
    last = state.last_batch(spark, checkpoint)
    changed = state.changed(spark, checkpoint, ["word"], {"n": 0}, last)
    assert [tuple(r) for r in changed.collect()] == [("c", 2)]
