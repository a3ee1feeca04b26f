import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from millrace import runtime
from millrace.operators import counts as C
from millrace.operators import joins as J
from millrace.operators import offsets as O
from millrace.operators import partitions as P
from millrace.operators import sorts as S
from millrace.sinks import files as sinks
from millrace.sinks import keyed, ledger
from millrace.sources import files, jdbc, queue


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def write(path, name, *texts):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(t + "\n" for t in texts), encoding="utf-8")


def test_word_count(spark):
    text = lines(spark, "aa bb cc", "aa bb bb aa")
    want = [("aa", 3), ("bb", 3), ("cc", 1)]
    assert bag(C.word_count(text)) == want
    two = C.word_count(text, reducers=2)
    assert bag(two) == want and two.rdd.getNumPartitions() == 2


def test_sum_by_word(spark):
    pairs = spark.createDataFrame([("aa", 1), ("bb", 2), ("aa", 3), ("bb", 4)], "word STRING, num INT")
    assert bag(C.sum_by_word(pairs)) == [("aa", 4), ("bb", 6)]


def test_membership(spark):
    ids = spark.range(1, 9)
    assert bag(C.in_list(ids, "id", [1, 5, 8])) == [(1,), (5,), (8,)]
    assert tuple(C.match_counts(ids, F.col("id").isin(1, 5, 8)).first()) == (3, 5)


def test_times_ten_after_checkpoint(spark):
    df = spark.createDataFrame([(v,) for v in (1, 3, 2, 4, 5, 6)], "v INT")
    assert bag(P.cut_lineage(P.times(df, "v", 10, "ten")).select("ten")) == [
        (10,), (20,), (30,), (40,), (50,), (60,)
    ]


def test_sum_count_mean(spark):
    df = spark.createDataFrame([(v,) for v in (23, 12, 48, 56, 45)], "v INT")
    assert tuple(C.sum_count_mean(df, "v").first()) == (184, 5, 36.8)


def test_range_partitions_do_not_overlap(spark):
    df = spark.createDataFrame([(k,) for k in (1, 5, 3, 7, 4, 9)], "k INT")
    bounds = sorted(P.range_bounds(df, "k", 2).collect(), key=lambda r: r["least"])
    assert sum(r["n_rows"] for r in bounds) == 6
    assert all(a["greatest"] < b["least"] for a, b in zip(bounds, bounds[1:]))


def test_distinct_counts_skip_nulls(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", "y")], "k STRING, v STRING")
    want = [("a", 1), ("b", 1)]
    assert bag(C.distinct_per_key(df, "k", "v")) == want
    assert bag(C.distinct_two_level(df, "k", "v")) == want


def test_secondary_sort_order(spark):
    text = lines(spark, "(a,2)", "(b,10)", "(b,-2147483648)", "(a,2147483647)", "no pair", "(b,10)")
    pairs = S.parse_pairs(text)
    want = [("b", -2147483648), ("b", 10), ("b", 10), ("a", 2), ("a", 2147483647)]
    assert [tuple(r) for r in S.secondary_sort(pairs).collect()] == want
    placed = S.with_positions(pairs, [F.col("word").desc(), F.col("num").asc()])
    assert [tuple(r)[:2] for r in placed.orderBy("position").collect()] == want
    assert sorted(r["position"] for r in placed.collect()) == [1, 2, 3, 4, 5]


def test_positions_with_hot_copies(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("v"))
    placed = S.with_positions(df, [F.col("v").asc()])
    got = [r["v"] for r in placed.orderBy("position").collect()]
    assert got == sorted(r["v"] for r in df.collect())


def test_chunks_hold_whole_groups(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), (F.col("id") % 100).alias("v"))
    chunks = C.chunked_lists(df, "k", "v", 16).collect()
    assert max(len(r["values"]) for r in chunks) == 16
    assert sorted(v for r in chunks for v in r["values"]) == list(range(100))
    assert sum(r["n_rows"] for r in chunks) == 1000


def test_cogroup_keeps_keys_of_both_sides(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k STRING, v INT")
    right = spark.createDataFrame([("b", 3), ("c", 4)], "k STRING, v INT")
    got = bag(J.chunked_cogroup(left, right, "k", "v", 100))
    assert got == [
        ("a", 0, [1], [2], [], [], 2, 0), ("b", 0, [2], [1], [3], [1], 1, 1), ("c", 0, [], [], [4], [1], 0, 1),
    ]


def test_lists_hold_every_repeat_of_any_type(spark):
    df = spark.createDataFrame([("k", v) for v in ["x", "x", "y", None, "x"]], "k STRING, v STRING")
    rows = C.chunked_lists(df, "k", "v", 1, hash_chunks=3).collect()
    held = sorted((v or "-") for r in rows for v, n in zip(r["values"], r["copies"]) for _ in range(n))
    assert held == ["-", "x", "x", "x", "y"]
    whole = C.chunked_lists(spark.createDataFrame([("k", 1), ("k", 1), ("k", 2)], "k STRING, v INT"), "k", "v", 9)
    assert bag(whole.select("values", "copies", "n_rows")) == [([1, 2], [2, 1], 3)]


def test_hot_keys_are_salted_by_their_share(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")).repartition(8)
    assert bag(runtime.hot_keys(big, ["k"], 8))[0][0] == 7
    lookup = spark.createDataFrame([(7, "hot"), (8, "cold")], "k LONG, name STRING")
    joined = runtime.salted_join(big, lookup, ["k"], "left")
    assert joined.count() == 3000
    assert bag(joined.groupBy("name").count().na.fill("-")) == [("-", 1998), ("cold", 1), ("hot", 1001)]


def test_owned_scratch_is_removed(spark):
    with runtime.owned_scratch(spark) as folder:
        path = runtime.scratch(spark, "inside")
        assert path.startswith(folder)
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))


def test_catalog_query_leaves_no_database(spark):
    before = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    queries()["catalog_table_group_having"](spark, "/root/testdata/sf0.001").collect()
    assert {r[0] for r in spark.sql("SHOW DATABASES").collect()} == before


@pytest.mark.parametrize("limit", [runtime.BROADCAST_LIMIT_BYTES, 0])
def test_map_join_is_the_same_with_and_without_broadcast(spark, limit):
    big = spark.createDataFrame(
        [(c,) for c in ["CN"] * 400 + ["US", "null", "", None, "XX"]], "country STRING"
    ).repartition(8)
    names = spark.createDataFrame([("CN", "China"), ("US", "America"), ("null", "never")], "code STRING, name STRING")
    joined = J.map_join(big, names, limit_bytes=limit)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (limit > 0) or "isFinalPlan=false" in plan
    assert joined.count() == 405
    assert J.matched_names(joined).count() == 401
    assert tuple(C.match_counts(joined, F.col("name").isNotNull()).first()) == (401, 4)


def test_dictionary_last_line_wins(spark, tmp_path):
    write(tmp_path / "d", "a.txt", "CN\told", "US\tAmerica", "broken", "CN\tChina")
    assert bag(files.read_dictionary(spark, str(tmp_path / "d"))) == [("CN", "China"), ("US", "America")]


def test_lookup_dir_needs_two_fields(spark, tmp_path):
    write(tmp_path / "l", "a.txt", "CN China", "US United States", "X")
    write(tmp_path / "l", "b.txt", "DE Germany")
    assert bag(files.read_lookup_dir(spark, str(tmp_path / "l"))) == [("CN", "China"), ("DE", "Germany")]


def test_rules_skip_copying_files_and_bad_lines(spark, tmp_path):
    rule = "h.com\t//html/body\ttrue\tmachine"
    write(tmp_path / "r", "a.txt", rule, rule, "h.com\t//p\tfalse\tman", "h.com\t//p\ttrue")
    write(tmp_path / "r", "b._COPYING_", "h.com\t//div\ttrue\tman")
    assert bag(files.read_rules(spark, str(tmp_path / "r"))) == [
        ("h.com", "//html/body", True, "machine"), ("h.com", "//p", False, "man"),
    ]


def test_app_install_nulls(spark, tmp_path):
    rows = [("1", "p", 5, 2, c, "g") for c in (None, "", "null", "CN")]
    spark.createDataFrame(rows, files.APP_INSTALL_DDL).write.orc(str(tmp_path / "o"))
    read = files.read_app_installs(spark, str(tmp_path / "o"))
    assert [f.dataType.simpleString() for f in read.schema] == ["string", "string", "bigint", "int", "string", "string"]
    assert sorted(r["country"] or "" for r in read.collect()) == ["", "", "", "CN"]


def test_read_lines_min_partitions(spark, tmp_path):
    write(tmp_path / "t", "a.txt", *[f"l{i}" for i in range(20)])
    read = files.read_lines(spark, str(tmp_path / "t"), min_partitions=5)
    assert read.rdd.getNumPartitions() >= 5 and read.count() == 20


def test_text_sinks_replace(spark, tmp_path):
    path = str(tmp_path / "out")
    for words in (["a", "b"], ["c"]):
        sinks.write_text(lines(spark, *words), path)
    assert bag(spark.read.text(path)) == [("c",)]
    frame = spark.createDataFrame([("CN", 3), ("US", 4)], "c STRING, n INT")
    sinks.write_tsv(frame, path)
    assert bag(spark.read.text(path)) == [("CN\t3",), ("US\t4",)]
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) <= 2
    sinks.write_orc(frame, path)
    assert any(f.endswith(".snappy.orc") for f in os.listdir(path))


def test_csv_has_header_and_delimiter(spark, tmp_path):
    path = tmp_path / "csv"
    sinks.write_csv(spark.createDataFrame([(1, "x")], "a INT, b STRING").coalesce(1), str(path))
    text = next(path.glob("part-*")).read_text()
    assert text == "a,b\n1,x\n"


def test_bulk_build_sorts_and_collapses(spark, tmp_path):
    rows = spark.createDataFrame([(f"spark_load_{n}",) for n in (1, 6, 3, 8, 3, 5, 8, 9)], "rowkey STRING")
    keyed.bulk_build(rows, str(tmp_path / "kv"), regions=2)
    got = [r[0] for r in keyed.open_table(spark, str(tmp_path / "kv")).collect()]
    assert sorted(got) == [f"spark_load_{n}" for n in (1, 3, 5, 6, 8, 9)]
    for part in (tmp_path / "kv").glob("part-*.parquet"):
        inside = [r[0] for r in spark.read.parquet(str(part)).collect()]
        assert inside == sorted(inside)


def test_range_scan_is_lexicographic_and_pushed(spark, tmp_path):
    rows = spark.createDataFrame([(f"k_{n}",) for n in range(10, 21)], "rowkey STRING")
    keyed.bulk_build(rows, str(tmp_path / "kv"))
    table = keyed.open_table(spark, str(tmp_path / "kv"))
    assert keyed.range_scan(table, "k_3", "k_7").count() == 0
    scan = keyed.range_scan(table, "k_11", "k_2")
    assert [r[0] for r in scan.orderBy("rowkey").collect()] == [f"k_{n}" for n in range(11, 20)]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rowkey,k_11)" in plan and "LessThan(rowkey,k_2)" in plan


def test_upsert_takes_greatest_version(spark):
    schema = "rowkey STRING, version LONG, v STRING"
    old = spark.createDataFrame([("a", 1, "x"), ("b", 5, "keep")], schema)
    new = spark.createDataFrame([("a", 2, "y"), ("b", 4, "late"), ("c", 1, None)], schema)
    assert bag(keyed.upsert(old, new)) == [("a", 2, "y"), ("b", 5, "keep"), ("c", 1, None)]


def test_one_writer_per_partition(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.range(0, 100, 1, 10).select(F.concat(F.lit("k_"), "id").alias("rowkey"))

    def open_writer():
        import os as os_
        import uuid

        class Writer:
            def __init__(self):
                self.rows = []

            def put(self, batch):
                self.rows += [[r["rowkey"], len(batch)] for r in batch]

            def close(self):
                with open(os_.path.join(folder, uuid.uuid4().hex), "w") as out:
                    import json as json_

                    json_.dump(self.rows, out)

        return Writer()

    keyed.put_partitions(rows, open_writer, batch_rows=20, partitions=2)
    written = [json.loads(p.read_text()) for p in tmp_path.iterdir()]
    assert len(written) == 2
    assert sorted(k for part in written for k, _ in part) == sorted(f"k_{i}" for i in range(100))
    assert max(n for part in written for _, n in part) == 20


def test_offsets_literals(spark):
    schema = "topic STRING, partition INT, offset LONG"
    saved = spark.createDataFrame([("t", 0, 5), ("t", 1, 50), ("t", 3, 7)], schema)
    earliest = spark.createDataFrame([("t", 0, 10), ("t", 1, 20), ("t", 2, 0)], schema)
    got = O.as_mapping(O.reconcile(saved, earliest))
    assert got == {"t": {0: 10, 1: 50, 2: 0, 3: 7}}
    options = queue.offset_options("b:9092", got)
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 10, "1": 50, "2": 0, "3": 7}}
    assert json.loads(options["assign"]) == {"t": [0, 1, 2, 3]}


def test_offset_ranges(spark):
    records = spark.createDataFrame([("t", 0, 5), ("t", 0, 9), ("t", 1, 2)], "topic STRING, partition INT, offset LONG")
    assert bag(O.offset_ranges(records)) == [("t", 0, 5, 10), ("t", 1, 2, 3)]


def test_queue_options():
    options = queue.subscribe_options("b:9092", ["x", "y"], "earliest", min_partitions=8)
    assert options["subscribe"] == "x,y" and options["startingOffsets"] == "earliest"
    assert options["minPartitions"] == "8"
    assert json.loads(queue.assign_options("b:9092", {"t": [2, 0]})["assign"]) == {"t": [0, 2]}
    with pytest.raises(ValueError):
        queue.subscribe_options("b:9092", ["x"], "5")


def test_payload_null_stays_null(spark):
    df = spark.createDataFrame([(b'{"msg":"m_1"}',), (None,)], "value BINARY")
    got = [r["payload"] for r in queue.decode_payload(df, "msg STRING").collect()]
    assert got[0]["msg"] == "m_1" and got[1] is None


def test_jdbc_options():
    table = jdbc.JdbcTable("jdbc:x", "student", user="u", partition_column="id", lower=0, upper=100, partitions=4)
    assert table.options() == {
        "url": "jdbc:x", "dbtable": "student", "user": "u", "fetchsize": "10000",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        jdbc.JdbcTable("jdbc:x", "t", partition_column="id").options()


def test_ledger_replay_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([("a", 2), ("b", 1)], "k STRING, n LONG")
    for number in (0, 1, 1):
        ledger.put_batch(rows, path, ledger.BatchKey("run", number))
    assert bag(ledger.summed(ledger.read_batches(spark, path), ["k"], ["n"])) == [("a", 4), ("b", 2)]


def test_top_k_ties_go_to_the_greater_member(spark):
    df = spark.createDataFrame([("h", f"xpath{i}", s) for i, s in ((1, 1), (2, 2), (3, 3), (4, 3))], "host STRING, xpath STRING, score INT")
    top = S.top_k_per_key(df, "host", [F.col("score").desc(), F.col("xpath").desc()], 2)
    assert [r["xpath"] for r in top.orderBy("rank").collect()] == ["xpath4", "xpath3"]


def test_scratch_uses_the_named_folder():
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: "/shared/x/"))
    assert runtime.scratch(named, "x").startswith("/shared/x/millrace/x-")
    unnamed = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="yarn"),
    )
    with pytest.raises(RuntimeError):
        runtime.scratch(unnamed, "x")


def test_positions_of_a_hot_row_come_from_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(S, "COPIES_AT_ONCE", 1000)
    df = spark.range(20_500).select(F.when(F.col("id") < 20_000, "m").when(F.col("id") % 2 == 0, "a").otherwise("z").alias("v"))
    placed = S.with_positions(df, [F.col("v").asc()])
    got = placed.groupBy("v").agg(F.min("position"), F.max("position"), F.countDistinct("position")).collect()
    assert sorted(map(tuple, got)) == [("a", 1, 250, 250), ("m", 251, 20_250, 20_000), ("z", 20_251, 20_500, 250)]
    assert placed.filter("v = 'm'").select(F.spark_partition_id()).distinct().count() > 1
