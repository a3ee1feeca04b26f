from collections import Counter, defaultdict

from pyspark.sql import functions as F

from millrace.operators.joins import chunked_cogroup
from millrace.sinks.ledger import read_batches
from millrace.streaming.cogroup import cogroup_stream, newest_chunks
from millrace.streaming.sources import table_files

SCHEMA = "k string, v long"
LEFT = [[("a", 1), ("a", 1), ("a", 700), (None, 5), ("b", 2**60 + 1)], [("a", 2), ("a", None)], [], [("b", 2**60 + 1)]]
RIGHT = [[("c", -1)], [("a", 1), ("a", None), ("a", None)], [(None, None)], []]


def plain(batches, width):
    """Copies per (key, chunk), side and value."""
    sides = defaultdict(lambda: (Counter(), Counter()))
    for side, rows in enumerate(batches):
        for k, v in rows:
            sides[k, None if v is None else v // width][side][v] += 1
    return dict(sides)


def found(rows):
    out = {}
    for r in rows:
        assert (r.k, r.chunk) not in out
        out[r.k, r.chunk] = (
            Counter(dict(zip(r.left_values, r.left_copies))), Counter(dict(zip(r.right_values, r.right_copies)))
        )
        assert (r.left_rows, r.right_rows) == (sum(r.left_copies), sum(r.right_copies))
        known = [v for v in r.left_values if v is not None]
        assert known == sorted(known)
    return out


def feed(spark, root, batches, schema, **kwargs):
    """Every batch in a run of its own over the same checkpoint, so each one restarts the query."""
    paths = [str(root / n) for n in ("left", "right")]
    out, checkpoint = str(root / "out"), str(root / "cp")
    for both in zip(*batches):
        for path, rows in zip(paths, both):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        types = spark.createDataFrame([], schema).schema
        streams = [table_files(spark, p, types) for p in paths]
        cogroup_stream(*streams, out, checkpoint, "k", "v", state_partitions=3, **kwargs).awaitTermination()
    return read_batches(spark, out)


def test_stream_holds_both_sides_over_batches_and_restarts(spark, tmp_path):
    stored = feed(spark, tmp_path, (LEFT, RIGHT), SCHEMA, chunk_width=512)
    sides = [[row for rows in batches for row in rows] for batches in (LEFT, RIGHT)]
    expected = plain(sides, 512)
    assert found(newest_chunks(stored, "k").collect()) == expected
    # The batch form says the same.
    left, right = (spark.createDataFrame(rows, SCHEMA) for rows in sides)
    assert found(chunked_cogroup(left, right, "k", "v", 512).collect()) == expected
    # A batch gives out only what it changed: the third one has a single row on the right.
    numbers = sorted(r[0] for r in stored.select("batch_id").distinct().collect())
    third = stored.filter(F.col("batch_id") == numbers[2]).collect()
    assert [(r.k, r.chunk, r.right_values, r.right_copies) for r in third] == [(None, None, [None], [1])]


def test_a_hot_key_is_spread_over_bounded_states(spark, tmp_path):
    hot = [("hot", n % 4000) for n in range(12_000)] + [("cold", 1)]
    stored = feed(spark, tmp_path, ([hot, hot], [[("hot", 3)] * 5000, []]), SCHEMA, chunk_width=256)
    last = newest_chunks(stored, "k").collect()
    assert found(last) == plain([hot + hot, [("hot", 3)] * 5000], 256)
    assert sum(r.k == "hot" for r in last) == -(-4000 // 256)
    assert max(len(r.left_values) for r in last) <= 256
    state = spark.read.format("statestore").load(str(tmp_path / "cp"))
    assert state.count() == len(last)


def test_streams_without_rows(spark, tmp_path):
    assert newest_chunks(feed(spark, tmp_path, ([[]], [[]]), SCHEMA, chunk_width=512), "k").collect() == []


def test_text_values_are_cut_by_digest(spark, tmp_path):
    rows = [("hot", f"w{n % 900}") for n in range(1800)] + [("hot", None), ("x", "")]
    stored = feed(spark, tmp_path, ([rows], [rows[:10]]), "k string, v string", chunk_width=1, hash_chunks=8)
    got = [Counter(), Counter()]
    sizes = []
    for r in newest_chunks(stored, "k").filter("k = 'hot'").collect():
        sizes.append(len(r.left_values))
        got[0].update(dict(zip(r.left_values, r.left_copies)))
        got[1].update(dict(zip(r.right_values, r.right_copies)))
    assert got == [Counter(v for k, v in some if k == "hot") for some in (rows, rows[:10])]
    assert len(sizes) == 8 and max(sizes) < 300
