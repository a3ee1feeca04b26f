"""Cogroup of two streams: both sides' values per key, held as keyed state and given out in chunks.

A key's values are cut into chunks as by `chunked_cogroup`, and each (key, chunk) has a state of its own: the
values with how often either side has brought them. So a hot key is spread over as many tasks as it has
chunks, and a state of whole numbers never holds more than the chunk's width. Equal values are counted
before the shuffle. A micro-batch gives out the chunks it has changed, each as it is then; the newest row of
every chunk is the cogroup of all that has arrived.

Cases: keys of one side only have an empty list on the other; a null key is a key and a null value a value
like any other; repeats count as copies; a batch without rows stores none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.operators.counts import chunk_of
from millrace.sinks.ledger import BATCH, RUN
from millrace.streaming.jobs import start, to_ledger

NAMES = ["key", "chunk", "value", "from_left"]
#: Distinct rows a task holds while it counts them before the shuffle.
HELD_ROWS = 1 << 13
STATE = "vals array<string>, l array<long>, r array<long>"


def counted_early(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a task counted, as many as it may hold at once."""
    held = None
    for batch in batches:
        table = pa.Table.from_arrays(batch.columns, names=NAMES + ["n"])
        held = table if held is None else pa.concat_tables([held, table])
        held = (
            held.group_by(NAMES).aggregate([("n", "sum")]).select([*NAMES, "n_sum"])
            .rename_columns([*NAMES, "n"])
        )
        if held.num_rows >= HELD_ROWS:
            yield from held.to_batches()
            held = None
    if held is not None:
        yield from held.to_batches()


def add_to_chunk(
    place: tuple, parts: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """Adds new values to the state of one (key, chunk) and gives out what it holds now."""
    known = {v: [l, r] for v, l, r in zip(*state.get)} if state.exists else {}
    for part in parts:
        for value, from_left, n in zip(part["value"], part["from_left"], part["n"]):
            known.setdefault(value, [0, 0])[0 if from_left else 1] += int(n)
    values = list(known)
    left, right = ([known[v][side] for v in values] for side in (0, 1))
    state.update((values, left, right))
    yield pd.DataFrame(
        {"key": [place[0]], "chunk": [place[1]], "vals": [values], "l": [left], "r": [right]}
    )


def _side(copies: str, as_type: str) -> Column:
    """The (value, copies) pairs of one side, in order of the values."""
    pairs = F.arrays_zip("vals", copies)
    typed = F.transform(pairs, lambda p: F.struct(p["vals"].cast(as_type).alias("v"), p[copies].alias("n")))
    return F.array_sort(F.filter(typed, lambda p: p["n"] > 0))


def cogrouped(
    left: DataFrame, right: DataFrame, key: str, value: str, chunk_width: int, hash_chunks: int = 1
) -> DataFrame:
    """The changed chunks of each micro-batch, with the columns of `chunked_cogroup`.

    `hash_chunks` cuts the values of a key that are no whole numbers; like the width of the state it is
    chosen for the data to come and fixed by the first start.
    """
    key_type, value_type = (left.schema[c].dataType.simpleString() for c in (key, value))
    tagged = left.select(key, value, F.lit(True).alias("from_left")).unionByName(
        right.select(key, value, F.lit(False).alias("from_left"))
    )
    # As text, so that neither a null nor a large number changes on its way through Python.
    plain = tagged.select(
        F.col(key).cast("string").alias("key"),
        chunk_of(tagged, value, chunk_width, hash_chunks).cast("string").alias("chunk"),
        F.col(value).cast("string").alias("value"),
        "from_left",
        F.lit(1).cast("long").alias("n"),
    )
    changed = (
        plain.mapInArrow(counted_early, plain.schema)
        .groupBy("key", "chunk")
        .applyInPandasWithState(
            add_to_chunk, f"key string, chunk string, {STATE}", STATE, "update", GroupStateTimeout.NoTimeout
        )
    )
    sides = changed.select(
        F.col("key").cast(key_type).alias(key), F.col("chunk").cast("long").alias("chunk"),
        _side("l", value_type).alias("l"), _side("r", value_type).alias("r"),
    )
    return sides.select(
        key, "chunk",
        *[
            F.col(f"{side}.{field}").alias(f"{name}_{to}")
            for side, name in (("l", "left"), ("r", "right"))
            for field, to in (("v", "values"), ("n", "copies"))
        ],
        *[
            F.aggregate(side, F.lit(0).cast("long"), lambda s, p: s + p["n"]).alias(f"{name}_rows")
            for side, name in (("l", "left"), ("r", "right"))
        ],
    )


def cogroup_stream(
    left: DataFrame, right: DataFrame, out: str, checkpoint: str, key: str, value: str, chunk_width: int,
    hash_chunks: int = 1, state_partitions: int | None = None,
) -> StreamingQuery:
    """Stores the changed chunks of each micro-batch under its key."""
    return start(
        cogrouped(left, right, key, value, chunk_width, hash_chunks), to_ledger(out), checkpoint, "update",
        skip_empty=False, state_partitions=state_partitions,
    )


def newest_chunks(stored: DataFrame, key: str) -> DataFrame:
    """The last row of every chunk: the cogroup of all batches of a run."""
    rest = [c for c in stored.columns if c not in (RUN, BATCH, key, "chunk")]
    last = stored.groupBy(RUN, key, "chunk").agg(F.max_by(F.struct(*rest), BATCH).alias("last"))
    return last.select(key, "chunk", "last.*")
