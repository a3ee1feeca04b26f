"""Keyed tables: versioned upsert, per-partition writer, range scan, sorted bulk build."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterable

from pyarrow.fs import FileSystem
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from millrace.sinks.commits import CommittedTable, Manifest

# Writers travel inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY, VERSION, REGION = "rowkey", "version", "region"


def upsert(table: DataFrame, puts: DataFrame) -> DataFrame:
    """The table after the puts: per key the row with the greatest version."""
    return latest(table.unionByName(puts))


def latest(rows: DataFrame) -> DataFrame:
    """One row per key. `max_by` keeps a running best, so hot keys combine on the map side."""
    values = [c for c in rows.columns if c not in (KEY, VERSION)]
    best = F.max_by(F.struct(VERSION, *values), F.struct(VERSION, *values))
    return rows.groupBy(KEY).agg(best.alias("__row")).select(KEY, "__row.*")


def put_partitions(
    rows: DataFrame,
    open_writer: Callable[[], object],
    batch_rows: int = 1_000,
    partitions: int | None = None,
) -> None:
    """Send rows to an external store: one writer per partition, rows in batches.

    `open_writer` runs on the executor and returns an object with `put(list[Row])` and
    `close()`. Puts are keyed, so a retried task writes the same cells again.
    """
    if partitions is not None:
        rows = rows.coalesce(partitions)

    def send(part: Iterable[Row]) -> None:
        writer = open_writer()
        try:
            batch: list[Row] = []
            for row in part:
                batch.append(row)
                if len(batch) >= batch_rows:
                    writer.put(batch)
                    batch = []
            if batch:
                writer.put(batch)
        finally:
            writer.close()

    rows.foreachPartition(send)


class JsonPuts:
    """A writer for `put_partitions`: JSON lines in one file per partition of a shared folder.

    The file is named after the partition, so a retried task replaces what it had written.
    """

    def __init__(self, folder: str) -> None:
        store, path = FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}.json"
        self.stream = store.open_output_stream(f"{path}/{name}")

    def put(self, rows: list[Row]) -> None:
        self.stream.write("".join(json.dumps(r.asDict()) + "\n" for r in rows).encode())

    def close(self) -> None:
        self.stream.close()


def write_table(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Store a keyed table in files of the advised size, or with a fixed number of writers."""
    rows = rows.hint("rebalance", KEY) if files is None else rows.repartition(files, KEY)
    rows.write.mode("overwrite").parquet(path)


def bulk_build(rows: DataFrame, path: str, regions: int | None = None) -> None:
    """Sorted build: one row per key, key ranges per file, sorted inside each file.

    Row groups of such files have narrow key bounds, which is what `range_scan` prunes by.
    """
    unique = latest(rows) if VERSION in rows.columns else rows.dropDuplicates([KEY])
    ranged = (
        unique.repartitionByRange(regions, KEY) if regions else unique.repartitionByRange(KEY)
    )
    ranged.sortWithinPartitions(KEY).write.mode("overwrite").parquet(path)


def region_of(key: Column, splits: list[str]) -> Column:
    """Region of a key: how many of the sorted split points are not above it, by binary search."""
    if not splits:
        return F.lit(0)
    points = F.array(*[F.lit(s) for s in splits])

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        above = F.get(points, middle) > key
        moved = F.struct(
            F.when(above, s["low"]).otherwise(middle + 1).alias("low"),
            F.when(above, middle).otherwise(s["high"]).alias("high"),
        )
        return F.when(s["low"] < s["high"], moved).otherwise(s)

    whole = F.struct(F.lit(0).alias("low"), F.lit(len(splits)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(len(splits).bit_length()))
    return F.aggregate(steps, whole, halve, lambda s: s["low"])


def region_build(
    rows: DataFrame, splits: list[str], table: CommittedTable, tasks: int | None = None
) -> Manifest:
    """Build a table by given split points and publish all its files at once.

    One row per key. Every file lies in one region, is sorted, and files of a region do not overlap. Tasks take
    ranges of (region, key), so a region with most of the rows is built by many; a task that holds the
    end of one region and the start of the next writes a file for each. Until the manifest is
    written, readers see the table as it was; a failed build leaves it so.
    """
    if splits != sorted(set(splits)):
        raise ValueError("split points are sorted and distinct")
    unique = latest(rows) if VERSION in rows.columns else rows.dropDuplicates([KEY])
    placed = unique.filter(F.col(KEY).isNotNull()).withColumn(REGION, region_of(F.col(KEY), splits))
    ranged = placed.repartitionByRange(*([tasks] if tasks else []), REGION, KEY)
    folder = table.new_folder()
    ranged.sortWithinPartitions(REGION, KEY).write.partitionBy(REGION).parquet(table.full_path(folder))
    return table.publish(folder, placed.schema, {"splits": splits})


def file_bounds(table: DataFrame) -> DataFrame:
    """Per file: region, rows, first and last key as stored, and whether its rows are in order."""
    place = Window.partitionBy("file").orderBy("at")
    stored = table.select(
        REGION, KEY, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    ).withColumn("before", F.lag(KEY).over(place))
    return stored.groupBy("file").agg(
        F.first(REGION).alias(REGION), F.count("*").alias("n"),
        F.min_by(KEY, "at").alias("first_key"), F.max_by(KEY, "at").alias("last_key"),
        F.coalesce(F.bool_and(F.col("before") < F.col(KEY)), F.lit(True)).alias("in_order"),
    )


def region_bounds(table: DataFrame) -> DataFrame:
    """Per region: rows, bounds, whether every file is in order and none overlaps the one before."""
    by_key = Window.partitionBy(REGION).orderBy("first_key")
    files = file_bounds(table).withColumn("before", F.lag("last_key").over(by_key))
    apart = F.coalesce(F.col("before") < F.col("first_key"), F.lit(True))
    return files.groupBy(REGION).agg(
        F.sum("n").alias("n"), F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"),
        F.bool_and(F.col("in_order") & apart).alias("in_order"),
    )


def range_scan(table: DataFrame, start: str | None = None, stop: str | None = None) -> DataFrame:
    """Rows with start <= key < stop in byte order; both bounds reach the file scan."""
    if start is not None:
        table = table.filter(F.col(KEY) >= start)
    if stop is not None:
        table = table.filter(F.col(KEY) < stop)
    return table


def open_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
