"""A log of topics and partitions kept in files, as a stream with an offset per partition.

The log is append-only Parquet: an append adds a folder of records under data/, in files of bounded size
that hold many partitions, and then one under index/, which has a row per file and segment (a fixed
range of a partition's offsets) with its first offset and the one after its last. Files, tasks and planning
thus grow with the records, not with the number of partitions, and records are seen once their index is
whole. `append_log` writes it with Spark, the data source `partition_log` streams it:
subscribe to topics or assign partitions, start at the earliest or latest offset or at given ones, and take
at most so many offsets a trigger. Offsets of a batch are kept by the checkpoint, as with any source;
started anew from a ledger's offsets it goes on where the ledger ends.

With a limit, a query that is to read all runs by processing time until nothing is left: a run of what is
available now asks the source once. It reads files, with the rules of a queue's source; it is not a queue.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# The reader travels inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "partition_log"
SCHEMA = "topic STRING, partition INT, offset BIGINT, key STRING, value STRING"
#: Offsets of a segment.
SEGMENT = 100_000
#: Records of a file, and about those that a task reads.
FILE_RECORDS = TASK_RECORDS = 100_000

Offsets = dict[str, dict[str, int]]


def append_log(records: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Append records (topic, partition, offset, key, value); offsets of a partition go on without gaps."""
    spark, name = records.sparkSession, uuid.uuid4().hex
    cut = records.select(
        "topic", F.col("partition").cast("int"), F.col("offset").cast("long"), "key", "value",
        F.floor(F.col("offset") / segment).cast("long").alias("segment"),
    )
    keys = ["topic", "partition", "segment"]
    ordered = cut.hint("rebalance", *keys).sortWithinPartitions("topic", "partition", "offset")
    ordered.write.option("maxRecordsPerFile", FILE_RECORDS).parquet(f"{path}/data/{name}")
    written = spark.read.schema(ordered.schema).parquet(f"{path}/data/{name}")
    file = F.concat(F.lit(f"{name}/"), F.col("_metadata.file_name"))
    index = written.groupBy(*keys, file.alias("file")).agg(
        F.min("offset").alias("first"), (F.max("offset") + 1).alias("until")
    )
    index.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{path}/index/{name}")


@dataclass(frozen=True)
class Stretch:
    """Offsets from `first` up to `until` of one segment, and the files that hold any of them."""

    topic: str
    partition: int
    segment: int
    first: int
    until: int
    files: tuple[str, ...]


@dataclass
class Share(InputPartition):
    """The stretches that one task reads."""

    stretches: list[Stretch]

    def __post_init__(self) -> None:
        super().__init__(None)


def shares(stretches: list[Stretch], records: int = TASK_RECORDS) -> list[Share]:
    """Stretches of the same files together, about `records` offsets a task."""
    out, held = [], records
    for s in sorted(stretches, key=lambda s: (s.files, s.topic, s.partition, s.first)):
        if held >= records:
            out.append(Share([]))
            held = 0
        out[-1].stretches.append(s)
        held += s.until - s.first
    return out


def segment_names(topic, partition, segment) -> pa.Array:
    """One text per (topic, partition, segment), the topic last, as it may hold any character."""
    return pc.binary_join_element_wise(
        pc.cast(partition, pa.string()), pc.cast(segment, pa.string()), pc.cast(topic, pa.string()), "/"
    )


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        options = {k.lower(): v for k, v in options.items()}
        self.root = options["path"]
        self.topics = [t for t in options.get("subscribe", "").split(",") if t]
        self.assigned = json.loads(options.get("assign", "{}"))
        if bool(self.topics) == bool(self.assigned):
            raise ValueError("give either subscribe or assign")
        self.starting = options.get("startingoffsets", "earliest")
        self.limit = int(options.get("maxoffsetspertrigger", 0))
        self.segment = int(options.get("segment", SEGMENT))
        self.reached: Offsets | None = None
        self.appends: set[str] = set()
        # Per topic and partition: per segment, its files with their first offset and the one after the last.
        self.index: dict[str, dict[str, dict[int, list[tuple[str, int, int]]]]] = {}

    # What is there

    def _store(self) -> tuple[FileSystem, str]:
        return FileSystem.from_uri(self.root)

    def _refresh(self) -> None:
        """Take in the index of appends that have ended since; what is known of the others stays."""
        store, root = self._store()
        found = store.get_file_info(FileSelector(f"{root}/index", allow_not_found=True))
        for folder in found:
            if folder.base_name in self.appends:
                continue
            if store.get_file_info(f"{folder.path}/_SUCCESS").type != FileType.File:
                continue
            for f in store.get_file_info(FileSelector(folder.path)):
                if f.type != FileType.File or f.base_name[0] in "._":
                    continue
                rows = pq.read_table(f.path, filesystem=store, partitioning=None).to_pydict()
                for topic, partition, segment, file, first, until in zip(
                    *(rows[c] for c in ("topic", "partition", "segment", "file", "first", "until"))
                ):
                    segments = self.index.setdefault(topic, {}).setdefault(str(partition), defaultdict(list))
                    segments[segment].append((file, first, until))
            self.appends.add(folder.base_name)

    def _partitions(self) -> dict[str, list[str]]:
        if self.assigned:
            return {t: sorted(map(str, ps)) for t, ps in self.assigned.items()}
        return {t: sorted(self.index.get(t, ())) for t in self.topics}

    def _edge(self, topic: str, partition: str, last: bool) -> int:
        segments = self.index.get(topic, {}).get(partition)
        if not segments:
            return 0
        if last:
            return max(until for _, _, until in segments[max(segments)])
        return min(first for _, first, _ in segments[min(segments)])

    def _ends(self, last: bool) -> Offsets:
        self._refresh()
        return {
            t: {p: self._edge(t, p, last) for p in ps} for t, ps in self._partitions().items()
        }

    # The source's contract

    def initialOffset(self) -> Offsets:
        if self.starting in ("earliest", "latest"):
            return self._ends(self.starting == "latest")
        given, earliest = json.loads(self.starting), self._ends(False)
        return {t: {p: given.get(t, {}).get(p, low) for p, low in ps.items()} for t, ps in earliest.items()}

    def latestOffset(self) -> Offsets:
        latest = self._ends(True)
        if not self.limit:
            return latest
        begun = self.reached or self.initialOffset()
        share = -(-self.limit // max(1, sum(map(len, latest.values()))))
        return {
            t: {p: max(begun.get(t, {}).get(p, 0), min(high, begun.get(t, {}).get(p, 0) + share))
                for p, high in ps.items()}
            for t, ps in latest.items()
        }

    def partitions(self, start: Offsets, end: Offsets) -> list[Share]:
        self._refresh()
        self.reached, out = end, []
        for topic, ends in end.items():
            for partition, until in ends.items():
                # A partition that came later is read from its earliest offset.
                first = start.get(topic, {}).get(partition)
                first = self._edge(topic, partition, False) if first is None else first
                if until < first:
                    raise RuntimeError(f"{topic}/{partition}: the log ends at {until}, before offset {first}")
                segments = self.index.get(topic, {}).get(partition, {})
                for s in range(first // self.segment, -(-until // self.segment)):
                    low, high = max(first, s * self.segment), min(until, (s + 1) * self.segment)
                    if low < high:
                        files = (f for f, begin, end_ in segments.get(s, ()) if begin < high and low < end_)
                        out.append(Stretch(topic, int(partition), s, low, high, tuple(sorted(files))))
        return shares(out)

    def read(self, part: Share) -> Iterator:
        """The records of the stretches, file by file; each must be there once."""
        store, root = self._store()
        given = part.stretches
        names = segment_names(
            pa.array([s.topic for s in given], pa.string()), pa.array([s.partition for s in given], pa.int32()),
            pa.array([s.segment for s in given], pa.int64()),
        )
        first, until = (np.array([getattr(s, at) for s in given], np.int64) for at in ("first", "until"))
        rows = np.zeros(len(given), np.int64)
        near = (ds.field("offset") >= int(first.min())) & (ds.field("offset") < int(until.max()))
        for file in sorted({f for s in given for f in s.files}):
            scan = ds.dataset(f"{root}/data/{file}", filesystem=store, format="parquet").scanner(filter=near)
            for batch in scan.to_batches():
                at = pc.index_in(
                    segment_names(batch.column("topic"), batch.column("partition"), batch.column("segment")), names
                )
                at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False)
                offset = batch.column("offset").to_numpy()
                inside = np.flatnonzero((at >= 0) & (offset >= first[at]) & (offset < until[at]))
                if len(inside):
                    rows += np.bincount(at[inside], minlength=len(given))
                    yield batch.select(["topic", "partition", "offset", "key", "value"]).take(pa.array(inside))
        for s, n in zip(given, rows.tolist()):
            if n != s.until - s.first:
                raise RuntimeError(f"{s.topic}/{s.partition}: {n} records in offsets {s.first} to {s.until}")

    def commit(self, end: Offsets) -> None:
        self.reached = end


class PartitionLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> LogReader:
        return LogReader(dict(self.options))


def read_log(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The log as a stream. Options: subscribe or assign, startingOffsets, maxOffsetsPerTrigger, segment."""
    spark.dataSource.register(PartitionLog)
    return spark.readStream.format(FORMAT).options(path=path, **options).load()
