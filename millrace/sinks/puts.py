"""Keyed puts by a writer per partition, with a commit for the whole job.

Every task writes a file of its own name and reports it; when all have, the driver writes one manifest
that names the files. A file no manifest names is not part of the table: what a killed task, a second
attempt or a failed job leaves behind is never read. A failed job's reported files are removed.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

# The writer travels inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "keyed_puts"
#: Rows of one put.
PUT_ROWS = 1_000


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class PutWriter(DataSourceArrowWriter):
    """JSON lines, put by put, under data/ of the folder."""

    def __init__(self, folder: str, put_rows: int) -> None:
        self.folder, self.put_rows, self.job = folder, put_rows, uuid.uuid4().hex

    def _store(self) -> tuple[FileSystem, str]:
        return FileSystem.from_uri(self.folder)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = self._store()
        store.create_dir(f"{root}/data", recursive=True)
        name, rows = f"{self.job}-{uuid.uuid4().hex}.json", 0
        with store.open_output_stream(f"{root}/data/{name}") as out:
            for batch in iterator:
                for at in range(0, batch.num_rows, self.put_rows):
                    put = batch.slice(at, self.put_rows).to_pylist()
                    out.write("".join(json.dumps(r, default=str) + "\n" for r in put).encode())
                rows += batch.num_rows
        return Written(name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = self._store()
        store.create_dir(f"{root}/_log", recursive=True)
        aside = f"{root}/_log/.{self.job}"
        with store.open_output_stream(aside) as out:
            out.write(json.dumps([m.file for m in messages if m is not None and m.rows]).encode())
        store.move(aside, f"{root}/_log/{self.job}.json")

    def abort(self, messages: list[Written | None]) -> None:
        store, root = self._store()
        for m in messages:
            if m is not None:
                store.delete_file(f"{root}/data/{m.file}")


class KeyedPuts(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> PutWriter:
        if overwrite:
            raise ValueError("puts are appended; their table is the newest row of each key")
        return PutWriter(self.options["path"], int(self.options.get("putRows", PUT_ROWS)))


def put_rows(rows: DataFrame, folder: str, put_rows: int = PUT_ROWS, partitions: int | None = None) -> None:
    """Put all rows, by as many writers as they have partitions (or fewer), and commit them at once."""
    rows.sparkSession.dataSource.register(KeyedPuts)
    rows = rows if partitions is None else rows.coalesce(partitions)
    rows.write.format(FORMAT).mode("append").option("putRows", put_rows).save(folder)


def committed_files(folder: str) -> list[str]:
    store, root = FileSystem.from_uri(folder)
    found = store.get_file_info(FileSelector(f"{root}/_log", allow_not_found=True))
    names = []
    for f in found:
        if f.base_name.endswith(".json"):
            with store.open_input_stream(f.path) as stream:
                names += json.loads(stream.readall())
    return sorted(names)


def read_puts(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All rows of committed puts."""
    files = [f"{folder}/data/{name}" for name in committed_files(folder)]
    return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)
