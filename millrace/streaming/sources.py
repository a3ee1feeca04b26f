"""Streaming sources: file folders and sockets."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Longer than any file has been there; without it the engine leaves out files of over a week.
ANY_AGE = "36500d"


def line_files(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    max_age: str | None = None,
    files_per_trigger: int | None = None,
    newer_than: datetime | None = None,
) -> DataFrame:
    """Text files of a folder as a stream of `value`.

    `glob` filters file names; with `max_age`, files older than that are ignored, counted from the
    newest one, else files of any age are read; `newer_than` keeps new files only.
    """
    reader = spark.readStream.option("maxFileAge", max_age or ANY_AGE)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.text(path)
    if newer_than is not None:
        lines = lines.filter(F.col("_metadata.file_modification_time") > F.lit(newer_than))
    return lines


def table_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
