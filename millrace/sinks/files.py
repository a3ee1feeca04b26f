"""File sinks: text, tab-joined text, ORC, JSON, CSV, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str, column: str = "value") -> None:
    """One column as text lines; an existing folder is replaced."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def tab_joined(df: DataFrame) -> DataFrame:
    """All columns joined by tab as `value`."""
    return df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns]).alias("value"))


def write_tsv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Tab-joined rows in files of the advised size, or in a fixed number of files.

    The rows are spread over the files by a shuffle, so the stage before keeps its parallelism.
    """
    lines = tab_joined(df)
    lines = lines.hint("rebalance") if files is None else lines.repartition(files)
    lines.write.mode("overwrite").text(path)


def write_orc(df: DataFrame, path: str, compression: str = "snappy") -> None:
    df.write.mode("overwrite").option("compression", compression).orc(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("delimiter", delimiter).csv(path)


def write_orc_and_json(df: DataFrame, orc_path: str, json_path: str) -> None:
    """Two sinks, one computation: the ORC files are read back for the JSON sink.

    Reading a written table instead of a cache survives lost executors.
    """
    write_orc(df, orc_path)
    write_json(df.sparkSession.read.schema(df.schema).orc(orc_path), json_path)


def write_documents(df: DataFrame, path: str) -> None:
    """Documents as JSON lines, for any bulk indexer."""
    write_json(df, path)


def index_documents(df: DataFrame, resource: str, id_column: str = "url_md5", **options: str) -> None:
    """Index into a search cluster; needs its Spark connector on the class path."""
    (
        df.write.format("es")
        .option("es.mapping.id", id_column)
        .options(**options)
        .mode("append")
        .save(resource)
    )
