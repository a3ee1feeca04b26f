"""File readers: text, JSON, ORC, CSV, delimited lookups, rule files, page records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import java_split, norm_null
from millrace.runtime import spread

# Fixed value: the declared record of the app-install files.
APP_INSTALL_DDL = (
    "aid STRING, pkgname STRING, uptime BIGINT, type INT, country STRING, gpcategory STRING"
)
# Fixed value: marker of files still being copied in.
COPYING_MARK = "_COPYING_"


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Text lines as `value`. With `min_partitions`, splits are cut smaller at the scan."""
    if min_partitions is None:
        return spark.read.text(path)
    lines = spark.read.text(path)
    if spark_partitions(lines) < min_partitions:
        lines = lines.repartition(min_partitions)
    return lines


def spark_partitions(df: DataFrame) -> int:
    """Planned partition count, from the plan alone (no job)."""
    return df.rdd.getNumPartitions()


def read_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """JSON lines; inferred when no schema is given, which costs a second pass."""
    return spark.read.schema(schema).json(path) if schema else spark.read.json(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_app_installs(spark: SparkSession, path: str) -> DataFrame:
    """ORC with the declared schema; strings that are empty or the word null become null."""
    df = spark.read.schema(APP_INSTALL_DDL).orc(path)
    return df.select(
        *[
            norm_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else f.name
            for f in df.schema.fields
        ]
    )


def read_typed_text(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    """Delimited text with a declared schema; values are taken literally (no quoting)."""
    wanted = T.StructType.fromDDL(schema)
    fields = java_split("value", sep)
    return spark.read.text(path).select(
        *[F.get(fields, F.lit(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(wanted)]
    )


def with_line_order(lines: DataFrame) -> DataFrame:
    """Add `line_order`: sortable position of a text line over all files of the scan."""
    return lines.withColumn(
        "line_order",
        F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        ),
    )


def last_wins(df: DataFrame, key: str, value: str, order: Column | str) -> DataFrame:
    """One row per key, the value with the greatest order."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def read_dictionary(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Dictionary file `code SEP name`: the last line of a code wins, other lines are dropped."""
    fields = java_split("value", sep)
    pairs = with_line_order(spark.read.text(path)).filter(F.size(fields) >= 2)
    return last_wins(
        pairs.select(
            F.get(fields, F.lit(0)).alias("code"), F.get(fields, F.lit(1)).alias("name"), "line_order"
        ),
        "code",
        "name",
        "line_order",
    )


def read_lookup_dir(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    """Lookup folder: lines of exactly two fields, the last line of a code wins."""
    fields = java_split("value", sep)
    pairs = with_line_order(spark.read.text(path)).filter(F.size(fields) == 2)
    return last_wins(
        pairs.select(
            F.get(fields, F.lit(0)).alias("code"), F.get(fields, F.lit(1)).alias("name"), "line_order"
        ),
        "code",
        "name",
        "line_order",
    )


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule folder `host, xpath, true/false, origin` by tab, as a set.

    Lines with another field count and files still being copied in are skipped.
    """
    fields = java_split("value", "\t")
    return (
        spark.read.text(path)
        .filter(~F.contains(F.col("_metadata.file_name"), F.lit(COPYING_MARK)))
        .filter(F.size(fields) == 4)
        .select(
            F.get(fields, F.lit(0)).alias("host"),
            F.get(fields, F.lit(1)).alias("xpath"),
            (F.get(fields, F.lit(2)) == "true").alias("is_positive"),
            F.get(fields, F.lit(3)).alias("origin"),
        )
        .dropDuplicates(["host", "xpath", "is_positive"])
    )


def read_page_lines(spark: SparkSession, path: str) -> DataFrame:
    """Page-record lines with a row key that is unique even among equal records."""
    return spread(spark.read.text(path)).withColumn("row_key", F.monotonically_increasing_id())
