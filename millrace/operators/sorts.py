"""Global order, positions, top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import checkpointed


#: Copies of a row that one task writes out at once; more are cut into blocks and spread.
COPIES_AT_ONCE = 1 << 20


def sorted_counts(counts: DataFrame) -> DataFrame:
    """Counts from high to low, words ascending among equals."""
    return counts.orderBy(F.col("n").desc(), F.col("word").asc())


def parse_pairs(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of the form (word,number) as columns; other lines are left out."""
    line = F.col(column)
    inner = F.split(F.substring(line, F.lit(2), F.length(line) - 2), ",")
    return (
        lines.filter(line.startswith("(") & line.endswith(")"))
        .select(F.get(inner, F.lit(0)).alias("word"), F.get(inner, F.lit(1)).try_cast("int").alias("num"))
    )


def secondary_sort(pairs: DataFrame) -> DataFrame:
    """Word descending, number ascending."""
    return pairs.orderBy(F.col("word").desc(), F.col("num").asc())


def with_positions(df: DataFrame, order: list[Column], to: str = "position") -> DataFrame:
    """Position of every row in a global order, without one task seeing all rows.

    Equal rows are counted first, so copies cost nothing. The distinct rows are split into
    key ranges and checkpointed, which fixes the ranges; per-range totals, one row per
    partition, give each range its start; inside a range a running sum does the rest. Every
    distinct row is then expanded back to its copies, very many of them by several tasks.
    """
    block = COPIES_AT_ONCE
    columns = df.columns
    distinct = df.groupBy(*columns).agg(F.count("*").alias("__copies"))
    ranged = checkpointed(
        distinct.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    )
    totals = ranged.groupBy("__range").agg(F.sum("__copies").alias("__rows"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = F.col("__start") + F.coalesce(F.sum("__copies").over(inside), F.lit(0))
    # One row per shuffle partition: the bound of `starts` is the partition count.
    placed = ranged.join(F.broadcast(starts), "__range").withColumn("__first", first)
    last = F.col("__first") + F.col("__copies")
    blocks = placed.select(
        *columns, last.alias("__last"),
        F.explode(F.sequence(F.col("__first") + 1, last, F.lit(block))).alias("__from"),
    )
    if (ranged.agg(F.max("__copies")).first()[0] or 0) > block:
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = blocks.repartition(width, "__from")
    end = F.least(F.col("__from") + (block - 1), F.col("__last"))
    return blocks.select(*columns, F.explode(F.sequence(F.col("__from"), end)).alias(to))


def top_k_per_key(df: DataFrame, key: str, order: list[Column], k: int, to: str = "rank") -> DataFrame:
    """The first k rows of every key; a partial top-k runs before the shuffle."""
    ranked = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(to, F.row_number().over(ranked)).filter(F.col(to) <= k)


def first_n(df: DataFrame, order: list[Column], n: int = 5) -> DataFrame:
    """The first n rows of a global order; each task keeps n rows."""
    return df.orderBy(*order).limit(n)
