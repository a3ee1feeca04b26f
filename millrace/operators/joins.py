"""Joins: equi join, map join against a dictionary, cogroup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import norm_null
from millrace.operators.counts import chunk_of
from millrace.runtime import BROADCAST_LIMIT_BYTES, lookup_join


def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner equi join with all columns of both sides.

    No hint is given: size statistics and runtime re-planning choose broadcast or sort-merge
    and split skewed partitions.
    """
    return left.join(right, F.col(left_key) == F.col(right_key), "inner")


def map_join(
    big: DataFrame,
    dictionary: DataFrame,
    code: str = "country",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Look up the name of every row's code; `name` is null where there is none.

    `dictionary` has one row per code. Null, empty and "null" codes never match.
    """
    lookup = dictionary.select(F.col("code").alias("__code"), "name")
    keyed = big.withColumn("__code", norm_null(code))
    return lookup_join(keyed, lookup, ["__code"], "left", limit_bytes).drop("__code")


def matched_names(joined: DataFrame, code: str = "country") -> DataFrame:
    return joined.filter(F.col("name").isNotNull()).select(F.col(code).alias("code"), "name")


def chunked_cogroup(
    left: DataFrame, right: DataFrame, key: str, value: str, chunk_width: int, hash_chunks: int = 1
) -> DataFrame:
    """Both sides' values per key, side by side, cut into chunks of a value range.

    Keys of either side appear. As in `chunked_lists`, equal values are counted first, no list of
    whole numbers grows beyond the chunk width, and values go with their copies.
    """
    sides = (
        left.select(key, value, F.lit(True).alias("__left"))
        .unionByName(right.select(key, value, F.lit(False).alias("__left")))
        .groupBy(key, value, "__left")
        .agg(F.count("*").alias("copies"))
    )
    chunk = chunk_of(left, value, chunk_width, hash_chunks)

    def side(of_left: bool):
        here = F.col("__left") if of_left else ~F.col("__left")
        return F.array_sort(F.collect_list(F.when(here, F.struct(value, "copies"))))

    def total(items: str):
        return F.aggregate(items, F.lit(0).cast("long"), lambda s, i: s + i["copies"])

    return (
        sides.groupBy(key, chunk.alias("chunk"))
        .agg(side(True).alias("l"), side(False).alias("r"))
        .select(
            key,
            "chunk",
            F.transform("l", lambda i: i[value]).alias("left_values"),
            F.transform("l", lambda i: i["copies"]).alias("left_copies"),
            F.transform("r", lambda i: i[value]).alias("right_values"),
            F.transform("r", lambda i: i["copies"]).alias("right_copies"),
            total("l").alias("left_rows"),
            total("r").alias("right_rows"),
        )
    )


def union_many(frames: list[DataFrame]) -> DataFrame:
    """Bag union of any number of frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)
