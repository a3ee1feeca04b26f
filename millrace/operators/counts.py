"""Word and value counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import col_of, java_split


def words(lines: DataFrame, column: str = "value", sep: str = " ") -> DataFrame:
    """One row per token."""
    return lines.select(F.explode(java_split(column, sep)).alias("word"))


def word_count(
    lines: DataFrame, column: str = "value", sep: str = " ", reducers: int | None = None
) -> DataFrame:
    """Count per word. Counting starts on the map side; `reducers` fixes the output width."""
    counted = words(lines, column, sep).groupBy("word").agg(F.count("*").alias("n"))
    # Repartitioning the counts, not the tokens, keeps hot words cheap.
    return counted if reducers is None else counted.repartition(reducers, "word")


def value_count(df: DataFrame, column: str, to: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(to))


def lines_of(df: DataFrame, text: str) -> DataFrame:
    """Multi-line texts as text lines."""
    return df.select(F.explode(F.split(F.col(text), "\n")).alias("value"))


def sum_by_word(pairs: DataFrame, word: str = "word", num: str = "num") -> DataFrame:
    return pairs.groupBy(word).agg(F.sum(num).alias("total"))


def sum_count_mean(df: DataFrame, value: Column | str) -> DataFrame:
    value = col_of(value)
    return df.agg(
        F.sum(value).alias("total"), F.count(value).alias("n"), F.avg(value).alias("mean")
    )


def distinct_per_key(df: DataFrame, key: str, value: str, to: str = "n_distinct") -> DataFrame:
    """count(distinct value) per key; nulls are not counted."""
    return df.groupBy(key).agg(F.countDistinct(value).alias(to))


def distinct_two_level(df: DataFrame, key: str, value: str, to: str = "n_distinct") -> DataFrame:
    """The same by two groupings: first (key, value), then key."""
    return df.groupBy(key, value).count().groupBy(key).agg(F.count(value).alias(to))


def groups_over(df: DataFrame, key: str, least: int, to: str = "num") -> DataFrame:
    """Group counts above a bound."""
    return value_count(df, key, to).filter(F.col(to) > least)


def sum_of_group_counts(df: DataFrame, key: str) -> DataFrame:
    """Sum of group counts."""
    return value_count(df, key, "num").agg(F.sum("num").alias("total"))


def in_list(df: DataFrame, column: str, members: list) -> DataFrame:
    """Rows whose value is a member of a short literal list."""
    return df.filter(F.col(column).isin(members))


def match_counts(df: DataFrame, matched: Column, by: list[str] | None = None) -> DataFrame:
    """Matched and unmatched rows as exact aggregates."""
    aggs = [
        F.count_if(matched).alias("matched"),
        F.count_if(~matched).alias("unmatched"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def chunk_of(df: DataFrame, value: str, chunk_width: int, hash_chunks: int = 1) -> Column:
    """Chunk of a value: a range of `chunk_width` whole numbers, or of other values a digest range.

    Values that are no whole numbers have no ranges of known width; `hash_chunks` cuts a key's
    values into that many chunks instead.
    """
    if isinstance(df.schema[value].dataType, T.IntegralType):
        return F.floor(F.col(value) / F.lit(chunk_width)).cast("long")
    return F.pmod(F.xxhash64(value), F.lit(hash_chunks)).cast("long")


def chunked_lists(
    df: DataFrame, key: str, value: str, chunk_width: int, hash_chunks: int = 1
) -> DataFrame:
    """Values per key as lists, cut into chunks: `values` and, place by place, their `copies`.

    Equal values are counted before the shuffle, so a chunk of whole numbers holds at most
    `chunk_width` entries however large or repetitive the key's group is. The two lists together
    are the key's values with all their repeats. A null value is an entry like any other.
    """
    distinct = df.groupBy(key, value).agg(F.count("*").alias("copies"))
    chunk = chunk_of(df, value, chunk_width, hash_chunks)
    return (
        distinct.groupBy(key, chunk.alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct(value, "copies"))).alias("items"))
        .select(
            key,
            "chunk",
            F.transform("items", lambda i: i[value]).alias("values"),
            F.transform("items", lambda i: i["copies"]).alias("copies"),
            F.aggregate("items", F.lit(0).cast("long"), lambda s, i: s + i["copies"]).alias("n_rows"),
        )
    )
