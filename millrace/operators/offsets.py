"""Queue offsets: ranges of a batch, ledger, recovery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["topic", "partition"]


def offset_ranges(records: DataFrame) -> DataFrame:
    """First offset and the offset after the last one, per partition."""
    return records.groupBy(*KEY).agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def saved_offsets(ledger: DataFrame) -> DataFrame:
    """Where each partition continues: the greatest offset any finished batch reached."""
    return ledger.groupBy(*KEY).agg(F.max("until_offset").alias("offset"))


def reconcile(saved: DataFrame, earliest: DataFrame) -> DataFrame:
    """Start offsets: the saved one, but never before the cluster's earliest.

    Partitions without a saved offset start at the earliest; saved partitions the cluster
    does not list are kept.
    """
    return (
        saved.select(*KEY, F.col("offset").alias("saved"))
        .join(earliest.select(*KEY, F.col("offset").alias("earliest")), KEY, "full")
        .select(*KEY, F.greatest("saved", "earliest").alias("offset"))
    )


def as_mapping(offsets: DataFrame) -> dict[str, dict[int, int]]:
    """Offsets for the source options; one row per queue partition."""
    found: dict[str, dict[int, int]] = {}
    for row in offsets.select(*KEY, "offset").toLocalIterator():
        found.setdefault(row["topic"], {})[row["partition"]] = row["offset"]
    return found
