"""The page job: validate, learn, extract, report. One code path for batch and stream."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.pages.elements import with_tree
from millrace.pages.extract import keyed_content, outcome_of, ruled_content
from millrace.pages.mining import mined
from millrace.pages.records import OK, parse_records, validate
from millrace.pages.rule_index import PAGE, page_keys, with_met_rules
from millrace.pages.report import documents, host_report, merge_reports, storage_rows
from millrace.pages.templates import choose_rules, counter_deltas, host_rules
from millrace.runtime import (
    BROADCAST_LIMIT_BYTES,
    materialized,
    measured_bytes,
)
from millrace.sinks.ledger import BatchKey, put_batch
from millrace.streaming.jobs import RefreshedLookup, start



def learned(records: DataFrame, keys: tuple[str, ...] = ("host",)) -> DataFrame:
    """The key columns and `mined` of every record; null for records that are not valid.

    There is no filter on purpose: it would be pushed down to the scan and split every
    record once per reference. Records that are not valid skip the parser instead.
    """
    html = F.when(F.col("status") == OK, F.col("html")).alias("html")
    return with_tree(records.select(*keys, html)).select(*keys, mined().alias("mined"))


def parsed_valid(records: DataFrame) -> DataFrame:
    """Valid records with their trees; the html crosses to the parser once."""
    return with_tree(records, "html", keep_html=True, wanted=F.col("status") == OK)


def mined_pages(records: DataFrame) -> DataFrame:
    """Records stored with a number, `mined` and the distinct `keys` of their elements.

    Rules are learned from them and their results made without splitting or mining a page again.
    """
    numbered = records.withColumn(PAGE, F.monotonically_increasing_id())
    facts = [F.when(F.col("status") == OK, mined()).alias("mined"), page_keys().alias("keys")]
    return materialized(parsed_valid(numbered).select(*numbered.columns, *facts), "mined-pages")


def page_results(
    records: DataFrame,
    rules: DataFrame,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    size: int | None = None,
) -> DataFrame:
    """One row per record with `mined`, `content` and `outcome`.

    Filtered records skip the parser; `mined_pages` are not mined again. Rules within the limit, measured before they are gathered by host
    (or of known `size`), are broadcast to the parsed pages. Larger ones are met through an index.
    """
    if (measured_bytes(rules) if size is None else size) <= limit_bytes:
        return _extracted(parsed_valid(records).join(F.broadcast(host_rules(rules)), "host", "left"))
    return _indexed_results(records, rules)


def _indexed_results(records: DataFrame, rules: DataFrame) -> DataFrame:
    """The same with rules of any number. Pages are stored once with their facts and keys; the rules
    they meet are short rows. The second parse is for the text."""
    pages = records if PAGE in records.columns else mined_pages(records)
    return _extracted(parsed_valid(with_met_rules(pages, pages.select(PAGE, "host", "keys"), rules)))


def _extracted(ruled: DataFrame) -> DataFrame:
    """Parsed pages with their rules, reduced to facts, content and outcome."""
    ok = F.col("status") == OK
    if "mined" not in ruled.columns:
        ruled = ruled.withColumn("mined", F.when(ok, mined()))
    text = keyed_content() if "keys" in ruled.columns else ruled_content()
    return (
        ruled.withColumn("content", F.when(ok, text))
        .withColumn("outcome", F.when(ok, outcome_of(F.col("content"))))
        .drop("nodes", "pieces", "positive", "negative", "negative_keys", "usable", "n_fields", "keys", PAGE)
    )


def learn_rules(records: DataFrame, k: int = 2) -> DataFrame:
    """Rules learned from a set of validated records or `mined_pages`; the pages are parsed once.

    The learned facts are stored before they are filtered: a filter on an unstored `mined`
    would be pushed below it and compute it twice.
    """
    facts = records if "mined" in records.columns else materialized(learned(records), "learned")
    return choose_rules(materialized(counter_deltas(facts), "counters"), k)


@dataclass(frozen=True)
class PageTables:
    """Folders of the job's output tables, each partitioned by run and batch id."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def run_key(at: datetime) -> BatchKey:
    """The key of a batch run: its scan time. The same scan run again replaces its tables."""
    return BatchKey(at.strftime("scan-%Y%m%dT%H%M%S.%f"), 0)


def run_batch(
    records: DataFrame,
    rules: DataFrame,
    at: datetime,
    tables: PageTables,
    key: BatchKey,
    size: int | None = None,
) -> None:
    """Run the whole job on one set of validated records and store its tables under `key`.

    The per-page results are written first; documents, storage rows, counters and report are
    derived from that table, so no page is parsed twice. `size` is that of the rules, if known.
    """
    spark = records.sparkSession
    moment = F.lit(at).cast("timestamp_ntz")
    put_batch(page_results(records, rules, size=size), tables.path("results"), key)
    results = spark.read.parquet(f"{tables.path('results')}/{key.folder}")
    put_batch(documents(results, moment), tables.path("documents"), key)
    put_batch(storage_rows(results, moment), tables.path("storage"), key)
    put_batch(counter_deltas(results), tables.path("counters"), key)
    put_batch(host_report(results, moment), tables.path("report"), key)


def total_report(spark: SparkSession, tables: PageTables) -> DataFrame:
    """Report over all batches: counters add up per (host, hour)."""
    return merge_reports(spark.read.parquet(tables.path("report")))


def total_counters(spark: SparkSession, tables: PageTables) -> DataFrame:
    """Template counters over all batches; negatives stay a set."""
    summed = (
        spark.read.parquet(tables.path("counters"))
        .groupBy("kind", "host", "xpath")
        .agg(F.sum("n").alias("n"))
    )
    return summed.withColumn(
        "n", F.when(F.col("kind") == "negative", F.lit(1).cast("long")).otherwise(F.col("n"))
    )


def start_stream(
    lines: DataFrame,
    load_rules: Callable[[SparkSession], DataFrame],
    tables: PageTables,
    checkpoint: str,
    refresh_seconds: float = 10.0,
    clock: Callable[[], float] = time.time,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The page job per micro-batch over streamed record lines.

    Rules are read again once they are older than the refresh interval; empty batches are
    skipped; the batch's tables replace those of an earlier attempt with the same key, and the
    source offsets are committed after them. A refresh takes a snapshot of the rules, so
    rule files may be replaced or removed at any time.
    """
    lookup = RefreshedLookup(load_rules, refresh_seconds, clock)

    def on_batch(batch: DataFrame, key: BatchKey) -> None:
        rules, size = lookup.current(batch.sparkSession)
        at = datetime.fromtimestamp(clock())
        run_batch(validate(parse_records(batch)), rules, at, tables, key, size)

    return start(lines, on_batch, checkpoint, trigger=trigger)


def moment(at: datetime) -> Column:
    return F.lit(at).cast("timestamp_ntz")
