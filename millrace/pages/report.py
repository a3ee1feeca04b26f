"""Per-host quality report, storage rows and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import hour_md5, page_rowkey, scan_day, scan_hour, second_stamp
from millrace.functions.urls import host_domain
from millrace.pages.extract import EMPTY, EXTRACT, NO_MATCH
from millrace.pages.records import FILTERED

COUNTERS = ("scan", "filtered", "extract", "empty_context", "no_match_xpath")
REPORT_KEY = ("host", "hour_md5")


def host_report(outcomes: DataFrame, at: Column) -> DataFrame:
    """Five counters per host in one aggregation; `outcome` is null for filtered records.

    scan is always the sum of the other four.
    """
    return (
        outcomes.groupBy("host")
        .agg(
            F.count("*").alias("scan"),
            F.count_if(F.col("status") == FILTERED).alias("filtered"),
            F.count_if(F.col("outcome") == EXTRACT).alias("extract"),
            F.count_if(F.col("outcome") == EMPTY).alias("empty_context"),
            F.count_if(F.col("outcome") == NO_MATCH).alias("no_match_xpath"),
        )
        .select(
            "host",
            *COUNTERS,
            scan_day(at).alias("scan_day"),
            scan_hour(at).alias("scan_hour"),
            at.alias("scan_time"),
            hour_md5(at).alias("hour_md5"),
        )
    )


def merge_reports(*reports: DataFrame) -> DataFrame:
    """Additive merge on (host, hour): counters add up, the first scan time stays."""
    whole = reports[0]
    for r in reports[1:]:
        whole = whole.unionByName(r)
    return whole.groupBy(*REPORT_KEY).agg(
        *[F.sum(c).alias(c) for c in COUNTERS],
        F.min("scan_day").alias("scan_day"),
        F.min("scan_hour").alias("scan_hour"),
        F.min("scan_time").alias("scan_time"),
    )


def storage_rows(extracted: DataFrame, at: Column) -> DataFrame:
    """Keyed-table rows of extracted pages; columns are family_qualifier."""
    return extracted.filter(F.col("outcome") == EXTRACT).select(
        page_rowkey("host", at, "url").alias("rowkey"),
        F.col("url").alias("i_url"),
        host_domain("host").alias("i_domain"),
        F.col("host").alias("i_host"),
        F.col("content").alias("c_content"),
        F.col("html").alias("h_html"),
    )


def documents(extracted: DataFrame, at: Column) -> DataFrame:
    """Search documents of extracted pages."""
    return extracted.filter(F.col("outcome") == EXTRACT).select(
        "url",
        F.md5("url").alias("url_md5"),
        "host",
        host_domain("host").alias("domain"),
        second_stamp(at).alias("date"),
        "content",
    )
