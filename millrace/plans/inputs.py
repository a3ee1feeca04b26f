"""Inputs the queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.keys import FIELD_SEP
from millrace.operators.counts import lines_of
from millrace.plans.registry import table
from millrace.runtime import scratch, spread

MIN_STREAM_FILES = 4


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(spread(table(spark, sf_dir, "documents").select("text")), "text")


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(spread(table(spark, sf_dir, "conversations").select("text")), "text")


def staged(df: DataFrame, name: str, writer: str, files: int | None = None) -> str:
    """Write a derived input to the shared folder and return its path."""
    path = scratch(df.sparkSession, name)
    if files is not None:
        df = df.repartition(files)
    getattr(df.write, writer)(path)
    return path


def staged_stream(df: DataFrame, name: str, writer: str = "text") -> tuple[str, int]:
    """Stage in several files; returns the path and files per trigger for about four batches.

    The number of files is chosen without looking at the input, which is then computed once.
    """
    files = max(MIN_STREAM_FILES, df.sparkSession.sparkContext.defaultParallelism)
    return staged(df, name, writer, files), max(1, files // MIN_STREAM_FILES)


def app_installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as app installs; some countries are empty, the word null, or null."""
    key = F.col("c_custkey")
    country = (
        F.when(key % 50 == 0, "")
        .when(key % 50 == 1, "null")
        .when(key % 50 != 2, F.col("c_nationkey").cast("string"))
    )
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("aid"),
        F.col("c_name").alias("pkgname"),
        key.alias("uptime"),
        F.col("c_nationkey").alias("type"),
        country.alias("country"),
        F.col("c_mktsegment").alias("gpcategory"),
    )


APP_INSTALLS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS aid, c_name AS pkgname, c_custkey AS uptime,
       c_nationkey AS type,
       CASE WHEN c_custkey % 50 IN (0, 1, 2) THEN NULL
            ELSE CAST(c_nationkey AS VARCHAR) END AS country,
       c_mktsegment AS gpcategory
FROM customer
"""


def country_nums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("country"), (F.col("c_custkey") % 5).alias("num")
    )


COUNTRY_NUMS_SQL = (
    "SELECT CAST(c_nationkey AS VARCHAR) AS country, c_custkey % 5 AS num FROM customer"
)


def event_lines(spark: SparkSession, sf_dir: str, sep: str = " ") -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat_ws(sep, "event_type", F.col("user_id").cast("string")).alias("value")
    )


def edited_html(html, page_id):
    """Pages with an editor line of one of three shapes behind the headline."""
    line = (
        F.when(page_id % 3 == 0, "<p>责任编辑：<span>desk</span></p>")
        .when(page_id % 3 == 1, "<div><p>来源：wire</p></div>")
        .otherwise("<p><span>本文来源 agency</span> today</p>")
    )
    return F.replace(html, F.lit("</h1>"), F.concat(F.lit("</h1>"), line))


EDITED_HTML_SQL = """replace(html, '</h1>', '</h1>' || CASE page_id % 3
  WHEN 0 THEN '<p>责任编辑：<span>desk</span></p>'
  WHEN 1 THEN '<div><p>来源：wire</p></div>'
  ELSE '<p><span>本文来源 agency</span> today</p>' END)"""


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as record lines: some with a wrong checksum, without html, or as one field."""
    page_id, url = F.col("page_id"), F.col("url")
    html = F.regexp_replace(edited_html(F.col("html"), page_id), "[\\r\\n]", " ")
    md5 = F.when(page_id % 10 == 9, F.md5("url")).otherwise(
        F.md5(F.concat(url, F.lit(FIELD_SEP), html))
    )
    line = (
        F.when(page_id % 17 == 16, url)
        .when(page_id % 13 == 12, F.concat_ws(FIELD_SEP, md5, url, F.lit("")))
        .otherwise(F.concat_ws(FIELD_SEP, md5, url, html))
    )
    pages = spread(table(spark, sf_dir, "pages"))
    return pages.select("page_id", line.alias("value"))


PAGE_LINES_SQL = f"""
page_html AS (
  SELECT page_id, url, regexp_replace({EDITED_HTML_SQL}, '[\\r\\n]', ' ', 'g') AS html FROM pages
),
page_records AS (
  SELECT page_id, url, html,
         CASE WHEN page_id % 10 = 9 THEN md5(url) ELSE md5(url || chr(1) || html) END AS md5,
         CASE WHEN page_id % 17 = 16 THEN 1 WHEN page_id % 13 = 12 THEN 2 ELSE 3 END AS n_fields
  FROM page_html
)"""
