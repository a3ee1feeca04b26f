"""Queries of the web-page family."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.keys import page_rowkey
from millrace.functions.urls import url_host
from millrace.pages import job, templates
from millrace.pages.elements import elements, with_tree
from millrace.pages.extract import EMPTY, EXTRACT, NO_MATCH
from millrace.pages.records import OK, parse_records, validate
from millrace.pages.rule_index import host_flags
from millrace.pages.report import documents, host_report, merge_reports, storage_rows
from millrace.plans.inputs import PAGE_LINES_SQL, page_lines, staged, staged_stream
from millrace.plans.page_sql import (
    EXTRACT_CTES,
    HOST_SQL,
    MINING_CTES,
    RULE_CTES,
    VALID_PAGES,
    tree_ctes,
)
from millrace.plans.registry import query, table
from millrace.runtime import lookup_join, materialized, scratch, spread
from millrace.sinks.commits import CommittedTable
from millrace.sinks.ledger import BatchKey, put_batch
from millrace.sources.files import read_rules
from millrace.streaming.sources import line_files

SCAN_TIME = datetime(2024, 1, 2, 3, 4, 5, 678000)

REPORT_TIME_SQL = (
    "20240102 AS scan_day, 3 AS scan_hour, TIMESTAMP '2024-01-02 03:04:05.678' AS scan_time, "
    "md5('2024010203') AS hour_md5"
)


def _at():
    return job.moment(SCAN_TIME)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return validate(parse_records(page_lines(spark, sf)))


@query(
    "page_record_parse",
    f"""WITH {PAGE_LINES_SQL.strip()}
SELECT page_id, n_fields, CASE WHEN n_fields > 1 THEN md5 END AS md5, CASE WHEN n_fields > 1 THEN url END AS url,
       CASE WHEN n_fields = 3 THEN html END AS html FROM page_records""",
)
def page_record_parse(spark: SparkSession, sf: str) -> DataFrame:
    return parse_records(page_lines(spark, sf))


VALIDATE_SQL = f"""WITH {PAGE_LINES_SQL.strip()},
v AS (
SELECT page_id, url, CASE WHEN n_fields = 1 THEN 'HOST_NULL' ELSE {HOST_SQL} END AS host,
       CASE WHEN n_fields = 3 AND page_id % 10 <> 9 THEN 'ok' ELSE 'filtered' END AS status
FROM page_records)
"""


@query("page_validate", f"{VALIDATE_SQL} SELECT page_id, host, status FROM v")
def page_validate(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf).select("page_id", "host", "status")


SCRIPTED_SQL = f"""{VALIDATE_SQL}, s AS (
SELECT *, CASE WHEN status = 'ok' THEN CASE WHEN length(url) % 3 = 0 THEN 'extract'
  WHEN length(url) % 3 = 1 THEN 'empty' ELSE 'no_match' END END AS outcome FROM v)
"""


def _scripted(spark: SparkSession, sf: str) -> DataFrame:
    """Records with an outcome set by the length of their url."""
    third = F.length("url") % 3
    scripted = F.when(third == 0, EXTRACT).when(third == 1, EMPTY).otherwise(NO_MATCH)
    return _records(spark, sf).withColumn("outcome", F.when(F.col("status") == OK, scripted))


REPORT_COUNTS_SQL = """count(*) AS scan,
  count(*) FILTER (WHERE status = 'filtered') AS filtered,
  count(*) FILTER (WHERE outcome = 'extract') AS extract,
  count(*) FILTER (WHERE outcome = 'empty') AS empty_context,
  count(*) FILTER (WHERE outcome = 'no_match') AS no_match_xpath"""


@query(
    "host_report",
    f"{SCRIPTED_SQL} SELECT host, {REPORT_COUNTS_SQL}, {REPORT_TIME_SQL} FROM s GROUP BY host",
)
def host_report_query(spark: SparkSession, sf: str) -> DataFrame:
    return host_report(_scripted(spark, sf), _at())


@query(
    "report_upsert",
    f"{SCRIPTED_SQL} SELECT host, {REPORT_COUNTS_SQL}, {REPORT_TIME_SQL} FROM s GROUP BY host",
)
def report_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, pages by secure and by plain url, the second one replayed."""
    scripted = _scripted(spark, sf)
    secure = F.coalesce(F.startswith(F.col("url"), F.lit("https")), F.lit(False))
    path = scratch(spark, "report")
    for number, part in ((0, secure), (1, ~secure), (1, ~secure)):
        put_batch(host_report(scripted.filter(part), _at()), path, BatchKey("report", number))
    return merge_reports(spark.read.parquet(path))


@query(
    "report_commits",
    f"{SCRIPTED_SQL} SELECT host, {REPORT_COUNTS_SQL}, {REPORT_TIME_SQL} FROM s GROUP BY host",
)
def report_commits(spark: SparkSession, sf: str) -> DataFrame:
    """The report by commits: six batches of two writers, folded on the way, the first ones replayed."""
    scripted = _scripted(spark, sf)
    part = F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(6))
    root = scratch(spark, "report-commits")
    writers = [
        CommittedTable(spark, root, lambda rows, _: merge_reports(rows), fold_after=3) for _ in range(2)
    ]
    for number in (0, 1, 2, 3, 4, 5, 0, 1):
        run = BatchKey(f"writer-{number % 2}", number // 2)
        writers[number % 2].put(host_report(scripted.filter(part == number), _at()), run)
    return merge_reports(writers[0].read())


@query(
    "page_rule_match",
    f"""{VALIDATE_SQL}, r AS (SELECT DISTINCT {HOST_SQL} AS host FROM pages WHERE url LIKE 'https:%')
SELECT page_id, v.host, r.host IS NOT NULL AS has_rules FROM v LEFT JOIN r ON r.host = v.host""",
)
def page_rule_match(spark: SparkSession, sf: str) -> DataFrame:
    """Rules exist for the hosts of secure urls."""
    pages = table(spark, sf, "pages").filter(F.col("url").startswith("https:"))
    rules = pages.select(
        url_host("url").alias("host"), F.lit("//html/body/article").alias("xpath"),
        F.lit(True).alias("is_positive"), F.lit("machine").alias("origin"),
    )
    matched = lookup_join(_records(spark, sf), host_flags(rules), ["host"])
    return matched.select("page_id", "host", F.col("usable").isNotNull().alias("has_rules"))


@query(
    "page_rowkeys",
    f"""SELECT {HOST_SQL} || '_' || '202401020304050678' || '_' || md5(url) AS rowkey, page_id FROM pages""",
)
def page_rowkeys(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return pages.select(page_rowkey(url_host("url"), _at(), "url").alias("rowkey"), "page_id")


@query(
    "page_elements",
    f"""WITH RECURSIVE {tree_ctes('SELECT page_id, html FROM pages').strip()}
SELECT page_id, node, parent, last, depth, tag, id, cls, cut, own_text, text_len FROM nodes""",
)
def page_elements(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(table(spark, sf, "pages").select("page_id", "html"))
    return elements(with_tree(pages), ["page_id"])


MINED_SQL = f"""WITH RECURSIVE {PAGE_LINES_SQL.strip()},
{tree_ctes(VALID_PAGES).strip()},
{MINING_CTES.strip()}
"""


def _mined(spark: SparkSession, sf: str) -> DataFrame:
    learned = job.learned(_records(spark, sf), ("page_id", "host"))
    return materialized(learned, "learned").filter(F.col("mined").isNotNull())


@query(
    "page_main_block",
    f"{MINED_SQL} SELECT page_id, node AS block_node, tag AS block_tag, text_len AS block_len FROM block",
)
def page_main_block(spark: SparkSession, sf: str) -> DataFrame:
    return _mined(spark, sf).select("page_id", "mined.block_node", "mined.block_tag", "mined.block_len")


@query(
    "page_content_element",
    f"""{MINED_SQL} SELECT page_id, start_node, node AS content_node, tag AS content_tag,
  text_len AS content_len FROM content""",
)
def page_content_element(spark: SparkSession, sf: str) -> DataFrame:
    return _mined(spark, sf).select(
        "page_id", "mined.start_node", "mined.content_node", "mined.content_tag", "mined.content_len"
    )


@query("page_positive_xpath", f"{MINED_SQL} SELECT page_id, path AS xpath FROM content")
def page_positive_xpath(spark: SparkSession, sf: str) -> DataFrame:
    return _mined(spark, sf).select("page_id", "mined.xpath")


@query("page_negative_xpath", f"{MINED_SQL} SELECT page_id, xpath FROM negative")
def page_negative_xpath(spark: SparkSession, sf: str) -> DataFrame:
    return _mined(spark, sf).select("page_id", F.explode("mined.negatives").alias("xpath"))


RULES_SQL = f"{MINED_SQL}, {RULE_CTES.strip()}\n"


@query(
    "template_counters",
    f"""{RULES_SQL}
SELECT 'total' AS kind, host, '' AS xpath, CAST(sum(score) AS BIGINT) AS n FROM scores GROUP BY host
UNION ALL SELECT 'positive', host, xpath, score FROM scores
UNION ALL SELECT 'negative', host, xpath, 1 FROM negatives""",
)
def template_counters(spark: SparkSession, sf: str) -> DataFrame:
    return templates.counter_deltas(_mined(spark, sf))


@query(
    "top_templates",
    f"{RULES_SQL} SELECT host, xpath, score, CAST(rank AS INTEGER) AS rank FROM ranks WHERE rank <= 2",
)
def top_templates(spark: SparkSession, sf: str) -> DataFrame:
    return templates.top_members(templates.positive_scores(_mined(spark, sf)), 2)


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """Stored, so that filters above do not evaluate the extraction again."""
    pages = job.mined_pages(_records(spark, sf))
    return materialized(job.page_results(pages, job.learn_rules(pages)), "page-results")


def _indexed_page_results(spark: SparkSession, sf: str) -> DataFrame:
    """The same rules through the index, whatever their size."""
    pages = job.mined_pages(_records(spark, sf))
    return job.page_results(pages, materialized(job.learn_rules(pages), "rules"), limit_bytes=-1)


EXTRACTED_SQL = f"{RULES_SQL}, {EXTRACT_CTES.strip()}\n"


@query(
    "page_extract_text",
    f"{EXTRACTED_SQL} SELECT page_id, content FROM outcomes WHERE content IS NOT NULL",
)
def page_extract_text(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf).filter(F.col("content").isNotNull()).select("page_id", "content")


@query(
    "page_indexed_rules",
    f"{EXTRACTED_SQL} SELECT page_id, host, status, outcome, content FROM outcomes",
)
def page_indexed_rules(spark: SparkSession, sf: str) -> DataFrame:
    return _indexed_page_results(spark, sf).select("page_id", "host", "status", "outcome", "content")


@query("page_outcome", f"{EXTRACTED_SQL} SELECT page_id, host, status, outcome FROM outcomes")
def page_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf).select("page_id", "host", "status", "outcome")


DOMAIN_SQL = "regexp_extract(host, '([^.]+\\.(com|net|org))$', 1)"


@query(
    "page_documents",
    f"""{EXTRACTED_SQL} SELECT url, md5(url) AS url_md5, host, {DOMAIN_SQL} AS domain,
  '2024-01-02 03:04:05' AS date, content FROM outcomes WHERE outcome = 'extract'""",
)
def page_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents(_results(spark, sf), _at())


@query(
    "page_storage",
    f"""{EXTRACTED_SQL} SELECT host || '_202401020304050678_' || md5(url) AS rowkey, url AS i_url,
  {DOMAIN_SQL} AS i_domain, host AS i_host, content AS c_content, html AS h_html
FROM outcomes WHERE outcome = 'extract'""",
)
def page_storage(spark: SparkSession, sf: str) -> DataFrame:
    return storage_rows(_results(spark, sf), _at())


PAGE_REPORT_SQL = f"""{EXTRACTED_SQL}
SELECT host, {REPORT_COUNTS_SQL}, {REPORT_TIME_SQL} FROM outcomes GROUP BY host"""


@query("page_report", PAGE_REPORT_SQL)
def page_report(spark: SparkSession, sf: str) -> DataFrame:
    """The batch job end to end: learn rules, store all tables, read the report."""
    pages = job.mined_pages(_records(spark, sf))
    rules = materialized(job.learn_rules(pages), "rules")
    tables = job.PageTables(scratch(spark, "page-job"))
    job.run_batch(pages, rules, SCAN_TIME, tables, job.run_key(SCAN_TIME))
    return job.total_report(spark, tables)


@query("stream_page_report", PAGE_REPORT_SQL)
def stream_page_report(spark: SparkSession, sf: str) -> DataFrame:
    """The same job over streamed record lines, with rules read from a rule folder."""
    lines = page_lines(spark, sf).select("value")
    rules = job.learn_rules(validate(parse_records(lines)))
    rule_path = staged(templates.rule_lines(rules), "rule-files", "text")
    path, per_trigger = staged_stream(lines, "page-lines")
    tables = job.PageTables(scratch(spark, "page-stream"))
    job.start_stream(
        line_files(spark, path, files_per_trigger=per_trigger),
        lambda session: read_rules(session, rule_path),
        tables,
        scratch(spark, "page-stream-checkpoint"),
        clock=lambda: SCAN_TIME.timestamp(),
    ).awaitTermination()
    return job.total_report(spark, tables)
