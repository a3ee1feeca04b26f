"""Rules met through the index, against rules gathered by host."""

from pyspark.sql import functions as F

from millrace.pages import job
from millrace.pages.elements import with_tree
from millrace.pages.records import parse_records, validate
from millrace.pages.rule_index import (
    PAGE,
    host_flags,
    met_rules,
    page_keys,
    rule_index,
    with_met_rules,
)
from millrace.runtime import lookup_join, materialized
from tests.test_pages import page_records

RULES = "host STRING, xpath STRING, is_positive BOOLEAN, origin STRING"


def rule_rows(spark, n_unrelated):
    few = [
        ("h0.com", "//html/body/article", True, "man"), ("h0.com", "//body/article/p[text()*=来源]", False, "m"),
        ("h0.com", "//div[@id='main']/p", False, "m"), ("h1.com", "//html/body/article", True, "m"),
        ("h1.com", "not a path", False, "m"), ("h3.com", "//p", True, "m"), (None, "//p", True, "m"),
        ("h0.com", "//article/span", False, "m"), ("h0.com", "//article/span", False, "again"),
    ]
    many = spark.range(n_unrelated).select(
        F.lit("h0.com").alias("host"), F.concat(F.lit("//div[@class='c"), "id", F.lit("']/p")).alias("xpath"),
        F.lit(False).alias("is_positive"), F.lit("machine").alias("origin"),
    )
    return spark.createDataFrame(few, RULES).unionByName(many)


def test_index_and_host_rows_extract_the_same(spark):
    records = validate(parse_records(page_records(spark)))
    rules = materialized(rule_rows(spark, 300), "rules")
    columns = ["url", "host", "status", "mined", "content", "outcome"]
    small, large = (
        sorted(map(str, job.page_results(records, rules, limit).select(*columns).collect()))
        for limit in (1 << 30, -1)
    )
    assert small == large and len(small) == 13
    assert any("extract" in r for r in small) and any("empty" in r for r in small)
    assert any("no_match" in r for r in small)


def test_a_rule_is_indexed_by_its_rarest_step(spark):
    keys = {r.xpath: r.key for r in rule_index(rule_rows(spark, 50)).filter("host = 'h0.com'").collect()}
    assert keys["//div[@class='c7']/p"] == "div|class|c7"
    assert keys["//div[@id='main']/p"] == "div|id|main" and len(keys) == 54
    assert {(r.host, r.usable) for r in host_flags(rule_rows(spark, 1)).collect()} == {
        ("h0.com", True), ("h1.com", False), ("h3.com", True), (None, True),
    }


def test_pages_of_a_host_with_many_rules_meet_few(spark):
    """No row grows with the rules of a host."""
    records = validate(parse_records(page_records(spark))).filter("status = 'ok'")
    pages = materialized(
        with_tree(records.withColumn(PAGE, F.monotonically_increasing_id())).select(
            PAGE, "host", page_keys().alias("keys")
        ),
        "keys",
    )
    met = met_rules(pages, materialized(rule_rows(spark, 20_000), "rules"))
    sizes = met.agg(F.max(F.size("negative")), F.max(F.size("positive")), F.count("*")).first()
    assert sizes[0] <= 3 and sizes[1] == 1 and sizes[2] == 8


def test_no_rules_and_no_pages(spark):
    records = validate(parse_records(page_records(spark)))
    none = spark.createDataFrame([], RULES)
    got = job.page_results(records, none, -1).groupBy("outcome").count().collect()
    assert {r["outcome"]: r["count"] for r in got} == {"no_match": 12, None: 1}
    assert job.page_results(records.limit(0), rule_rows(spark, 2), -1).count() == 0


def test_pages_are_split_and_mined_once(spark):
    """Results of pages stored with their facts are those of the records, and do not mine again."""
    records = validate(parse_records(page_records(spark)))
    pages = job.mined_pages(records)
    rules = materialized(job.learn_rules(pages), "rules")
    assert sorted(map(str, rules.collect())) == sorted(map(str, job.learn_rules(records).collect()))
    for limit in (1 << 30, -1):
        again = job.page_results(pages, rules, limit)
        whole = job.page_results(records, rules, limit)
        assert sorted(again.columns) == sorted(whole.columns)
        assert sorted(map(str, again.collect())) == sorted(map(str, whole.select(again.columns).collect()))
        assert "block_len" not in again.select("content")._jdf.queryExecution().optimizedPlan().toString()


def test_rules_met_by_pages_are_never_broadcast(spark):
    """A row per page, whatever its files take: equal rules of many pages are stored once."""
    records = validate(parse_records(page_records(spark)))
    pages = job.mined_pages(records)
    ruled = with_met_rules(pages, pages.select(PAGE, "host", "keys"), materialized(rule_rows(spark, 20), "rules"))
    plan = ruled._jdf.queryExecution().sparkPlan().toString()
    assert f"SortMergeJoin [{PAGE}#" in plan
    assert ruled.count() == records.count()


def test_a_lookup_beyond_the_limit_is_never_broadcast(spark):
    big = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    lookup = materialized(spark.range(50).select(F.col("id").alias("k"), F.lit("x" * 100).alias("v")), "lookup")
    joined = lookup_join(big, lookup, ["k"], "left", limit_bytes=100)
    assert "SortMergeJoin [k#" in joined._jdf.queryExecution().sparkPlan().toString()
    assert joined.filter("length(v) = 100").count() == 1000
