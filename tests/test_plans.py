"""Plan shapes that must hold: what is pushed down, what is shuffled, what never appears."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from millrace.operators import counts as C
from millrace.operators import sorts as S
from millrace.pages import job
from millrace.pages.records import parse_records, validate
from millrace.plans.inputs import page_lines
from millrace.runtime import materialized

SMOKE = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|range|RoundRobin|SinglePartition)", plan(df)))


@pytest.mark.parametrize(
    "name",
    ["word_count", "top_k_per_key", "sql_inner_join", "kv_upsert", "collect_by_key", "cogroup_lists",
     "distinct_per_key", "offset_reconcile", "page_validate", "host_report", "window_sum"],
)
def test_no_cross_join_and_no_single_task(spark, name):
    text = plan(queries()[name](spark, SMOKE))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Exchange SinglePartition" not in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_word_count_combines_before_one_shuffle(spark):
    df = C.word_count(C.lines_of(spark.read.parquet(f"{SMOKE}/documents.parquet"), "text"))
    assert exchanges(df) == 1 and plan(df).count("HashAggregate") == 2
    assert "ReadSchema: struct<text:string>" in plan(df)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(queries()["in_list_count"](spark, SMOKE))
    assert "In(l_linenumber, [1,5,8])" in text and "ReadSchema: struct<l_linenumber:int>" in text


def test_top_k_is_limited_before_the_shuffle(spark):
    text = plan(queries()["top_k_per_key"](spark, SMOKE))
    assert text.count("WindowGroupLimit") == 2


def test_first_n_keeps_n_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(queries()["first_n"](spark, SMOKE))


def test_distinct_takes_two_shuffles_either_way(spark):
    events = spark.read.parquet(f"{SMOKE}/events.parquet")
    assert exchanges(C.distinct_per_key(events, "event_type", "user_id")) == 2
    assert exchanges(C.distinct_two_level(events, "event_type", "user_id")) == 2


def test_learning_and_extracting_never_shuffle_pages(spark):
    lines = page_lines(spark, SMOKE).select("page_id", "value")
    records = validate(parse_records(materialized(lines, "lines")))
    assert exchanges(job.learned(records)) == 0
    rules = spark.createDataFrame(
        [("h", "//p", True, "man")], "host STRING, xpath STRING, is_positive BOOLEAN, origin STRING"
    )
    text = plan(job.page_results(records, rules))
    pages_side = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in pages_side
    assert text.count("MapInArrow") == 1


def test_positions_have_no_single_task_window_over_rows(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("v"))
    text = plan(S.with_positions(df, [F.col("v").asc()]))
    # The only single-task window runs over one row per partition, behind an aggregation.
    assert text.count("Exchange SinglePartition") <= 1
