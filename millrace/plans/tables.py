"""Queries of the batch and table family."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import (
    is_blank,
    is_empty_collection,
    java_split,
    register_sql_functions,
    suffix_route,
)
from millrace.functions.urls import url_domain, url_host
from millrace.functions import keys as K
from millrace.operators import counts as C
from millrace.operators import joins as J
from millrace.operators import partitions as P
from millrace.operators import sorts as S
from millrace.operators.offsets import reconcile
from millrace.plans.inputs import (
    APP_INSTALLS_SQL,
    COUNTRY_NUMS_SQL,
    app_installs,
    conversation_lines,
    country_nums,
    document_lines,
    event_lines,
    staged,
)
from millrace.plans.registry import query, table
from millrace.runtime import materialized, scratch
from millrace.sinks.commits import CommittedTable
from millrace.sinks import files as sinks
from millrace.sinks import keyed, puts
from millrace.sources import catalog, files
from millrace.sources import queue as Q


def _tokens_sql(source: str, column: str = "text") -> str:
    return f"""
lines AS (SELECT unnest(string_split({column}, chr(10))) AS line FROM {source}),
cut AS (SELECT line, regexp_replace(line, ' +$', '') AS body FROM lines),
tok AS (SELECT unnest(string_split(body, ' ')) AS word FROM cut WHERE body <> '' OR line = '')
"""


WORD_COUNT_SQL = f"""
WITH {_tokens_sql('documents')}
SELECT word, count(*) AS n FROM tok GROUP BY word
"""


@query("word_count", WORD_COUNT_SQL)
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return C.word_count(document_lines(spark, sf))


@query("word_count_partitioned", WORD_COUNT_SQL)
def word_count_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    path = staged(document_lines(spark, sf), "lines", "text")
    return C.word_count(files.read_lines(spark, path, min_partitions=8), reducers=4)


@query(
    "word_count_sorted",
    f"""
WITH {_tokens_sql('conversations')}, c AS (SELECT word, count(*) AS n FROM tok GROUP BY word)
SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS position FROM c
""",
)
def word_count_sorted(spark: SparkSession, sf: str) -> DataFrame:
    counted = C.word_count(conversation_lines(spark, sf))
    return S.with_positions(counted, [F.col("n").desc(), F.col("word").asc()])


@query(
    "java_split_tokens",
    """
WITH cut AS (
  SELECT doc_id, text, regexp_replace(text, ' +$', '') AS a, regexp_replace(text, ',+$', '') AS b
  FROM documents),
tok AS (
  SELECT doc_id, CASE WHEN text = '' THEN [''] WHEN a = '' THEN [] ELSE string_split(a, ' ') END AS s,
         CASE WHEN text = '' THEN [''] WHEN b = '' THEN [] ELSE string_split(b, ',') END AS c
  FROM cut)
SELECT doc_id, CAST(len(s) AS INTEGER) AS n_space, CAST(len(c) AS INTEGER) AS n_comma,
       md5(array_to_string(c, '|')) AS comma_key
FROM tok
""",
)
def java_split_tokens(spark: SparkSession, sf: str) -> DataFrame:
    by_comma = java_split("text", ",")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.size(java_split("text", " ")).alias("n_space"),
        F.size(by_comma).alias("n_comma"),
        F.md5(F.array_join(by_comma, "|")).alias("comma_key"),
    )


@query(
    "secondary_sort",
    """
WITH lines AS (
  SELECT '(' || p_brand || ',' || p_size || ')' AS line FROM part
  UNION ALL SELECT p_name FROM part),
pairs AS (
  SELECT split_part(substr(line, 2, length(line) - 2), ',', 1) AS word,
         CAST(split_part(substr(line, 2, length(line) - 2), ',', 2) AS INTEGER) AS num
  FROM lines WHERE line LIKE '(%' AND line LIKE '%)')
SELECT word, num, row_number() OVER (ORDER BY word DESC, num) AS position FROM pairs
""",
)
def secondary_sort(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    pair = F.concat(F.lit("("), "p_brand", F.lit(","), F.col("p_size").cast("string"), F.lit(")"))
    lines = part.select(pair.alias("value")).unionByName(part.select(F.col("p_name").alias("value")))
    return S.with_positions(S.parse_pairs(lines), [F.col("word").desc(), F.col("num").asc()])


@query(
    "in_list_count",
    "SELECT l_linenumber, count(*) AS n FROM lineitem WHERE l_linenumber IN (1, 5, 8) GROUP BY 1",
)
def in_list_count(spark: SparkSession, sf: str) -> DataFrame:
    return C.value_count(C.in_list(table(spark, sf, "lineitem"), "l_linenumber", [1, 5, 8]), "l_linenumber")


@query("map_times_ten", "SELECT o_orderkey, o_orderkey * 10 AS times_ten FROM orders")
def map_times_ten(spark: SparkSession, sf: str) -> DataFrame:
    tenfold = P.times(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 10, "times_ten")
    return P.cut_lineage(tenfold)


@query(
    "range_rows",
    "SELECT unnest(range(lo, hi + 1)) AS id FROM (SELECT min(c_custkey) AS lo, max(c_custkey) AS hi FROM customer)",
)
def range_rows(spark: SparkSession, sf: str) -> DataFrame:
    return P.id_range(table(spark, sf, "customer"), "c_custkey")


@query(
    "collect_by_key",
    """
WITH d AS (SELECT o_orderpriority, o_custkey, count(*) AS copies FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, o_custkey // 256 AS chunk,
       string_agg(CAST(o_custkey AS VARCHAR), ',' ORDER BY o_custkey) AS members,
       string_agg(CAST(copies AS VARCHAR), ',' ORDER BY o_custkey) AS member_copies,
       CAST(sum(copies) AS BIGINT) AS n_rows
FROM d GROUP BY 1, 2
""",
)
def collect_by_key(spark: SparkSession, sf: str) -> DataFrame:
    lists = C.chunked_lists(table(spark, sf, "orders"), "o_orderpriority", "o_custkey", 256)
    return lists.select(
        "o_orderpriority", "chunk",
        F.array_join(F.col("values").cast("array<string>"), ",").alias("members"),
        F.array_join(F.col("copies").cast("array<string>"), ",").alias("member_copies"), "n_rows",
    )


COGROUP_WIDTH = 512
COGROUP_SQL = """
WITH s AS (
  SELECT c_nationkey AS nation, c_custkey AS id, 1 AS l FROM customer
  UNION ALL SELECT s_nationkey, s_suppkey, 0 FROM supplier),
d AS (SELECT nation, id, l, count(*) AS n FROM s GROUP BY ALL)
SELECT nation, id // 512 AS chunk,
       coalesce(string_agg(CASE WHEN l = 1 THEN CAST(id AS VARCHAR) END, ',' ORDER BY id), '') AS customers,
       coalesce(string_agg(CASE WHEN l = 1 THEN CAST(n AS VARCHAR) END, ',' ORDER BY id), '') AS customer_copies,
       coalesce(string_agg(CASE WHEN l = 0 THEN CAST(id AS VARCHAR) END, ',' ORDER BY id), '') AS suppliers,
       coalesce(string_agg(CASE WHEN l = 0 THEN CAST(n AS VARCHAR) END, ',' ORDER BY id), '') AS supplier_copies,
       CAST(sum(l * n) AS BIGINT) AS n_customers, CAST(sum((1 - l) * n) AS BIGINT) AS n_suppliers
FROM d GROUP BY 1, 2
"""


def cogroup_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers and suppliers as (nation, id)."""
    return (
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("id")),
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id")),
    )


def cogroup_columns(both: DataFrame) -> DataFrame:
    """A cogroup's lists as text."""
    return both.select(
        "nation", "chunk",
        F.array_join(F.col("left_values").cast("array<string>"), ",").alias("customers"),
        F.array_join(F.col("left_copies").cast("array<string>"), ",").alias("customer_copies"),
        F.array_join(F.col("right_values").cast("array<string>"), ",").alias("suppliers"),
        F.array_join(F.col("right_copies").cast("array<string>"), ",").alias("supplier_copies"),
        F.col("left_rows").alias("n_customers"),
        F.col("right_rows").alias("n_suppliers"),
    )


@query("cogroup_lists", COGROUP_SQL)
def cogroup_lists(spark: SparkSession, sf: str) -> DataFrame:
    return cogroup_columns(J.chunked_cogroup(*cogroup_sides(spark, sf), "nation", "id", COGROUP_WIDTH))


@query(
    "sum_count_mean",
    "SELECT sum(l_quantity) AS total, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean FROM lineitem",
)
def sum_count_mean(spark: SparkSession, sf: str) -> DataFrame:
    return C.sum_count_mean(table(spark, sf, "lineitem"), "l_quantity").withColumn(
        "mean", F.round("mean", 6)
    )


@query(
    "sum_by_word",
    """SELECT l_returnflag || l_linestatus AS word, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total
FROM lineitem GROUP BY 1""",
)
def sum_by_word(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("word"),
        F.col("l_quantity").cast("long").alias("num"),
    )
    return C.sum_by_word(pairs)


DISTINCT_SQL = "SELECT event_type, count(DISTINCT user_id) AS n_distinct FROM events GROUP BY 1"


@query("distinct_per_key", DISTINCT_SQL)
def distinct_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return C.distinct_per_key(table(spark, sf, "events"), "event_type", "user_id")


@query("distinct_two_level", DISTINCT_SQL)
def distinct_two_level(spark: SparkSession, sf: str) -> DataFrame:
    return C.distinct_two_level(table(spark, sf, "events"), "event_type", "user_id")


@query(
    "sum_of_group_counts",
    """SELECT CAST(sum(num) AS BIGINT) AS total
FROM (SELECT l_partkey, count(*) AS num FROM lineitem GROUP BY 1)""",
)
def sum_of_group_counts(spark: SparkSession, sf: str) -> DataFrame:
    return C.sum_of_group_counts(table(spark, sf, "lineitem"), "l_partkey")


@query(
    "partition_profile",
    """SELECT 'repartition' AS stage, 8 AS n_parts, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'coalesce', 2, count(*) FROM lineitem""",
)
def partition_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Partitions and rows after going up to 8 partitions, and back down to 2."""
    spread = P.widen(table(spark, sf, "lineitem"), 8, "l_orderkey")
    stages = [("repartition", spread), ("coalesce", P.narrow(spread, 2))]
    return J.union_many(
        [
            P.partition_profile(df).agg(
                F.lit(stage).alias("stage"),
                F.count("*").cast("int").alias("n_parts"),
                F.sum("n_rows").alias("n_rows"),
            )
            for stage, df in stages
        ]
    )


@query(
    "range_partition_bounds",
    """SELECT 4 AS n_parts, min(o_custkey) AS least, max(o_custkey) AS greatest,
       count(*) AS n_rows, 0 AS overlaps FROM orders""",
)
def range_partition_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Four range partitions hold all rows and do not overlap."""
    return P.range_summary(P.range_bounds(table(spark, sf, "orders"), "o_custkey", 4))


@query(
    "top_k_per_key",
    """
WITH c AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id DESC) AS rank FROM c)
SELECT event_type, user_id, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3
""",
)
def top_k_per_key(spark: SparkSession, sf: str) -> DataFrame:
    counted = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return S.top_k_per_key(counted, "event_type", [F.col("n").desc(), F.col("user_id").desc()], 3)


@query(
    "first_n",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
)
def first_n(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return S.first_n(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


@query(
    "union_many",
    """SELECT 'customer' AS kind, c_name AS name FROM customer
UNION ALL SELECT 'supplier', s_name FROM supplier UNION ALL SELECT 'part', p_name FROM part""",
)
def union_many(spark: SparkSession, sf: str) -> DataFrame:
    return J.union_many(
        [
            table(spark, sf, t).select(F.lit(t).alias("kind"), F.col(c).alias("name"))
            for t, c in (("customer", "c_name"), ("supplier", "s_name"), ("part", "p_name"))
        ]
    )


@query(
    "text_roundtrip",
    """SELECT value, count(*) AS n
FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents) GROUP BY value""",
)
def text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "text")
    sinks.write_text(document_lines(spark, sf), path)
    return C.value_count(files.read_lines(spark, path), "value")


@query("select_column", f"SELECT country FROM ({COUNTRY_NUMS_SQL})")
def select_column(spark: SparkSession, sf: str) -> DataFrame:
    return country_nums(spark, sf).select("country")


@query("select_arith_alias", f"SELECT country, num + 1 AS num1 FROM ({COUNTRY_NUMS_SQL})")
def select_arith_alias(spark: SparkSession, sf: str) -> DataFrame:
    return country_nums(spark, sf).select("country", (F.col("num") + 1).alias("num1"))


@query("filter_lt", f"SELECT country, num FROM ({COUNTRY_NUMS_SQL}) WHERE num < 2")
def filter_lt(spark: SparkSession, sf: str) -> DataFrame:
    return country_nums(spark, sf).filter(F.col("num") < 2)


@query("filter_like_count", "SELECT count(*) AS num FROM customer WHERE c_mktsegment LIKE '%MACH%'")
def filter_like_count(spark: SparkSession, sf: str) -> DataFrame:
    app_installs(spark, sf).createOrReplaceTempView("installs")
    return spark.sql("SELECT count(*) AS num FROM installs WHERE gpcategory LIKE '%MACH%'")


@query(
    "typed_text_rows",
    """SELECT CAST(c_nationkey AS VARCHAR) AS country, c_mktsegment AS gpcategory,
       c_name AS pkgname, CAST(c_custkey % 5 AS INTEGER) AS num FROM customer""",
)
def typed_text_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.concat_ws(
            "\t", F.col("c_nationkey").cast("string"), "c_mktsegment", "c_name",
            (F.col("c_custkey") % 5).cast("string"),
        ).alias("value")
    )
    path = staged(rows, "typed", "text")
    return files.read_typed_text(
        spark, path, "country STRING, gpcategory STRING, pkgname STRING, num INT"
    )


@query(
    "name_length",
    """SELECT doc_id, CAST(length(text)
  + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) AS INTEGER) AS n_units
FROM documents""",
)
def name_length(spark: SparkSession, sf: str) -> DataFrame:
    register_sql_functions(spark)
    table(spark, sf, "documents").createOrReplaceTempView("named_texts")
    return spark.sql("SELECT doc_id, name_length(text) AS n_units FROM named_texts")


JOIN_SQL = """SELECT c.*, o.* FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey"""


@query("sql_inner_join", JOIN_SQL)
def sql_inner_join(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "customer").createOrReplaceTempView("joined_customer")
    table(spark, sf, "orders").createOrReplaceTempView("joined_orders")
    return spark.sql("SELECT * FROM joined_customer JOIN joined_orders ON c_custkey = o_custkey")


@query("api_inner_join", JOIN_SQL)
def api_inner_join(spark: SparkSession, sf: str) -> DataFrame:
    return J.inner_join(
        table(spark, sf, "customer"), table(spark, sf, "orders"), "c_custkey", "o_custkey"
    )


@query(
    "csv_join_export",
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice, o_orderpriority
FROM customer JOIN orders ON c_custkey = o_custkey""",
)
def csv_join_export(spark: SparkSession, sf: str) -> DataFrame:
    joined = J.inner_join(
        table(spark, sf, "customer"), table(spark, sf, "orders"), "c_custkey", "o_custkey"
    ).select("c_custkey", "c_name", "o_orderkey", "o_totalprice", "o_orderpriority")
    path = scratch(spark, "csv")
    sinks.write_csv(joined, path)
    return spark.read.schema(joined.schema).option("header", True).csv(path)


@query(
    "json_country_count",
    f"SELECT country, count(*) AS n FROM ({COUNTRY_NUMS_SQL}) GROUP BY country",
)
def json_country_count(spark: SparkSession, sf: str) -> DataFrame:
    path = staged(country_nums(spark, sf), "json", "json")
    return C.value_count(files.read_json(spark, path), "country")


HAVING_SQL = f"""SELECT country, count(*) AS num FROM ({APP_INSTALLS_SQL})
GROUP BY country HAVING count(*) > 5"""


@query("orc_group_having", f"{HAVING_SQL} AND country IS NOT NULL")
def orc_group_having(spark: SparkSession, sf: str) -> DataFrame:
    path = staged(app_installs(spark, sf), "orc", "orc")
    files.read_orc(spark, path).createOrReplaceTempView("installs_orc")
    return spark.sql(
        "SELECT country, count(*) AS num FROM installs_orc "
        "WHERE country NOT IN ('', 'null') GROUP BY country HAVING num > 5"
    )


@query("orc_declared_schema", f"SELECT * FROM ({APP_INSTALLS_SQL})")
def orc_declared_schema(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_app_installs(spark, staged(app_installs(spark, sf), "orc", "orc"))


@query("catalog_table_group_having", HAVING_SQL)
def catalog_table_group_having(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "catalog")
    database = "millrace_" + path.rsplit("-", 1)[1]
    catalog.use_database(spark, database, path)
    name = f"`{database}`.installs"
    catalog.create_orc_table(spark, name, files.APP_INSTALL_DDL)
    source = files.read_app_installs(spark, staged(app_installs(spark, sf), "orc", "orc"))
    catalog.load_overwrite(source, name)
    groups = spark.sql(
        f"SELECT country, count(*) AS num FROM {name} GROUP BY country HAVING num > 5"
    )
    try:
        return materialized(groups, "catalog-groups")
    finally:
        catalog.drop_database(spark, database)


@query(
    "dual_sink_roundtrip",
    f"""WITH t AS ({HAVING_SQL})
SELECT 'orc' AS sink, country, num FROM t UNION ALL SELECT 'json', country, num FROM t""",
)
def dual_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    source = files.read_app_installs(spark, staged(app_installs(spark, sf), "orc", "orc"))
    result = C.groups_over(source, "country", 5)
    orc, json = scratch(spark, "dual-orc"), scratch(spark, "dual-json")
    sinks.write_orc_and_json(result, orc, json)
    read = [("orc", spark.read.schema(result.schema).orc(orc)),
            ("json", spark.read.schema(result.schema).json(json))]
    return J.union_many([df.select(F.lit(s).alias("sink"), "country", "num") for s, df in read])


@query(
    "tsv_export",
    f"""SELECT country || chr(9) || num AS value FROM
  (SELECT country, count(*) AS num FROM ({COUNTRY_NUMS_SQL}) GROUP BY country)""",
)
def tsv_export(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "tsv")
    sinks.write_tsv(C.value_count(country_nums(spark, sf), "country", "num"), path)
    return files.read_lines(spark, path)


@query(
    "dict_last_wins",
    """SELECT CAST(c_nationkey AS VARCHAR) AS code, arg_max(c_name, c_custkey) AS name
FROM customer GROUP BY 1""",
)
def dict_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("code"), F.col("c_name").alias("name"),
        F.col("c_custkey").alias("line"),
    )
    return files.last_wins(rows, "code", "name", "line")


def _dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Nations of the first three regions, stored as a dictionary file and read back."""
    lines = (
        table(spark, sf, "nation")
        .filter(F.col("n_regionkey") < 3)
        .select(F.concat_ws("\t", F.col("n_nationkey").cast("string"), "n_name").alias("value"))
    )
    return files.read_dictionary(spark, staged(lines, "dictionary", "text"))


MAP_JOIN_SQL = f"""SELECT i.country AS code, n.n_name AS name
FROM ({APP_INSTALLS_SQL}) i JOIN nation n
  ON i.country = CAST(n.n_nationkey AS VARCHAR) AND n.n_regionkey < 3"""


@query("map_join", MAP_JOIN_SQL)
def map_join(spark: SparkSession, sf: str) -> DataFrame:
    installs = files.read_app_installs(spark, staged(app_installs(spark, sf), "orc", "orc"))
    joined = J.map_join(installs, _dictionary(spark, sf))
    out = scratch(spark, "map-join")
    sinks.write_orc(J.matched_names(joined), out)
    return spark.read.schema("code STRING, name STRING").orc(out)


@query(
    "map_join_match_counts",
    f"""SELECT count(n.n_name) AS matched, count(*) - count(n.n_name) AS unmatched
FROM ({APP_INSTALLS_SQL}) i LEFT JOIN nation n
  ON i.country = CAST(n.n_nationkey AS VARCHAR) AND n.n_regionkey < 3""",
)
def map_join_match_counts(spark: SparkSession, sf: str) -> DataFrame:
    installs = files.read_app_installs(spark, staged(app_installs(spark, sf), "orc", "orc"))
    joined = J.map_join(installs, _dictionary(spark, sf))
    return C.match_counts(joined, F.col("name").isNotNull())


@query(
    "lookup_dir_load",
    "SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name FROM supplier",
)
def lookup_dir_load(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier")
    key = F.col("s_suppkey").cast("string")
    good = supplier.select(F.concat_ws(" ", key, "s_name").alias("value"))
    broken = supplier.select(F.concat_ws(" ", key, "s_name", F.lit("old")).alias("value"))
    return files.read_lookup_dir(spark, staged(good.unionByName(broken), "lookup", "text"))


@query(
    "rule_config_load",
    r"""SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host,
       '//html/body/article' AS xpath, true AS is_positive, 'machine' AS origin FROM pages""",
)
def rule_config_load(spark: SparkSession, sf: str) -> DataFrame:
    host = url_host("url")
    pages = table(spark, sf, "pages")
    path = F.lit("//html/body/article")
    good = pages.select(F.concat_ws("\t", host, path, F.lit("true"), F.lit("machine")).alias("value"))
    broken = pages.select(F.concat_ws("\t", host, path, F.lit("true")).alias("value"))
    return files.read_rules(spark, staged(good.unionByName(broken), "rules", "text"))


@query(
    "payload_decode",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
)
def payload_decode(spark: SparkSession, sf: str) -> DataFrame:
    records = table(spark, sf, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    return Q.decode_payload(records, "k INT").select("event_id", "payload.k")


@query(
    "queue_records",
    """SELECT 'msg_' || event_id AS key,
       '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value,
       CAST(event_id % 2 AS INTEGER) AS partition
FROM events""",
)
def queue_records(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    message = K.prefixed_key("msg", "event_id")
    return Q.queue_records(events, key=message, partition=suffix_route(message))


@query(
    "route_by_suffix",
    "SELECT event_id, CAST(event_id % 2 AS INTEGER) AS bucket FROM events",
)
def route_by_suffix(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", suffix_route(K.prefixed_key("msg", "event_id")).alias("bucket")
    )


@query(
    "is_empty_flags",
    """
WITH d AS (SELECT conv_id, turn, text, nullif(role, 'assistant') AS who,
                  regexp_replace(text, '[^ \\n]', '', 'g') AS gaps FROM conversations)
SELECT conv_id, turn, regexp_replace(text, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') = '' AS no_text,
       who IS NULL AS no_who, turn % 2 = 0 AS no_gaps,
       regexp_replace(gaps, ' +$', '') = '' AND gaps <> '' AS no_tokens
FROM d
""",
)
def is_empty_flags(spark: SparkSession, sf: str) -> DataFrame:
    derived = table(spark, sf, "conversations").withColumns(
        {
            "who": F.nullif(F.col("role"), F.lit("assistant")),
            "gaps": F.regexp_replace("text", "[^ \\n]", ""),
        }
    )
    return derived.select(
        "conv_id", "turn",
        is_blank("text").alias("no_text"),
        is_blank("who").alias("no_who"),
        # Blank on even turns; on odd ones a mark follows the gaps.
        is_blank(F.concat("gaps", F.when(F.col("turn") % 2 == 0, "").otherwise("."))).alias("no_gaps"),
        is_empty_collection(java_split("gaps", " ")).alias("no_tokens"),
    )


@query("url_host", r"SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host FROM pages")
def url_host_query(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", url_host("url").alias("host"))


@query(
    "url_domain",
    r"""
WITH h AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host FROM pages
  UNION ALL SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) || '.cn' FROM pages),
l AS (SELECT page_id, host, string_split(host, '.') AS a FROM h),
c AS (
  SELECT page_id, host, a, unnest(range(1, len(a))) AS i FROM l),
k AS (
  SELECT page_id, host, min(i) AS i FROM c
  WHERE array_to_string(a[i + 1:], '.') IN
    ('com','org','net','gov','edu','co','cn','com.cn','edu.cn','gov.cn','net.cn','org.cn')
  GROUP BY page_id, host)
SELECT l.page_id, l.host,
       CASE WHEN k.i IS NULL THEN a[len(a)] ELSE array_to_string(a[k.i:], '.') END AS domain
FROM l LEFT JOIN k ON l.page_id = k.page_id AND l.host = k.host
""",
)
def url_domain_query(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", url_host("url").alias("host"))
    hosts = pages.unionByName(pages.withColumn("host", F.concat("host", F.lit(".cn"))))
    return hosts.select(
        "page_id", "host", url_domain(F.concat(F.lit("http://"), "host", F.lit("/"))).alias("domain")
    )


@query(
    "time_keys",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second,
       strftime(ts, '%Y%m%d%H%M%S') || lpad(strftime(ts, '%g'), 4, '0') AS put_time,
       CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS scan_day, CAST(strftime(ts, '%H') AS INTEGER) AS scan_hour,
       md5(strftime(ts, '%Y%m%d%H')) AS hour_md5 FROM events""",
)
def time_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        K.minute_stamp("ts").alias("minute"),
        K.second_stamp("ts").alias("second"),
        K.put_stamp("ts").alias("put_time"),
        K.scan_day("ts").alias("scan_day"),
        K.scan_hour("ts").alias("scan_hour"),
        K.hour_md5("ts").alias("hour_md5"),
    )


def _puts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """First version of every order, second version of the finished ones."""
    orders = table(spark, sf, "orders")
    key = K.prefixed_key("spark_write", "o_orderkey")
    first = orders.select(
        key.alias("rowkey"), F.lit(1).cast("long").alias("version"),
        F.col("o_totalprice").cast("string").alias("cf_count"),
    )
    second = orders.filter(F.col("o_orderstatus") == "F").select(
        key.alias("rowkey"), F.lit(2).cast("long").alias("version"),
        F.col("o_custkey").cast("string").alias("cf_count"),
    )
    return first, second


UPSERT_SQL = """SELECT 'spark_write_' || o_orderkey AS rowkey,
  CAST(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS BIGINT) AS version,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) ELSE CAST(o_totalprice AS VARCHAR) END AS cf_count
FROM orders"""


@query("kv_upsert", UPSERT_SQL)
def kv_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.upsert(*_puts(spark, sf))


@query("kv_upsert_coalesced", UPSERT_SQL)
def kv_upsert_coalesced(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "kv")
    keyed.write_table(keyed.upsert(*_puts(spark, sf)), path)
    return keyed.open_table(spark, path)


@query("kv_put_partitions", UPSERT_SQL)
def kv_put_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The same table through one writer per partition, read back."""
    rows = keyed.upsert(*_puts(spark, sf))
    folder = scratch(spark, "puts")
    keyed.put_partitions(rows, lambda: keyed.JsonPuts(folder))
    return spark.read.schema(rows.schema).json(folder)


@query("kv_put_commit", UPSERT_SQL)
def kv_put_commit(spark: SparkSession, sf: str) -> DataFrame:
    """Both sets of puts through committing writers; the table is the newest row of each key."""
    folder = scratch(spark, "committed-puts")
    first, second = _puts(spark, sf)
    for rows in (first, second):
        puts.put_rows(rows, folder)
    return keyed.latest(puts.read_puts(spark, folder, first.schema))


@query(
    "kv_bulk_sorted",
    "SELECT DISTINCT 'spark_load_' || l_orderkey AS rowkey FROM lineitem",
)
def kv_bulk_sorted(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(K.prefixed_key("spark_load", "l_orderkey").alias("rowkey"))
    path = scratch(spark, "bulk")
    keyed.bulk_build(rows, path)
    return keyed.open_table(spark, path)


@query(
    "kv_range_scan",
    """SELECT 'spark_write_' || o_orderkey AS rowkey, CAST(o_totalprice AS VARCHAR) AS cf_count FROM orders
WHERE 'spark_write_' || o_orderkey >= 'spark_write_10' AND 'spark_write_' || o_orderkey < 'spark_write_3'""",
)
def kv_range_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "kv-sorted")
    keyed.bulk_build(_puts(spark, sf)[0].drop("version"), path)
    return keyed.range_scan(keyed.open_table(spark, path), "spark_write_10", "spark_write_3")


REGION_SPLITS = [f"spark_load_{k}" for k in ("15", "2", "4", "45", "7", "9x")]

_REGION = " + ".join(f"CAST(rowkey >= '{s}' AS INTEGER)" for s in REGION_SPLITS)


@query(
    "kv_region_build",
    f"""WITH k AS (SELECT DISTINCT 'spark_load_' || l_orderkey AS rowkey FROM lineitem)
SELECT {_REGION} AS region, count(*) AS n, min(rowkey) AS first_key, max(rowkey) AS last_key, true AS in_order
FROM k GROUP BY 1""",
)
def kv_region_build(spark: SparkSession, sf: str) -> DataFrame:
    """Regions by given split points, built over an older table and published; bounds as stored."""
    keys = table(spark, sf, "lineitem").select(K.prefixed_key("spark_load", "l_orderkey").alias("rowkey"))
    built = CommittedTable(spark, scratch(spark, "regions"))
    keyed.region_build(keys.limit(0), [], built)
    keyed.region_build(keys, REGION_SPLITS, built)
    return keyed.region_bounds(built.read())


@query(
    "offset_reconcile",
    """
WITH s AS (SELECT event_type AS topic, CAST(user_id % 6 AS INTEGER) AS partition, min(event_id) + 40 AS saved
           FROM events GROUP BY 1, 2),
e AS (SELECT event_type AS topic, CAST(user_id % 8 + 2 AS INTEGER) AS partition, min(event_id) * 2 AS earliest
      FROM events GROUP BY 1, 2)
SELECT topic, partition, greatest(coalesce(saved, earliest), coalesce(earliest, saved)) AS "offset"
FROM s FULL JOIN e USING (topic, partition)
""",
)
def offset_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")

    def side(partition, offset):
        return events.groupBy(
            F.col("event_type").alias("topic"), partition.cast("int").alias("partition")
        ).agg(offset.alias("offset"))

    saved = side(F.col("user_id") % 6, F.min("event_id") + 40)
    earliest = side(F.col("user_id") % 8 + 2, F.min("event_id") * 2)
    return reconcile(saved, earliest)


@query(
    "text_pairs_distinct",
    """WITH l AS (SELECT event_type || ' ' || user_id AS line FROM events)
SELECT split_part(line, ' ', 1) AS ip, count(DISTINCT split_part(line, ' ', 2)) AS n_distinct
FROM l GROUP BY 1""",
)
def text_pairs_distinct(spark: SparkSession, sf: str) -> DataFrame:
    path = staged(event_lines(spark, sf), "pairs", "text")
    pairs = files.read_typed_text(spark, path, "ip STRING, name STRING", " ")
    return C.distinct_two_level(pairs, "ip", "name")
