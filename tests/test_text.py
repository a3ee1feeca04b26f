from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import keys as K
from millrace.functions import text as X
from millrace.functions.urls import host_domain, url_domain, url_host


def values(df):
    return [r[0] for r in df.collect()]


def apply(spark, data, fn):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(data)], "i INT, v STRING")
    return values(df.orderBy("i").select(fn("v")))


def model_split(line, sep):
    if line == "":
        return [""]
    parts = line.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_java_split_literals(spark):
    given_ = ["a b  ", "", "  ", " a b", "a  b"]
    assert apply(spark, given_, X.java_split) == [
        ["a", "b"], [""], [], ["", "a", "b"], ["a", "", "b"],
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab ,\t&|.", max_size=12), min_size=20, max_size=60))
def test_java_split_model(spark, lines):
    for sep in (" ", ",", "|", "&"):
        assert apply(spark, lines, lambda c: X.java_split(c, sep)) == [model_split(s, sep) for s in lines]
    assert apply(spark, lines, lambda c: X.java_split(c, "ab")) == [model_split(s, "ab") for s in lines]


def test_null_line_has_no_tokens(spark):
    assert apply(spark, [None], X.java_split) == [None]


def test_norm_null(spark):
    assert apply(spark, [None, "", "null", "CN"], X.norm_null) == [None, None, None, "CN"]


def test_lengths_are_utf16_units(spark):
    assert apply(spark, ["abc", "é", "😀a", ""], X.java_length) == [3, 1, 3, 0]
    X.register_sql_functions(spark)
    assert spark.sql("SELECT name_length('a😀')").first()[0] == 3


def test_trim_and_blank(spark):
    given_ = [" a ", "\x01\t\n", "", None, "\u00a0"]
    assert apply(spark, given_, X.java_trim) == ["a", "", "", None, "\u00a0"]
    assert apply(spark, given_, X.is_blank) == [False, True, True, True, False]


def test_suffix_route(spark):
    assert apply(spark, ["x_1", "x_2", "x_3", "x"], X.suffix_route) == [1, 0, 1, None]


HOSTS = {
    "www.example.com": "example.com", "a.b.com.cn": "b.com.cn", "www.example.de": "de",
    "localhost": "localhost", "1.2.3.4": "1.2.3.4", "com": "com", "x.com.": "x.com",
    "com.cn": "com.cn", "a.b.c.org.hk": "c.org.hk", "www.com.de": "de",
}


def test_domains(spark):
    assert apply(spark, list(HOSTS), host_domain) == list(HOSTS.values())
    urls = [f"http://{h}/x" for h in HOSTS]
    assert apply(spark, urls, url_domain) == list(HOSTS.values())


@pytest.mark.parametrize(
    "url, host",
    [
        ("http://www.Example.com/a?b", "www.Example.com"),
        ("https://u:p@h_x.com:8080/p", "h_x.com"),
        ("http://h.com?x", "h.com"),
        ("http://h.com#x", "h.com"),
        ("http://h.com/a b", "h.com"),
        ("http://[::1]:80/", "[::1]"),
        ("http:", ""),
        ("http://h.com:x/", None),
        ("h.com/a", None),
        ("gopher://h.com/", None),
        ("", None),
        (None, None),
    ],
)
def test_url_host(spark, url, host):
    assert apply(spark, [url], url_host) == [host]


def test_time_keys(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 5, 7, 8, 9, 678000),)], "t TIMESTAMP_NTZ")
    row = df.select(
        K.put_stamp("t"), K.hour_stamp("t"), K.scan_day("t"), K.scan_hour("t"),
        K.minute_stamp("t"), K.second_stamp("t"), K.page_rowkey(F.lit("h"), "t", F.lit("u")),
    ).first()
    assert list(row)[:6] == [
        "202403050708090678", "2024030507", 20240305, 7, "2024-03-05 07:08", "2024-03-05 07:08:09",
    ]
    assert row[6] == "h_202403050708090678_7b774effe4a349c6dd82ad4f4f21d34c"
