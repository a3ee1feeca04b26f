from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.keys import FIELD_SEP
from millrace.sinks.ledger import BatchKey
from millrace.pages import job, templates
from millrace.pages.elements import elements, with_tree
from millrace.pages.extract import extract
from millrace.pages.mining import mined
from millrace.pages.records import parse_records, validate
from millrace.pages.report import COUNTERS, documents, host_report, merge_reports
from millrace.pages.tree import NODE_FIELDS, parse_page

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do "  # 62 letters


def text(n):
    return (WORDS * (n // len(WORDS) + 1))[: n - 1].replace(" ", "x") + "e"


def rows(html):
    return [dict(zip(NODE_FIELDS, r)) for r in parse_page(html)[0]]


def shape(html):
    """tag(own text) nested by depth, without html, head and body."""
    nodes = rows(html)
    body = next(n for n in nodes if n["tag"] == "body")
    return [(n["depth"] - body["depth"], n["tag"], n["own"]) for n in nodes[body["node"] + 1:]]


@pytest.mark.parametrize(
    "html, want",
    [
        ("<p>a<p>b", [(1, "p", "a"), (1, "p", "b")]),
        ("<p>a<div>b</div>c", [(1, "p", "a"), (1, "div", "b")]),
        ("<ul><li>1<li>2</ul>t", [(1, "ul", ""), (2, "li", "1"), (2, "li", "2")]),
        ("<p><b>x<p>y", [(1, "p", ""), (2, "b", "x"), (1, "p", ""), (2, "b", "y")]),
        ("<b>x</b>y<i>z</i>", [(1, "b", "x"), (1, "i", "z")]),
        ("<a>x<a>y", [(1, "a", "x"), (1, "a", "y")]),
        ("<div>a<br>b</div>", [(1, "div", "a b"), (2, "br", "")]),
        ("<div>a<!-- <p>no</p> -->b</div>", [(1, "div", "ab")]),
        ("<script>var t='</p>';</script><p>x", [(1, "p", "x")]),
        ("<p>x<script>if(a<b){}</script>y", [(1, "p", "xy"), (2, "script", "")]),
        ("<DIV CLASS=x>t</DIV>", [(1, "div", "t")]),
        ("<p>a&amp;b&copy;&lt;", [(1, "p", "a&b©<")]),
        ("<dl><dt>a<dd>b<dt>c</dl>", [(1, "dl", ""), (2, "dt", "a"), (2, "dd", "b"), (2, "dt", "c")]),
        ("<h1>a<h2>b</h2>", [(1, "h1", "a"), (1, "h2", "b")]),
        ("<p>a</div>b", [(1, "p", "ab")]),
        ("<div></p></div>", [(1, "div", ""), (2, "p", "")]),
        ("<p title='>'>a", [(1, "p", "a")]),
        ("<p>a <", [(1, "p", "a <")]),
        ("<p>a <foot", [(1, "p", "a")]),
        (
            "<table><tr><td>1<td>2</table>z",
            [(1, "table", ""), (2, "tbody", ""), (3, "tr", ""), (4, "td", "1"), (4, "td", "2")],
        ),
    ],
)
def test_tree_shapes(html, want):
    assert shape(html) == want


def test_formatting_entries_are_limited():
    nodes = shape("<p>" + "<b>" * 5 + "x<p>y")
    assert [t for _, t, _ in nodes].count("b") == 5 + 3


def test_text_lengths_and_cut_subtrees():
    nodes = rows("<div>ab <a>link</a><p>c  d</p><ul><li>e</ul></div>")
    by_tag = {n["tag"]: n for n in nodes}
    assert by_tag["div"]["text_len"] == len("ab c d")
    assert by_tag["a"]["cut"] and by_tag["li"]["cut"] and not by_tag["p"]["cut"]
    assert by_tag["a"]["text_len"] == 0
    assert rows("<p>😀a</p>")[-1]["text_len"] == 3


def test_head_text_is_not_in_body():
    nodes = rows("<head><title>T</title></head><body id=m class='c d'><p>x")
    body = next(n for n in nodes if n["tag"] == "body")
    assert (body["id"], body["cls"], body["text_len"]) == ("m", "c d", 1)


def facts(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id INT, html STRING")
    got = with_tree(df).select("page_id", mined().alias("m")).orderBy("page_id").collect()
    return [r["m"] for r in got]


P60, P100 = f"<p>{text(60)}</p>", f"<p>{text(100)}</p>"


CONTENT_PATHS = (
    [
        (f"<div>{text(49)}</div>", None),
        (f"<div>{text(50)}</div>", "//html/body/div"),
        # The first of two equal blocks wins; a longer one wins over both.
        (f"<div>{text(60)}</div><p>{text(60)}</p>", "//html/body/div"),
        (f"<div>{text(60)}</div><p>{text(61)}</p>", "//html/body/p"),
        # A child with exactly 0.65 of the text is the content, one letter less is not.
        (f"<div><div>{text(65)}</div><span>{text(35)}</span></div>", "//html/body/div/div"),
        (f"<div><div>{text(64)}</div><span>{text(36)}</span></div>", "//html/body/div"),
        # Paragraphs that carry the text stop the walk.
        (f"<div><div>{P60}{P60}</div></div>", "//html/body/div/div"),
        # Too little text in paragraphs: walk on to the child that has it.
        (f"<div><div><p>{text(10)}</p><section>{P100}</section></div></div>", "//html/body/div/div/section"),
        # An empty paragraph stops the walk as well.
        (f"<div><div><p></p><section>{P100}</section></div></div>", "//html/body/div/div"),
        # A chain end without paragraphs falls back to the start element.
        (f"<div><div><section><i>{text(100)}</i></section></div></div>", "//html/body/div/div"),
        # An id stops the path, a class is kept whole.
        (f"<div class='x'><div id='main'>{P60}</div></div>", "//div[@id='main']"),
        (f"<div id='o'><div class='a b'>{P60}</div></div>", "//div[@id='o']/div[@class='a b']"),
        # Excluded tags and their text do not count.
        (f"<div><ul><li>{text(300)}</ul></div><section>{text(50)}</section>", "//html/body/section"),
        (f"<form>{text(100)}</form>", None),
    ]
)


def test_content_paths(spark):
    got = facts(spark, *[f"<html><body>{body}</body></html>" for body, _ in CONTENT_PATHS])
    assert [m and m["xpath"] for m in got] == [xpath for _, xpath in CONTENT_PATHS]


def test_path_with_id_on_body(spark):
    (m,) = facts(spark, f"<html id=h><body id=b>{P60}</body></html>")
    assert m["xpath"] == "//body/p"


LONG = f"{P100}{P100}"
A = "//html/body/article"


NEGATIVE_PATHS = (
    [
        ("<div><p>来源：x</p></div>", [f"{A}/div/p[text()*=来源：]"]),
        ("<div><i>来源：x</i></div>", [f"{A}/div/i/span[text()*=来源：]"]),
        ("<div>来源：x</div>", [f"{A}/div[text()*=来源：]"]),
        ("<p><i>来源：x</i></p>", [f"{A}/p/i"]),
        ("<p>来源：<i>x</i></p>", [f"{A}/p[text()*=来源：]"]),
        ("<p>来源：x</p>", [f"{A}/p[text()*=来源：]"]),
        ("<p>责任编辑：x</p>", [f"{A}/p[text()*=编辑：]", f"{A}/p[text()*=责任编辑]"]),
        (f"<p>来源：{text(150)}</p>", []),
        ("<p>x</p>", []),
    ]
)


def test_negative_paths(spark):
    got = facts(spark, *[f"<body><article>{LONG}{child}</article></body>" for child, _ in NEGATIVE_PATHS])
    assert {m["xpath"] for m in got} == {A}
    assert [sorted(m["negatives"]) for m in got] == [negative for _, negative in NEGATIVE_PATHS]


def test_negative_paths_inside_a_paragraph(spark):
    inner = f"<p>{text(200)}<i>来源：x</i></p>"
    (m,) = facts(spark, f"<body><div>{inner}</div></body>")
    assert m["xpath"] == "//html/body/div/p" and m["negatives"] == ["//html/body/div/p/i"]
    # The content is the paragraph itself when it is the body block.
    (m,) = facts(spark, f"<body>{inner}</body>")
    assert m["xpath"] == "//html/body/p" and m["negatives"] == ["//html/body/p/i"]


def rule_frame(spark, *rules):
    return spark.createDataFrame([("h", x, p, "man") for x, p in rules], "host STRING, xpath STRING, is_positive BOOLEAN, origin STRING")


PAGE = (
    "<body><div id='m' class='c'><h1>Title</h1><p>first one</p><p>second <a>link</a> 来源：z<i>!</i></p>"
    "<div class='ad'><p>buy</p></div></div><p>tail</p></body>"
)


EXTRACTIONS = (
    [
        ([("//div[@id='m']/p", True)], "first one second link 来源：z!"),
        ([("//div[@class='c']/h1", True)], "Title"),
        ([("//p", True)], "first one second link 来源：z! buy tail"),
        ([("//*/h1", True)], "Title"),
        ([("//div[@id='m']", True), ("//div[@id='m']/p[text()*=来源：]", False)], "Title first one buy"),
        # Texts of several paths follow in path order without a space between them.
        ([("//html/body/p", True), ("//div[@id='m']/h1", True)], "Titletail"),
        # A removed subtree around a positive element does not take its text.
        ([("//div[@class='ad']/p", True), ("//div[@id='m']", False)], "buy"),
        # An element that is both keeps its own text, minus removed parts inside it.
        ([("//div[@id='m']/p", True), ("//div[@id='m']/p", False)], "first one second link 来源：z!"),
        ([("//div[@id='m']/p", True), ("//p/a", False)], "first one second 来源：z!"),
        ([("//html/body/div/section", True)], ""),
        ([("//div[@id='m']", False)], ""),
        ([("//body/html", True)], ""),
        ([("not a path", True), ("//p", True)], ""),
    ]
)


def test_extractions(spark):
    """Every case is a host of its own; one host has no rules."""
    pages = [(f"h{i}", PAGE) for i in range(len(EXTRACTIONS))]
    rules = [
        (f"h{i}", path, positive, "man")
        for i, (paths, _) in enumerate(EXTRACTIONS)
        for path, positive in paths
    ]
    bounds = [("n9", f"<p>{text(9)}</p>"), ("n10", f"<p>{text(10)}</p>"), ("none", PAGE)]
    rules += [(h, "//p", True, "man") for h in ("n9", "n10")]
    df = spark.createDataFrame([*pages, *bounds], "host STRING, html STRING")
    schema = "host STRING, xpath STRING, is_positive BOOLEAN, origin STRING"
    got = {r["host"]: r for r in extract(with_tree(df), spark.createDataFrame(rules, schema)).collect()}
    assert [got[h]["content"] for h, _ in pages] == [content for _, content in EXTRACTIONS]
    assert [got[h]["outcome"] for h, _ in bounds] == ["empty", "extract", "no_match"]
    assert got["none"]["content"] is None


def record(spark, *parts):
    return spark.createDataFrame([(FIELD_SEP.join(p),) for p in parts], "value STRING")


def test_record_status(spark):
    import hashlib

    url, html = "http://h.com/x", "<p>中</p>"
    md5 = hashlib.md5(f"{url}{FIELD_SEP}{html}".encode()).hexdigest()
    got = validate(
        parse_records(
            record(
                spark, (md5, url, html), ("0", url, html), (md5, url), (md5, url, ""), (url,),
                (md5, url, html, "x"), (md5, "nourl", html), ("",),
            )
        )
    ).collect()
    assert [(r["host"], r["status"]) for r in got] == [
        ("h.com", "ok"), ("h.com", "filtered"), ("h.com", "filtered"), ("h.com", "filtered"),
        ("HOST_NULL", "filtered"), ("HOST_NULL", "filtered"), ("HOST_NULL", "filtered"),
        ("HOST_NULL", "filtered"),
    ]


def page_records(spark, n=12):
    md5 = F.md5(F.concat("url", F.lit(FIELD_SEP), "html"))
    page = spark.range(n).select(
        F.concat(F.lit("http://h"), F.col("id") % 3, F.lit(".com/"), "id").alias("url"),
        F.lit(f"<body><article>{LONG}<p>来源：x</p></article></body>").alias("html"),
    )
    lines = page.select(F.concat_ws(FIELD_SEP, md5, "url", "html").alias("value"))
    return lines.unionByName(record(spark, ("bad",)))


def test_counters_and_rules(spark):
    records = validate(parse_records(page_records(spark)))
    counters = templates.counter_deltas(job.learned(records))
    assert templates.host_total(counters, "h1.com").first()["total"] == 4
    assert templates.member_score(counters, "h1.com", A).first()["score"] == 4
    assert [r[0] for r in templates.negative_members(counters, "h1.com").collect()] == [f"{A}/p[text()*=来源：]"]
    union = templates.template_counters(job.learned(records))
    assert sorted(map(tuple, union.select(*counters.columns).collect())) == sorted(map(tuple, counters.collect()))
    rules = job.learn_rules(records)
    assert {(r["xpath"], r["is_positive"]) for r in rules.filter("host = 'h0.com'").collect()} == {
        (A, True), (f"{A}/p[text()*=来源：]", False),
    }


def test_results_are_the_same_with_rules_too_large_to_broadcast(spark):
    records = validate(parse_records(page_records(spark)))
    rules = job.learn_rules(records).filter("host <> 'h2.com'")
    small, large = (job.page_results(records, rules, limit) for limit in (1 << 20, 0))
    columns = ["url", "host", "status", "outcome", "content"]
    as_rows = [sorted(map(str, df.select(*columns).collect())) for df in (small, large)]
    assert as_rows[0] == as_rows[1] and len(as_rows[0]) == 13
    text_ = large._jdf.queryExecution().executedPlan().toString()
    assert text_.index("MapInArrow") < text_.index("Join")


def test_job_replay_and_report(spark, tmp_path):
    records = validate(parse_records(page_records(spark)))
    rules = job.learn_rules(records).filter("host <> 'h2.com'")
    tables = job.PageTables(str(tmp_path))
    at = datetime(2024, 1, 2, 3, 4, 5)
    for number in (0, 1, 1):
        job.run_batch(records, rules, at, tables, BatchKey("run", number))
    report = {r["host"]: r for r in job.total_report(spark, tables).collect()}
    assert report["h0.com"]["scan"] == 8 and report["h0.com"]["extract"] == 8
    assert report["h2.com"]["no_match_xpath"] == 8 and report["HOST_NULL"]["filtered"] == 2
    for r in report.values():
        assert r["scan"] == sum(r[c] for c in COUNTERS[1:])
    assert spark.read.parquet(tables.path("documents")).count() == 16
    totals = job.total_counters(spark, tables)
    assert templates.host_total(totals, "h2.com").first()["total"] == 8
    assert totals.filter("kind = 'negative'").select(F.max("n")).first()[0] == 1
    doc = spark.read.parquet(tables.path("documents")).first()
    assert doc["content"] == f"{text(100)} {text(100)}" and doc["domain"] == doc["host"]


def test_second_scan_into_one_root_adds(spark, tmp_path):
    records = validate(parse_records(page_records(spark)))
    rules = job.learn_rules(records)
    tables = job.PageTables(str(tmp_path))
    for day in (2, 3, 3):
        at = datetime(2024, 1, day, 3, 4, 5)
        job.run_batch(records, rules, at, tables, job.run_key(at))
    report = job.total_report(spark, tables).filter("host = 'h0.com'").collect()
    assert sorted((r["scan_day"], r["scan"]) for r in report) == [(20240102, 4), (20240103, 4)]


def test_stream_skips_empty_batches_and_refreshes_rules(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    loads, now = [], [100.0]

    def load(session):
        loads.append(now[0])
        return rule_frame(session, (A, True)).withColumn("host", F.lit("h0.com"))

    tables = job.PageTables(str(tmp_path / "out"))
    lines = spark.readStream.text(str(source))
    for round_ in range(3):
        if round_ < 2:
            page_records(spark, 3).coalesce(1).write.mode("append").text(str(source))
        now[0] += 6
        job.start_stream(lines, load, tables, str(tmp_path / "cp"), clock=lambda: now[0]).awaitTermination()
    report = {r["host"]: r["scan"] for r in job.total_report(spark, tables).collect()}
    assert report["h0.com"] == 2 and len(loads) == 2


def test_merge_adds_counters_per_hour(spark):
    outcomes = spark.createDataFrame(
        [("h", "ok", "extract"), ("h", "ok", "empty"), ("h", "filtered", None)],
        "host STRING, status STRING, outcome STRING",
    )
    first = host_report(outcomes, job.moment(datetime(2024, 1, 2, 3, 59)))
    second = host_report(outcomes, job.moment(datetime(2024, 1, 2, 4, 0)))
    merged = merge_reports(first, first, second).orderBy("scan_hour").collect()
    assert [(r["scan"], r["extract"], r["scan_hour"]) for r in merged] == [(6, 2, 3), (3, 1, 4)]


def test_documents_have_stated_columns(spark):
    df = spark.createDataFrame(
        [("http://a.b.com/", "a.b.com", "some content", "extract")],
        "url STRING, host STRING, content STRING, outcome STRING",
    )
    doc = documents(df, job.moment(datetime(2024, 1, 2, 3, 4, 5)))
    assert doc.columns == ["url", "url_md5", "host", "domain", "date", "content"]
    assert doc.first()["domain"] == "b.com" and doc.first()["date"] == "2024-01-02 03:04:05"


def test_elements_table(spark):
    df = spark.createDataFrame([(1, "<p>x</p>"), (2, None)], "page_id INT, html STRING")
    got = elements(with_tree(df), ["page_id"]).filter("tag = 'p'").collect()
    assert [(r["page_id"], r["own_text"], r["depth"]) for r in got] == [(1, "x", 2)]


def test_bytes_that_are_not_text(spark):
    df = spark.sql("SELECT 1 AS page_id, CAST(X'3C703E61FF623C2F703E' AS STRING) AS html")
    got = elements(with_tree(df), ["page_id"]).filter("tag = 'p'").first()
    assert got["own_text"] == "a\ufffdb"
