"""Template counters per host, template choice, and rule rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The shapes of one path step.
STEP_PATTERN = (
    r"/([A-Za-z][A-Za-z0-9:_-]*|\*)"
    r"(?:\[@(id|class)='([^']*)'\]|\[(text)\(\)\*=([^\]]*)\])?"
)
PATH_PATTERN = rf"^/(?:{STEP_PATTERN})+$"


def host_totals(mined: DataFrame) -> DataFrame:
    """Pages per host that gave a template."""
    return (
        mined.filter(F.col("mined").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("total"))
    )


def positive_scores(mined: DataFrame) -> DataFrame:
    """Score of every (host, positive path)."""
    return (
        mined.filter(F.col("mined").isNotNull())
        .groupBy("host", F.col("mined.xpath").alias("xpath"))
        .agg(F.count("*").alias("score"))
    )


def negative_set(mined: DataFrame) -> DataFrame:
    """Distinct (host, negative path)."""
    return mined.select("host", F.explode("mined.negatives").alias("xpath")).distinct()


def template_counters(mined: DataFrame) -> DataFrame:
    """All three counters as one table: kind is total, positive or negative."""
    total = host_totals(mined).select(
        F.lit("total").alias("kind"), "host", F.lit("").alias("xpath"), F.col("total").alias("n")
    )
    positive = positive_scores(mined).select(
        F.lit("positive").alias("kind"), "host", "xpath", F.col("score").alias("n")
    )
    negative = negative_set(mined).select(
        F.lit("negative").alias("kind"), "host", "xpath", F.lit(1).cast("long").alias("n")
    )
    return total.unionByName(positive).unionByName(negative)


def counter_deltas(mined: DataFrame) -> DataFrame:
    """The same counters from one pass over the pages: each page is exploded to its own rows.

    Only short rows are shuffled, after a partial aggregation on the map side.
    """
    one = F.col("mined")
    rows = F.concat(
        F.array(F.struct(F.lit("total").alias("kind"), F.lit("").alias("xpath"))),
        F.array(F.struct(F.lit("positive").alias("kind"), one["xpath"].alias("xpath"))),
        F.transform(
            one["negatives"],
            lambda x: F.struct(F.lit("negative").alias("kind"), x.alias("xpath")),
        ),
    )
    return (
        mined.select("host", F.explode(F.when(one.isNotNull(), rows)).alias("r"))
        .groupBy("r.kind", "host", "r.xpath")
        .agg(F.count("*").alias("n"))
        .withColumn("n", F.when(F.col("kind") == "negative", F.lit(1)).otherwise(F.col("n")).cast("long"))
    )


def member_score(counters: DataFrame, host: str, xpath: str) -> DataFrame:
    return counters.filter(
        (F.col("kind") == "positive") & (F.col("host") == host) & (F.col("xpath") == xpath)
    ).select(F.col("n").alias("score"))


def negative_members(counters: DataFrame, host: str) -> DataFrame:
    return counters.filter((F.col("kind") == "negative") & (F.col("host") == host)).select("xpath")


def host_total(counters: DataFrame, host: str) -> DataFrame:
    return counters.filter((F.col("kind") == "total") & (F.col("host") == host)).select(
        F.col("n").alias("total")
    )


def top_members(scores: DataFrame, k: int = 2) -> DataFrame:
    """The k best paths per host; ties go to the greater path. Adds `rank`."""
    by_score = Window.partitionBy("host").orderBy(F.col("score").desc(), F.col("xpath").desc())
    return scores.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)


def choose_rules(counters: DataFrame, k: int = 2, origin: str = "machine") -> DataFrame:
    """Rule rows: the k best positive paths and every negative path of each host.

    `counters` is read twice, so pass a stored table.
    """
    positive = top_members(
        counters.filter(F.col("kind") == "positive").select(
            "host", "xpath", F.col("n").alias("score")
        ),
        k,
    ).select("host", "xpath", F.lit(True).alias("is_positive"))
    negative = counters.filter(F.col("kind") == "negative").select(
        "host", "xpath", F.lit(False).alias("is_positive")
    )
    return positive.unionByName(negative).withColumn("origin", F.lit(origin))


def rule_lines(rules: DataFrame) -> DataFrame:
    """Rules in their file form, one tab-separated line each."""
    return rules.select(
        F.concat_ws(
            "\t", "host", "xpath", F.col("is_positive").cast("string"), "origin"
        ).alias("value")
    )


def path_steps(xpath: Column) -> Column:
    """Steps (tag, attr, value) of a path; null when the text is not a supported path."""

    def part(group: int) -> Column:
        return F.regexp_extract_all(xpath, F.lit(STEP_PATTERN), F.lit(group))

    steps = F.zip_with(
        F.arrays_zip(part(1).alias("tag"), part(2).alias("by"), part(3).alias("value")),
        F.arrays_zip(part(4).alias("text"), part(5).alias("word")),
        lambda a, b: F.struct(
            a["tag"].alias("tag"),
            F.when(b["text"] != "", b["text"]).otherwise(a["by"]).alias("attr"),
            F.when(b["text"] != "", b["word"]).otherwise(a["value"]).alias("value"),
        ),
    )
    return F.when(xpath.rlike(PATH_PATTERN), steps)


def step_key(step: Column) -> Column:
    """What an element must have to fit a step: its tag, or tag and id or class."""
    plain = F.concat(step["tag"], F.lit("|"))
    named = F.concat(plain, step["attr"], F.lit("|"), step["value"])
    return F.when(step["attr"].isin("id", "class"), named).otherwise(plain)


def element_keys(node: Column) -> Column:
    """The keys of all steps that an element may fit."""
    keys = []
    for tag in (node["tag"], F.lit("*")):
        plain = F.concat(tag, F.lit("|"))
        keys += [plain, F.concat(plain, F.lit("id|"), node["id"]),
                 F.concat(plain, F.lit("class|"), node["cls"])]
    return F.array_compact(F.array(*keys))


def host_rules(rules: DataFrame) -> DataFrame:
    """One row per host: parsed positive and negative paths, and whether all could be parsed.

    `negative_keys` has, place by place, the key of the last step of each negative path.
    """
    parsed = (
        rules.select("host", "xpath", "is_positive")
        .distinct()
        .withColumn("steps", path_steps(F.col("xpath")))
    )
    entry = F.struct("xpath", "steps")

    def side(flag: Column) -> Column:
        return F.transform(
            F.array_sort(F.collect_list(F.when(flag, entry))), lambda e: e["steps"]
        )

    return parsed.groupBy("host").agg(
        side(F.col("is_positive")).alias("positive"),
        side(~F.col("is_positive")).alias("negative"),
        F.bool_and(F.col("steps").isNotNull()).alias("usable"),
    ).withColumn(
        "negative_keys",
        F.transform("negative", lambda steps: step_key(F.element_at(steps, -1))),
    )

