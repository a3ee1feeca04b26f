"""Rules of any number per host, met through an index.

The index is a table of one row per rule: host, path and the key of one of its steps, the one that the
fewest rules of the host name. An element that a path selects has an ancestor line that fits every
step, so a page can only meet a rule when one of its elements has that key: pages send their distinct
keys, and an equi-join on (host, key) gives a page the rules it can meet. No row and no group holds the
rules of a host; what a page gathers is bounded by its own elements and the rules that name them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.pages.extract import page_keys  # noqa: F401  (the keys that pages send)
from millrace.pages.templates import path_steps, step_key
from millrace.runtime import (
    BROADCAST_LIMIT_BYTES,
    lookup_join,
    materialized,
    measured_bytes,
    salted_join,
)

PAGE = "__page"


def rule_index(rules: DataFrame) -> DataFrame:
    """(host, key, xpath, is_positive), one row per rule that is a path."""
    paths = rules.select("host", "xpath", "is_positive").distinct()
    keys = F.array_distinct(F.transform(path_steps(F.col("xpath")), step_key))
    steps = paths.select("host", "xpath", "is_positive", F.explode(keys).alias("key"))
    steps = materialized(steps, "rule-steps")
    named = materialized(steps.groupBy("host", "key").agg(F.count("*").alias("n")), "rule-keys")
    rated = lookup_join(steps, named, ["host", "key"], "inner")
    return rated.groupBy("host", "xpath", "is_positive").agg(
        F.min(F.struct("n", "key")).alias("best")
    ).select("host", "best.key", "xpath", "is_positive")


def host_flags(rules: DataFrame) -> DataFrame:
    """Per host with rules, whether all of them are paths (`usable`)."""
    return rules.groupBy("host").agg(
        F.bool_and(path_steps(F.col("xpath")).isNotNull()).alias("usable")
    )


def met_rules(keyed_pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Stored rules per page that meets any: positive and negative paths in path order, with the last
    steps' keys. `keyed_pages` has PAGE, host and the page's `keys`.

    Keys of a host with very many pages are salted.
    """
    # A path is taken apart once, not on every page that meets it.
    index = materialized(rule_index(rules).withColumn("steps", path_steps(F.col("xpath"))), "rule-index")
    asked = keyed_pages.select(PAGE, "host", F.explode("keys").alias("key"))
    moved = measured_bytes(index) > BROADCAST_LIMIT_BYTES
    found = salted_join(asked, index, ["host", "key"], "inner", moved)

    def side(flag: Column) -> Column:
        paths = F.array_sort(F.array_distinct(F.collect_list(F.when(flag, F.struct("xpath", "steps")))))
        return F.transform(paths, lambda p: p["steps"])

    met = found.groupBy(PAGE).agg(
        side(F.col("is_positive")).alias("positive"), side(~F.col("is_positive")).alias("negative")
    )
    last = F.transform("negative", lambda steps: step_key(F.element_at(steps, -1)))
    return materialized(met.withColumn("negative_keys", last), "page-rules")


def with_met_rules(pages: DataFrame, keyed_pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages with the columns that extraction reads: positive, negative, negative_keys, usable.

    Pages of a host meet the same rules, so the files of the met rules are far smaller than their rows and must
    not lead to a broadcast: there is a row per page.
    """
    ruled = pages.join(met_rules(keyed_pages, rules).hint("merge"), PAGE, "left")
    flagged = lookup_join(ruled, materialized(host_flags(rules), "rule-hosts"), ["host"])
    none = F.array().cast(dict(flagged.dtypes)["positive"])
    return flagged.withColumns({
        "positive": F.coalesce("positive", none),
        "negative": F.coalesce("negative", none),
        "negative_keys": F.coalesce("negative_keys", F.array().cast("array<string>")),
    })
