"""Applying host rules to pages: text extraction and outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import java_length, java_trim
from millrace.pages.elements import built_once, let, node_at, text_of
from millrace.pages.templates import element_keys, host_rules
from millrace.runtime import lookup_join

# Fixed value: least length of trimmed text that counts as content.
MIN_CONTENT = 10

EXTRACT, EMPTY, NO_MATCH = "extract", "empty", "no_match"


def _fits(node: Column, step: Column) -> Column:
    value = step["value"]
    return ((step["tag"] == "*") | (node["tag"] == step["tag"])) & (
        F.when(step["attr"] == "id", node["id"] == value)
        .when(step["attr"] == "class", node["cls"] == value)
        .when(step["attr"] == "text", F.contains(node["own"], value))
        .otherwise(F.lit(True))
    )


def selects(nodes: Column, steps: Column, node: Column) -> Column:
    """Whether a path selects an element.

    The last step fits the element, the steps before it its parent, grandparent and so on;
    the first step may fit at any depth.
    """
    upward = F.slice(F.reverse(steps), 2, F.greatest(F.size(steps) - 1, F.lit(0)))

    def climb(at: Column, step: Column) -> Column:
        above = node_at(nodes, at)
        return F.when(at.isNotNull() & _fits(above, step), above["parent"])

    # The fold carries the index of the next ancestor; it turns null when a step does not fit.
    # An index before the root gives no element, so running out of ancestors does not fit.
    climbed = F.aggregate(upward, node["parent"], climb)
    return _fits(node, F.element_at(steps, -1)) & climbed.isNotNull()


def matching(nodes: Column, steps: Column) -> Column:
    """Elements a path selects."""
    return F.filter(nodes, lambda n: selects(nodes, steps, n))


def met_rules(own: Column, rules: Column, keys: Column) -> Column:
    """The rules that can select an element of the page, by its distinct keys and those of their last steps.

    The keys of page and host are intersected as sets, so unrelated rules cost a look-up each and
    are never tried on an element.
    """
    return let(
        F.array_intersect(own, keys),
        lambda hits: F.filter(rules, lambda _, i: F.array_contains(hits, F.get(keys, i))),
    )


def nearest_removed(nodes: Column, negative: Column) -> Column:
    """Per element, the deepest removed element among itself and its ancestors, or -1."""
    flags = F.transform(
        nodes, lambda n: F.exists(negative, lambda steps: selects(nodes, steps, n))
    )

    def climb(removed: Column, n: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), n["depth"]),
            F.struct(n["node"].alias("at"), F.lit(-1).alias("hit")),
            lambda s, _: F.when((s["hit"] >= 0) | (s["at"] < 0), s).otherwise(
                F.struct(
                    node_at(nodes, s["at"])["parent"].alias("at"),
                    F.when(F.get(removed, s["at"]), s["at"]).otherwise(F.lit(-1)).alias("hit"),
                )
            ),
            lambda s: s["hit"],
        )

    return let(
        flags,
        lambda removed: F.when(
            F.exists(removed, lambda r: r), F.transform(nodes, lambda n: climb(removed, n))
        ),
    )


def remaining_text(pieces: Column, node: Column, nearest: Column) -> Column:
    """Text of an element without removed elements strictly inside it.

    A piece is taken out when the deepest removed element around it begins behind the element.
    """
    return text_of(
        pieces,
        node,
        lambda p: nearest.isNull() | (F.get(nearest, p["node"]) <= node["node"]),
    )


def content(nodes: Column, pieces: Column, positive: Column, negative: Column) -> Column:
    """Texts of all positive paths put together, negative elements left out.

    Inside one path the texts are joined by a space; paths follow in path order.
    """

    def path_text(steps: Column, nearest: Column) -> Column:
        texts = F.transform(matching(nodes, steps), lambda n: remaining_text(pieces, n, nearest))
        return F.ltrim(F.array_join(texts, " "))

    return let(
        nearest_removed(nodes, negative),
        lambda nearest: F.array_join(F.transform(positive, lambda s: path_text(s, nearest)), ""),
    )


@built_once
def page_keys() -> Column:
    """The distinct keys of a page's `nodes`."""
    return F.array_distinct(F.flatten(F.transform(F.col("nodes"), element_keys)))


@built_once
def ruled_content() -> Column:
    """Content by the columns `nodes`, `pieces` and those of the host's rules.

    Null without rules, empty when a rule of the host is not a path.
    """
    return _content_by(page_keys())


@built_once
def keyed_content() -> Column:
    """The same where the page's keys are stored as `keys`."""
    return _content_by(F.col("keys"))


def _content_by(keys: Column) -> Column:
    negative = met_rules(keys, F.col("negative"), F.col("negative_keys"))
    text = let(
        negative, lambda met: content(F.col("nodes"), F.col("pieces"), F.col("positive"), met)
    )
    return F.when(F.col("usable"), text).when(F.col("usable").isNotNull(), F.lit(""))


def match_rules(trees: DataFrame, rules: DataFrame) -> DataFrame:
    """Attach the rules of the page's host (size-checked lookup); null when it has none."""
    return lookup_join(trees, host_rules(rules), ["host"])


def extract(trees: DataFrame, rules: DataFrame) -> DataFrame:
    """Add `content` and `outcome`; the tree and rule columns are dropped.

    A host without rules is no_match. A rule that is not a path makes the host's pages empty,
    as does text shorter than MIN_CONTENT.
    """
    return (
        match_rules(trees, rules)
        .withColumn("content", ruled_content())
        .withColumn("outcome", outcome_of(F.col("content")))
        .drop("nodes", "pieces", "positive", "negative", "negative_keys", "usable")
    )


def outcome_of(text: Column) -> Column:
    """no_match for null, then extract or empty by the trimmed length."""
    return (
        F.when(text.isNull(), NO_MATCH)
        .when(java_length(java_trim(text)) >= MIN_CONTENT, EXTRACT)
        .otherwise(EMPTY)
    )
