"""Learning templates: main block, content element, positive and negative paths of a page.

Everything here is one column expression over the page's own arrays, so a page is reduced to
a few short strings where it was read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.pages.elements import (
    built_once,
    first,
    let,
    live_children,
    live_text,
    node_at,
)

# Least text of a block, text share of the content, words of editor lines.
MIN_BLOCK_TEXT = 50
CONTENT_SHARE = 0.65
EDITOR_WORDS = ("责任编辑", "责编", "本文来源", "编辑：", "编辑:", "来源：", "本报记者")


def _share(part: Column, whole: Column) -> Column:
    """part / whole as a double; null when there is no text to share."""
    return F.when(whole > 0, part.cast("double") / whole)


def _is_p(n: Column) -> Column:
    return n["tag"] == "p"


def main_block(nodes: Column) -> Column:
    """The child of body with the most text, at least MIN_BLOCK_TEXT; the first on a tie."""
    body = first(F.filter(nodes, lambda n: (n["tag"] == "body") & (n["parent"] == 0)))
    ranked = let(
        body,
        lambda b: F.array_max(
            F.transform(
                F.filter(live_children(nodes, b), lambda n: n["text_len"] >= MIN_BLOCK_TEXT),
                lambda n: F.struct(n["text_len"].alias("len"), (-n["node"]).alias("order")),
            )
        ),
    )
    return let(ranked, lambda r: node_at(nodes, -r["order"]))


def start_element(nodes: Column, block: Column) -> Column:
    """The child holding the content share of the block, or the block itself."""
    big = F.filter(
        live_children(nodes, block),
        lambda c: _share(c["text_len"], block["text_len"]) >= CONTENT_SHARE,
    )
    return F.coalesce(first(big), block)


def deepest_element(nodes: Column, start: Column) -> Column:
    """Follow the child with the content share until paragraphs carry the text.

    A share above one half belongs to one child at most, so the walk is a single chain: one
    step per level, folded over the levels below the start.
    """
    levels = F.sequence(
        F.lit(0), F.array_max(F.transform(nodes, lambda n: n["depth"])) - start["depth"]
    )

    def step(state: Column, _level: Column) -> Column:
        here = state["at"]
        moved = let(
            live_children(nodes, here),
            lambda kids: let(
                F.struct(
                    F.exists(kids, _is_p).alias("any"),
                    F.aggregate(
                        F.filter(kids, _is_p), F.lit(0), lambda s, k: s + k["text_len"]
                    ).alias("len"),
                ),
                lambda p: F.when(
                    p["any"]
                    & (
                        (p["len"] == 0)
                        | F.coalesce(_share(p["len"], here["text_len"]) >= CONTENT_SHARE, F.lit(False))
                    ),
                    F.lit(None),
                ).otherwise(
                    first(
                        F.filter(
                            kids,
                            lambda k: _share(k["text_len"], here["text_len"]) >= CONTENT_SHARE,
                        )
                    )
                ),
            ),
        )
        return F.when(state["done"], state).otherwise(
            let(
                moved,
                lambda m: F.struct(
                    F.coalesce(m, here).alias("at"), m.isNull().alias("done")
                ),
            )
        )

    return F.aggregate(
        levels,
        F.struct(start.alias("at"), F.lit(False).alias("done")),
        step,
        lambda s: s["at"],
    )


def content_element(nodes: Column, start: Column) -> Column:
    """The deepest element if it has paragraph children, else the start element."""
    return let(
        deepest_element(nodes, start),
        lambda d: F.when(F.exists(live_children(nodes, d), _is_p), d).otherwise(start),
    )


def element_path(nodes: Column, n: Column) -> Column:
    """Path from the nearest ancestor with an id, or from the root.

    Each step carries the whole class attribute; html and body stay bare.
    """

    def step(state: Column, _level: Column) -> Column:
        here = state["at"]
        bare = here["tag"].isin("html", "body")
        by_id = here["id"] != ""
        label = (
            F.when(bare, here["tag"])
            .when(by_id, F.concat(here["tag"], F.lit("[@id='"), here["id"], F.lit("']")))
            .when(
                here["cls"] != "",
                F.concat(here["tag"], F.lit("[@class='"), here["cls"], F.lit("']")),
            )
            .otherwise(here["tag"])
        )
        return F.when(state["done"], state).otherwise(
            F.struct(
                node_at(nodes, here["parent"]).alias("at"),
                F.concat(F.when(by_id, "//").otherwise("/"), label, state["path"]).alias("path"),
                (by_id | (here["parent"] < 0)).alias("done"),
            )
        )

    return F.aggregate(
        F.sequence(F.lit(0), n["depth"]),
        F.struct(n.alias("at"), F.lit("").alias("path"), F.lit(False).alias("done")),
        step,
        lambda s: F.when(s["path"].startswith("//"), s["path"]).otherwise(
            F.concat(F.lit("/"), s["path"])
        ),
    )


def negative_paths(nodes: Column, pieces: Column, content: Column, path: Column) -> Column:
    """Paths of editor lines: children of the content naming an editor word.

    A child counts when it holds at most 1 - CONTENT_SHARE of the content's text.
    """
    words = F.array(*[F.lit(w) for w in EDITOR_WORDS])
    content_is_p = _is_p(content)

    def has_word(word: Column) -> Column:
        return F.concat(F.lit("[text()*="), word, F.lit("]"))

    def of_other(child: Column, kids: Column, word: Column) -> Column:
        below = F.concat(path, F.lit("/"), child["tag"])
        sub_tag = first(kids)["tag"]
        return (
            F.when(content_is_p, below)
            .when(F.size(kids) == 0, F.concat(below, has_word(word)))
            .when(sub_tag == "p", F.concat(below, F.lit("/p"), has_word(word)))
            .otherwise(F.concat(below, F.lit("/"), sub_tag, F.lit("/span"), has_word(word)))
        )

    def of_paragraph(kids: Column, word: Column) -> Column:
        paragraph = F.when(content_is_p, path).otherwise(F.concat(path, F.lit("/p")))
        naming = first(F.filter(kids, lambda k: F.contains(live_text(pieces, k), word)))
        return F.when(
            F.size(kids) == 0, F.concat(path, F.lit("/p"), has_word(word))
        ).otherwise(
            let(
                naming,
                lambda k: F.when(
                    k.isNotNull(), F.concat(paragraph, F.lit("/"), k["tag"])
                ).otherwise(F.concat(paragraph, has_word(word))),
            )
        )

    def of_child(child: Column) -> Column:
        small = _share(child["text_len"], content["text_len"]) <= 1 - CONTENT_SHARE
        found = let(
            live_text(pieces, child),
            lambda text: F.filter(words, lambda w: F.contains(text, w)),
        )
        nothing = F.array().cast("array<string>")
        shaped = let(
            found,
            lambda named: F.when(F.size(named) == 0, nothing).otherwise(
                let(
                    live_children(nodes, child),
                    lambda kids: F.transform(
                        named,
                        lambda w: F.when(_is_p(child), of_paragraph(kids, w)).otherwise(
                            of_other(child, kids, w)
                        ),
                    ),
                )
            ),
        )
        return F.when(small, shaped).otherwise(nothing)

    paths = F.flatten(F.transform(live_children(nodes, content), of_child))
    any_word = live_text(pieces, content).rlike("|".join(EDITOR_WORDS))
    return F.when(
        any_word, F.array_except(F.array_distinct(paths), F.array(path))
    ).otherwise(F.array().cast("array<string>"))


@built_once
def mined() -> Column:
    """Template facts of a page from its `nodes` and `pieces`; null without a main block."""
    nodes, pieces = F.col("nodes"), F.col("pieces")

    def facts(block: Column, start: Column, content: Column) -> Column:
        return let(
            element_path(nodes, content),
            lambda path: F.struct(
                block["node"].alias("block_node"),
                block["tag"].alias("block_tag"),
                block["text_len"].alias("block_len"),
                start["node"].alias("start_node"),
                content["node"].alias("content_node"),
                content["tag"].alias("content_tag"),
                content["text_len"].alias("content_len"),
                path.alias("xpath"),
                negative_paths(nodes, pieces, content, path).alias("negatives"),
            ),
        )

    return let(
        main_block(nodes),
        lambda block: F.when(
            block.isNotNull(),
            let(
                start_element(nodes, block),
                lambda start: let(
                    content_element(nodes, start),
                    lambda content: facts(block, start, content),
                ),
            ),
        ),
    )
