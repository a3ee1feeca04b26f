"""Quality rules: a table of thresholds compiled into one projection of column expressions.

Measures of a text are columns of built-in functions; a rule names a measure (or the ratio of two)
and its bounds; the verdict is the conjunction of all rules. Ratios are compared by multiplication,
so no rule divides by zero. Words are `[^\\x20\\x09-\\x0D]+`.

Cases: null and empty texts have no words and fail the length rule; repeated rows get equal
verdicts; an empty table gives an empty result; columns of the input named like a result are left
out; a text of any length is measured whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import named_apart

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
# Frequent function words of the languages that are kept.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "with", "as", "was",
    "de", "la", "le", "les", "des", "et", "en", "un", "une", "du", "que", "pour", "dans", "est",
    "der", "die", "das", "und", "den", "von", "mit", "ist", "im", "zu", "auf", "für",
    "el", "los", "las", "del", "y", "por", "con", "una", "se", "es",
)


@dataclass(frozen=True)
class Rule:
    """`low <= measure / over <= high`; without `over` the measure itself is bounded."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    over: str | None = None


#: What the contract of the query fixes.
BASE_RULES = (
    Rule("enough_words", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", high=0.5, over="n_words"),
)
#: What a clean text of any of the languages keeps with a wide margin.
RULES = (
    Rule("word_length_low", "word_chars", low=2.0, over="n_words"),
    Rule("word_length_high", "word_chars", high=20.0, over="n_words"),
    Rule("symbols", "n_symbols", high=0.1, over="n_words"),
    Rule("duplicate_lines", "n_dup_lines", high=0.5, over="n_lines"),
    Rule("stop_words", "n_stop_words", low=0.01, over="n_words"),
)
RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_stop_words", "base_failed", "kept", "failed_rules",
)


def let(value: Column, body) -> Column:
    """`body(value)` with the value worked out once, also where `body` uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rule_holds(rule: Rule, measures: dict[str, Column]) -> Column:
    value = measures[rule.measure].cast("double")
    over = measures[rule.over].cast("double") if rule.over else F.lit(1.0)
    holds = F.lit(True)
    if rule.low is not None:
        holds = holds & (value >= rule.low * over)
    if rule.high is not None:
        holds = holds & (value <= rule.high * over)
    return holds


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that are found twice or more.

    Windows are sorted by (digest of the three words, place); equal neighbours are repeats, and
    each place covers three words. Two digests of 64 bits stand for a window.
    """

    def windows(w: Column) -> Column:
        return F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
            lambda first, i: F.struct(
                F.xxhash64(first, F.get(w, i + 1), F.get(w, i + 2)).alias("a"),
                F.hash(first, F.get(w, i + 1), F.get(w, i + 2)).alias("b"),
                i.alias("i"),
            ),
        )

    def alike(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))

    def covered(s: Column) -> Column:
        again = F.filter(
            s, lambda x, k: alike(x, F.get(s, k - 1)) | alike(x, F.get(s, k + 1))
        )
        places = F.flatten(
            F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        )
        return F.size(F.array_distinct(places))

    return let(words, lambda w: let(F.sort_array(windows(w)), covered)).cast("long")


def measures(text: Column) -> dict[str, Column]:
    """Words, counts of lines with a word (all and distinct), and symbols of a text column."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return {
        "words": words,
        "line_counts": let(
            lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n"),
                F.size(F.array_distinct(x)).cast("long").alias("d"),
            )
        ),
        "n_symbols": F.length(text).cast("long")
        - F.length(F.translate(text, SYMBOLS, "")).cast("long"),
    }


def quality(
    docs: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    base_rules: tuple[Rule, ...] = BASE_RULES,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Measures, `base_failed`, `kept` and the names of the failed rules beside `carry`."""
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    carried = [f"`{c}`" for c in named_apart(carry, RESULTS)]
    m = measures(F.col(f"`{text}`"))
    words, pairs = F.col("__words"), F.col("__lines")
    measured = docs.select(
        *carried,
        m["words"].alias("__words"),
        m["line_counts"].alias("__lines"),
        m["n_symbols"].alias("n_symbols"),
    ).select(
        *carried,
        let(
            words, lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.aggregate(
                    w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)
                ).alias("word_chars"),
                repeated_words(w).alias("n_repeat_words"),
                F.size(
                    F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))
                ).cast("long").alias("n_stop_words"),
            )
        ).alias("__m"),
        "n_symbols",
        pairs["n"].alias("n_lines"),
        (pairs["n"] - pairs["d"]).alias("n_dup_lines"),
    ).select(*carried, "__m.*", "n_symbols", "n_lines", "n_dup_lines")
    named = {name: F.col(name) for name in RESULTS[:7]}
    base_failed = ~F.lit(True)
    for rule in base_rules:
        base_failed = base_failed | ~rule_holds(rule, named)
    failed = F.array_compact(
        F.array(
            *[
                F.when(~rule_holds(r, named), F.lit(r.name))
                for r in (*base_rules, *rules)
            ]
        )
    )
    return measured.select(
        *carried,
        *RESULTS[:7],
        base_failed.alias("base_failed"),
        (F.size(failed) == 0).alias("kept"),
        failed.alias("failed_rules"),
    )
