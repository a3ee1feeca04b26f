"""Secret scan with patterns and two character Markov models, in column expressions only.

1. Three kinds of pattern: an assignment to a telling name, an access key, a long run of hex digits.
2. Runs of key characters are judged by two Markov models of letter pairs, one of random strings and one
   of ordinary identifiers. A run is a find of kind `random` when the logarithm of the ratio of its
   two likelihoods passes a threshold.
3. Both models are counted from labelled samples in one aggregation: at most 62^2 pairs a label leave
   it, whatever the input's size. Without samples of its own the scan labels the input: values that
   the patterns name are random strings, the runs that hold none of them are identifiers.
4. The model becomes one literal array of whole thousandths, so a score is a sum of whole numbers
   and does not depend on an order.

Places come from splitting a text at its matches: running sums of the lengths between and of the
matches, in two levels, so that a text with many matches stays linear. No row moves: the scan is
one projection, and only training aggregates. Nothing runs in Python.

Cases: null and empty texts have no finds; equal places are ordered by kind; repeated rows are judged
one by one; an empty table gives an empty result, and training on it a model of equal
chances; results win over clashing columns; a text of any length is read whole (a run beyond
PIECE characters is scored in pieces, without the pairs across their borders).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import named_apart

#: Fixed patterns, and the fewest characters that count: of the value, or of the whole match.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6
)
ACCESS = (r"AKIA[A-Z0-9]+", 0, 20)
HEX = (r"[0-9a-f]+", 0, 24)
KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
RANDOM = "random"

#: Characters whose pairs the models judge; runs may also hold JOINTS, whose pairs say nothing.
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
JOINTS = "+/=_-"
#: The shortest run that is judged, and the shortest that is a sample of ordinary identifiers.
LEAST_RUN, LEAST_SAMPLE = 16, 8
#: Random when exp(THRESHOLD / 1000) times as likely as a random string.
THRESHOLD = 20_000
#: Weight of what a model expects of a letter without samples, in samples.
PRIOR = 62.0
#: Characters of a run scored at once; elements per block of running sums.
PIECE, BLOCK = 1024, 256

FIRST, WIDTH = ord(min(ALPHABET + JOINTS)), ord(max(ALPHABET)) - ord(min(ALPHABET + JOINTS)) + 1


def run_pattern(least: int) -> str:
    return f"[A-Za-z0-9{JOINTS}]{{{least},}}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def placed(lengths: Column) -> Column:
    """Start and end of each element of array<(gap, length, keep)>, by running sums in blocks."""
    place = "array<struct<start:int,end:int,keep:boolean>>"

    def add(state: Column, e: Column) -> Column:
        start = state["at"] + e["gap"]
        end = (start + e["length"]).alias("end")
        return F.struct(
            end.alias("at"),
            F.concat(state["out"], F.array(F.struct(start.alias("start"), end, e["keep"].alias("keep")))).alias("out"),
        )

    def add_block(state: Column, block: Column) -> Column:
        first = F.struct(state["at"].alias("at"), F.array().cast(place).alias("out"))
        return let(
            F.aggregate(block, first, add),
            lambda made: F.struct(
                made["at"].alias("at"),
                F.concat(state["out"], F.array(F.filter(made["out"], lambda p: p["keep"]))).alias("out"),
            ),
        )

    def blocks(all_of: Column) -> Column:
        last = F.floor((F.size(all_of) - 1) / BLOCK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: F.slice(all_of, i * BLOCK + 1, BLOCK)
        )

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{place}>").alias("out"))
    return let(
        lengths, lambda all_of: F.flatten(F.aggregate(blocks(all_of), nothing, add_block)["out"])
    )


def found(text: Column, pattern: str, keep: Callable[[Column, Column], Column], group: int = 0) -> Column:
    """Start and end of the matches for which `keep` holds of the match and its group, in order."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    gaps = let(F.split(text, pattern, -1), lambda g: F.slice(g, 1, F.size(g) - 1))
    lengths = F.transform(
        F.arrays_zip(gaps.alias("gap"), matches.alias("match"), values.alias("value")),
        lambda e: F.struct(
            F.char_length(e["gap"]).alias("gap"),
            F.char_length(e["match"]).alias("length"),
            keep(e["match"], e["value"]).alias("keep"),
        ),
    )
    none = F.array().cast("array<struct<start:int,end:int,keep:boolean>>")
    return F.when(text.rlike(pattern), placed(lengths)).otherwise(none)


def long_pattern(kind: str) -> str:
    """The kind's pattern. Matches of the last two kinds are runs, so short ones need not be met."""
    pattern, _, least = KINDS[kind]
    if kind == "access":
        return f"AKIA[A-Z0-9]{{{least - 4},}}"
    return f"[0-9a-f]{{{least},}}" if kind == "hex" else pattern


def base_finds(text: Column, kind: str) -> Column:
    _, group, least = KINDS[kind]
    return found(text, long_pattern(kind), lambda match, value: F.char_length(value) >= least, group)


def labelled_samples(docs: DataFrame, text: str = "text", least: int = LEAST_SAMPLE) -> DataFrame:
    """(sample, random) from the texts themselves: values that the patterns name, and other runs."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    pattern, group, value_least = ASSIGN
    named = F.flatten(F.array(
        F.filter(
            F.regexp_extract_all(whole, F.lit(pattern), F.lit(group)), lambda v: F.char_length(v) >= value_least
        ),
        F.regexp_extract_all(whole, F.lit(long_pattern("access")), F.lit(0)),
        F.regexp_extract_all(whole, F.lit(long_pattern("hex")), F.lit(0)),
    ))
    other = F.regexp_extract_all(
        F.regexp_replace(
            F.regexp_replace(F.regexp_replace(whole, pattern, " "), long_pattern("access"), " "),
            long_pattern("hex"), " ",
        ),
        F.lit(run_pattern(least)), F.lit(0),
    )
    both = F.array(
        F.struct(named.alias("samples"), F.lit(True).alias("random")),
        F.struct(other.alias("samples"), F.lit(False).alias("random")),
    )
    return docs.select(F.explode(both).alias("b")).select(
        F.explode("b.samples").alias("sample"), F.col("b.random").alias("random")
    )


def pieces_of(run: Column) -> Column:
    return F.regexp_extract_all(run, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def code(char: Column) -> Column:
    return F.ascii(char) - FIRST


def train(samples: DataFrame, prior: float = PRIOR) -> list[int]:
    """Log-likelihood ratios of letter pairs, random over ordinary, in thousandths.

    `samples` has a text `sample` and a boolean `random`. Random strings are expected to draw all letters
    alike, identifiers to draw them as their samples do on the whole; an identifier is as ordinary in capitals.
    The driver gets at most 2 * len(ALPHABET)^2 counts.
    """
    pairs = (
        samples.filter("sample IS NOT NULL AND random IS NOT NULL")
        .select("random", F.explode(pieces_of(F.col("sample"))).alias("piece"))
        .select("random", F.split("piece", "").alias("c"))
        .filter(F.size("c") > 1)
        .select("random", F.explode(F.arrays_zip(
            F.slice("c", 1, F.size("c") - 1).alias("a"), F.slice("c", 2, F.size("c") - 1).alias("b")
        )).alias("p"))
        .groupBy("random", F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("n"))
        .filter(F.col("a").rlike("^[0-9A-Za-z]$") & F.col("b").rlike("^[0-9A-Za-z]$"))
    )
    counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for r in pairs.collect():
        counts[r["random"]][r["a"], r["b"]] += r["n"]
        if not r["random"] and r["a"].islower() and r["b"].islower():
            counts[False][r["a"].upper(), r["b"].upper()] += r["n"]
    chances = [chances_of(counts[True], prior, alike=True), chances_of(counts[False], prior, alike=False)]
    table = [0] * (WIDTH * WIDTH)
    for a, b in product(ALPHABET, repeat=2):
        ratio = math.log(chances[0][a, b]) - math.log(chances[1][a, b])
        table[(ord(a) - FIRST) * WIDTH + ord(b) - FIRST] = round(1000 * ratio)
    return table


def chances_of(counts: Counter, prior: float, alike: bool) -> dict[tuple[str, str], float]:
    """Chance of the second letter of a pair after its first."""
    first, second = Counter(), Counter()
    for (a, b), n in counts.items():
        first[a] += n
        second[b] += n
    expected = {
        b: 1 / len(ALPHABET) if alike else (second[b] + 1) / (second.total() + len(ALPHABET)) for b in ALPHABET
    }
    return {
        (a, b): (counts[a, b] + prior * expected[b]) / (first[a] + prior)
        for a, b in product(ALPHABET, repeat=2)
    }


def score(run: Column, model: list[int]) -> Column:
    """Thousandths of the log-likelihood ratio of a run."""
    table = F.expr(f"array({', '.join(map(str, model))})")

    def of_piece(piece: Column) -> Column:
        return let(
            F.split(piece, ""),
            lambda c: F.aggregate(
                F.arrays_zip(F.slice(c, 1, F.size(c) - 1).alias("a"), F.slice(c, 2, F.size(c) - 1).alias("b")),
                F.lit(0).cast("long"),
                lambda total, p: total + F.get(table, code(p["a"]) * WIDTH + code(p["b"])),
            ),
        )

    return F.aggregate(
        F.transform(pieces_of(run), of_piece), F.lit(0).cast("long"), lambda total, s: total + s
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, by start, then by kind as listed."""
    names = F.array(*[F.lit(k) for k in (*KINDS, RANDOM)])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]),
        ),
        ",",
    )


def secret_scan(
    docs: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    model: list[int] | None = None,
    threshold: int = THRESHOLD,
    least: int = LEAST_RUN,
) -> DataFrame:
    """Carried columns (`doc_id` by default), n_assign, n_access, n_hex, base_spans and spans.

    Spans are kind:start:end in code points, joined by commas; `base_spans` are those of the patterns alone.
    Without a `model` one is trained from `labelled_samples` of the texts.
    """
    if model is None:
        model = train(labelled_samples(docs, text))
    results = ["n_assign", "n_access", "n_hex", "base_spans", "spans"]
    carried = named_apart(["doc_id"] if carry is None else carry, results)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    judged = found(whole, run_pattern(least), lambda match, _: score(match, model) >= threshold)
    finds = [*[base_finds(whole, k) for k in KINDS], judged]

    def numbered(spans: Column, kind: int) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")),
        )

    made = docs.select(
        *[F.col(f"`{c}`") for c in carried],
        F.array(*[numbered(f, i) for i, f in enumerate(finds)]).alias("__finds"),
    )
    sizes = {name: F.size(F.get("__finds", i)).cast("long") for i, name in enumerate(results[:3])}
    return made.select(
        *[F.col(f"`{c}`") for c in carried],
        *[size.alias(name) for name, size in sizes.items()],
        listed(F.flatten(F.slice("__finds", 1, len(KINDS)))).alias("base_spans"),
        listed(F.flatten("__finds")).alias("spans"),
    )
