"""Mixing sources to target weights by entropy balancing.

Sources get shares of a word budget by weight, none above a multiple of what it has (the excess is
shared out again). Document rates r between 0 and the cap c stay as close to 1 as the word totals
of the sources allow: they maximise an entropy, so log(r / (c - r)) is an exponential tilt
`log(1 / (c - 1)) + lambda * x`, where x is a document's size over the mean size of its source. The
multipliers solve the convex dual by Newton steps; every step is one Spark aggregation over the
histogram of sizes. Rates become whole copies by error diffusion: inside buckets of bounded
size, largest documents first, the words still owed decide the next document. Small documents come
last, so a bucket ends within about a word of its share and no source passes through one task.

Nothing depends on the order or partitioning of rows, so reruns agree.

Cases: null and empty texts have size 0, rate 1 and take no words; a null source is a source of its
own, after all others; rows equal in id, source and text are one run, counted before the shuffle: it takes
what is owed as a whole, so some of its rows may get one copy more than the rest (they are
interchangeable); an empty table gives an empty result; other columns of the input are not read. The
driver holds one row per source (the table of weights is as long) and nothing per document.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrow import released_group
from millrace.runtime import lookup_join, materialized

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: Words of the mix over the words there are, and the most copies of a document.
SHARE = 1.5
CAP = 2
#: Documents per bucket in which copies are rounded, about.
BUCKET_DOCS = 4096
#: Equal rows made from one by a task at once.
REPEATED = 1 << 14
MAX_STEPS = 60
TOLERANCE = 1e-7
RESULTS = ("size", "source_size", "target", "rate", "copies", "taken")


@dataclass
class Source:
    key: str
    docs: int
    size: int
    target: float = 0.0
    tilt: float = 0.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Sources as non-null text that sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("a"), source.cast("string")), F.lit("b"))


def capped_shares(sizes: Sequence[int], weights: Sequence[float], share: float, cap: float):
    """Targets by weight, none above cap times its size; the excess goes to the others by weight."""
    targets = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in sorted(open_))
        above = {i for i in open_ if left * weights[i] / total > cap * sizes[i]}
        for i in above or open_:
            targets[i] = float(cap * sizes[i]) if above else left * weights[i] / total
        if not above:
            break
        left -= sum(cap * sizes[i] for i in above)
        open_ -= above
    return targets


def rates(x, tilt, cap: float):
    """Documents' rates for sizes x (over the mean) under a tilt; works on columns and on arrays."""
    exp = F.exp if isinstance(tilt, Column) else np.exp
    return cap / (1.0 + (cap - 1.0) * exp(-tilt * x))


def solve(histogram: DataFrame, sources: list[Source], cap: float) -> None:
    """Newton steps on the dual, all sources at once; sets `tilt`.

    `histogram` has `s` (place of the source), `size` and `n`. A source at its cap has an infinite
    tilt. The words taken grow with the tilt, so a bracket keeps every step safe.
    """
    mean = [max(s.size / max(s.docs, 1), 1e-9) for s in sources]
    low, high = [-math.inf] * len(sources), [math.inf] * len(sources)
    todo = set()
    for i, s in enumerate(sources):
        if s.target >= cap * s.size:
            s.tilt = math.inf
        elif s.target <= 0:
            s.tilt = -math.inf
        else:
            todo.add(i)
    for _ in range(MAX_STEPS):
        if not todo:
            break
        session = histogram.sparkSession
        now = session.createDataFrame(  # one row per source
            [(i, mean[i], sources[i].tilt) for i in sorted(todo)], "s int, mean double, tilt double"
        )
        x = F.col("size") / F.col("mean")
        r = rates(x, F.col("tilt"), cap)
        sums = (
            histogram.join(F.broadcast(now), "s")
            .groupBy("s")
            .agg(
                F.sum(F.col("n") * x * r).alias("taken"),
                F.sum(F.col("n") * x * x * r * (1 - r / cap)).alias("slope"),
            )
            .collect()
        )
        for row in sums:
            i = row["s"]
            s, off = sources[i], row["taken"] - sources[i].target / mean[i]
            if abs(off) * mean[i] <= TOLERANCE * s.target:
                todo.discard(i)
                continue
            if off > 0:
                high[i] = s.tilt
            else:
                low[i] = s.tilt
            step = -off / row["slope"] if row["slope"] > 0 else math.inf
            tilt = s.tilt + max(-4.0, min(4.0, step))
            if not low[i] < tilt < high[i]:
                ends = (low[i], high[i])
                tilt = sum(ends) / 2 if all(map(math.isfinite, ends)) else s.tilt + math.copysign(
                    4.0, -off
                )
            if tilt == s.tilt:
                todo.discard(i)
            s.tilt = tilt
    if todo:
        warnings.warn(f"{len(todo)} sources miss the tolerance after {MAX_STEPS} Newton steps", stacklevel=2)


def round_copies(rows: pd.DataFrame, cap: int) -> pd.DataFrame:
    """Whole copies for one bucket of runs: `size`, `rate` and `n` (equal rows) per run, named by `u1` and
    `u2`. Every row of a run gets `low` copies, `more` of them one copy more."""
    rows = rows.sort_values(["size", "u1", "u2"], ascending=[False, True, True], kind="stable")
    low, more, owed = [], [], 0.0
    for size, rate, n in zip(rows["size"].tolist(), rows["rate"].tolist(), rows["n"].tolist()):
        base, extra = min(int(rate), cap), 0
        owed += (rate - base) * size * n
        if size:
            extra = math.floor(owed / size + 0.5)
            extra = max(-n if base else 0, min(n if base < cap else 0, extra))
            owed -= extra * size
        if extra < 0:
            base, extra = base - 1, extra + n
        elif extra == n:
            base, extra = base + 1, 0
        low.append(base)
        more.append(extra)
    return rows.assign(low=np.array(low, np.int64), more=np.array(more, np.int64))


def repeated(rows: DataFrame, times: Column, to: str) -> DataFrame:
    """Every row `times` times, numbered from 0 in `to`; large numbers are dealt out in blocks."""
    blocks = rows.withColumn("__times", times.cast("long")).filter("__times > 0").withColumn(
        "__first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__times") - 1, F.lit(REPEATED).cast("long")))
    )
    last = F.least(F.col("__first") + REPEATED, F.col("__times")) - 1
    return blocks.withColumn(to, F.explode(F.sequence("__first", last))).drop("__times", "__first")


def sized_rows(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """One narrow row per document: id, source, size, and two digests that name equal rows."""
    k, s, t = (F.col(f"`{c}`") for c in (key, source, text))
    parts = [k.cast("string"), source_key(s), t]
    return docs.select(
        k.alias("key"),
        source_key(s).alias("source"),
        word_count(t).alias("size"),
        F.xxhash64(*parts).alias("u1"),
        F.xxhash64(F.lit("second"), *parts).alias("u2"),
    )


def plan_mix(
    sized: DataFrame, weights: Sequence[float], share: float, cap: int
) -> DataFrame:
    """One row per run of equal (stored) narrow rows: n of them, with source_size, target, rate, and copies
    as `low` and `more`."""
    spark = sized.sparkSession
    found = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("size"))
    sources = [Source(*row) for row in sorted(found.collect())]  # one row per source
    targets = capped_shares(
        [s.size for s in sources], [weights[i % len(weights)] for i in range(len(sources))],
        share, cap,
    )
    for s, target in zip(sources, targets):
        s.target = target
    places = spark.createDataFrame(  # one row per source
        [(s.key, i) for i, s in enumerate(sources)], "source string, s int"
    )
    histogram = materialized(
        sized.groupBy("source", "size").agg(F.count("*").alias("n"))
        .join(F.broadcast(places), "source").select("s", "size", "n"),
        "mix-sizes",
    )
    solve(histogram, sources, cap)
    table = spark.createDataFrame(  # one row per source
        [
            (s.key, s.size, s.target, s.tilt, max(s.size / max(s.docs, 1), 1e-9),
             math.ceil(s.docs / BUCKET_DOCS))
            for s in sources
        ],
        "source string, source_size long, target double, tilt double, mean double, buckets int",
    )
    x, tilt = F.col("size") / F.col("mean"), F.col("tilt")
    rate = (
        F.when(F.col("size") == 0, 1.0)
        .when(tilt == math.inf, float(cap))
        .when(tilt == -math.inf, 0.0)
        .otherwise(rates(x, tilt, cap))
    )
    runs = sized.groupBy(*sized.columns).agg(F.count("*").alias("n"))
    rated = runs.join(F.broadcast(table), "source").select(
        *runs.columns, "source_size", "target", rate.alias("rate"),
        F.pmod(F.col("u1"), F.col("buckets")).alias("bucket"),
    )
    return rated.groupBy("source", "bucket").applyInPandas(
        released_group(lambda rows: round_copies(rows, cap)),
        "key {}, source string, size long, u1 long, u2 long, n long, source_size long, "
        "target double, rate double, bucket long, low long, more long".format(
            sized.schema["key"].dataType.simpleString()
        ),
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
) -> DataFrame:
    """One row per document: its id and source, and the columns of `RESULTS`."""
    if cap < 2 or not all(w > 0 for w in weights):
        raise ValueError("weights are positive and the cap is a whole number of at least 2")
    runs = plan_mix(
        materialized(sized_rows(docs, key, source, text), "mix-rows"), weights, share, cap
    )
    copies = F.col("low") + (F.col("__i") < F.col("more")).cast("long")
    planned = repeated(runs, F.col("n"), "__i").withColumn("copies", copies).withColumn(
        "taken", F.col("copies") * F.col("size")
    )
    back = F.when(F.col("source") != "b", F.substring("source", 2, 2**31 - 1))
    return planned.select(
        F.col("key").alias(key),
        *([back.cast(docs.schema[source].dataType).alias(source)] if key != source else []),
        *RESULTS,
    )


def mixed_documents(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
) -> DataFrame:
    """The mix itself: every document as often as its copies say, with the columns of `docs`."""
    sized = materialized(sized_rows(docs, key, source, text), "mix-rows")
    decided = plan_mix(sized, weights, share, cap).select("u1", "u2", "low", "more")
    kept = materialized(decided.filter("low + more > 0"), "mix-copies")
    k, s, t = (F.col(f"`{c}`") for c in (key, source, text))
    parts = [k.cast("string"), source_key(s), t]
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.xxhash64(*parts).alias("u1"),
        F.xxhash64(F.lit("second"), *parts).alias("u2"),
    )
    taken = repeated(
        lookup_join(named, kept.filter("more = 0"), ["u1", "u2"], "inner"), F.col("low"), "__copy"
    ).select("__row.*")
    split = kept.filter("more > 0")
    if split.isEmpty():
        return taken
    # Runs of which only some rows get one copy more: rows equal in every column are counted, and the
    # copies go to them in the order of their digests.
    alike = materialized(
        lookup_join(named, split, ["u1", "u2"], "inner")
        .withColumn("__digest", F.xxhash64(F.to_json("__row")))
        .groupBy("u1", "u2", "__digest", "low", "more")
        .agg(F.first("__row").alias("__row"), F.count("*").alias("__n")),
        "mix-alike",
    )
    earlier = Window.partitionBy("u1", "u2").orderBy("__digest").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("more") - F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    share_of = F.col("low") * F.col("__n") + F.greatest(F.lit(0), F.least(F.col("__n"), left))
    counted = alike.withColumn("__copies", share_of.cast("long"))
    return taken.unionByName(repeated(counted, F.col("__copies"), "__copy").select("__row.*"))
