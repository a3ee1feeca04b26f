"""Spelling variants by finite-state composition.

1. Runs of letters are counted per task, then summed; the vocabulary is the words seen often enough.
2. Two words are near when one edit turns one into the other. The machine that says so is the
   composition of the vocabulary's acceptor with a transducer of exactly one edit and the acceptor
   again. Both sides read the same letters up to the edit, so the edit stands at the length
   c of their common beginning, and no pair has two such places.
3. The composition is cut by initial state. A partition (s, lo, hi) holds words of s code points
   (and of s + 1, for insertions) whose edit is in lo <= c < hi: all share the first lo code points, so
   the machine starts in the state those lead to, and they share what follows the zone. A word
   is in four partitions: two halves, as the shorter and as the longer word. A partition with too many
   words is cut again at the middle of its zone, until a zone is one place; there the alphabet
   bounds it.
4. A partition's words are built into minimised acceptors (states with equal futures are
   one), and the composed machine is walked: up to the edit in one state on either side, behind it in the
   intersection of two futures. Accepted pairs are counted at once; each task reports a word's number of
   near words and the best of them, never the pairs.
5. A word's form is its near word of largest count, where that is large enough; forms are followed to the
   last by doubling. Counts at least double from word to form, so chains are short.

Cases: null and empty texts have no words; a null id counts as empty in the hash; equal counts go to
the word that is smaller in code-point order; repeated rows count again; an empty table gives an
empty result; other columns are not read; a text of any length is read whole, in runs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.runtime import lookup_join, materialized

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: One run in this many loses a code point.
SLIP = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form is at least this many times as frequent.
FORM_FACTOR = 2
#: Words a task counts before it hands them on.
COUNTED_WORDS = 1 << 17
#: Words of a partition beyond which it is cut again, and rows met by one task, about.
PARTITION_WORDS, TASK_ROWS = 1 << 14, 1 << 16
#: Texts beyond this many code points are not listed as runs at once.
LONG_TEXT = 1 << 20


def runs_of(text: str) -> Counter:
    if len(text) <= LONG_TEXT:
        return Counter(RUN.findall(text))
    return Counter(m.group() for m in RUN.finditer(text))


def slipped(name: str, run: str) -> str:
    """The run in lower case; where the hash of name and run says so, without one code point."""
    low = run.translate(LOWER)
    h = zlib.crc32(f"{name}:{low}".encode())
    return low if h % SLIP else low[: h % len(low)] + low[h % len(low) + 1 :]


def vocabulary(docs: DataFrame, key: str, text: str, least_length: int, least_count: int) -> DataFrame:
    """Stored (word, n) of the words that are long and frequent enough."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())],
            names=["word", "n"],
        )

    def count(batches):
        counts: Counter = Counter()
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns)):
                for run, n in runs_of(text or "").items():
                    word = slipped(name or "", run)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= COUNTED_WORDS:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    read = docs.select(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`"))
    counted = read.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialized(counted.filter(F.col("n") >= least_count), "spelling-words")


class Acceptors:
    """Minimised acceptors that share their states. State 0 accepts the empty word only."""

    def __init__(self):
        self.edges: list[dict[str, int]] = [{}]
        self.known: dict[tuple, int] = {(): 0}

    def state(self, edges: dict[str, int]) -> int:
        name = tuple(edges.items())
        if name not in self.known:
            self.known[name] = len(self.edges)
            self.edges.append(edges)
        return self.known[name]

    def add(self, words: list[str]) -> int | None:
        """Initial state of the acceptor of these sorted, distinct words of one length."""
        if not words:
            return None
        path: list[dict[str, int]] = [{} for _ in words[0]]
        last = words[0]
        for word in words[1:]:
            same = next(i for i, (a, b) in enumerate(zip(last, word)) if a != b)
            self.close(path, last, same)
            last = word
        self.close(path, last, 0)
        return self.state(path[0]) if path else 0

    def close(self, path: list[dict[str, int]], word: str, down_to: int) -> None:
        """Enters the states of `word` below the place `down_to` into the minimal ones."""
        after = 0
        for i in range(len(word) - 1, down_to - 1, -1):
            path[i][word[i]] = after
            if i > down_to:
                after = self.state(path[i])
                path[i] = {}

    def common(self, p: int, q: int, but: str = "") -> Iterator[str]:
        """Words that both states accept; none that begins with `but`."""
        todo = [(p, q, "")]
        while todo:
            p, q, read = todo.pop()
            if not p and not q:
                yield read
                continue
            mine, theirs = self.edges[p], self.edges[q]
            for a, to in mine.items():
                if a in theirs and not (a == but and not read):
                    todo.append((to, theirs[a], read + a))

    def one_edit(self, short: int | None, long: int | None, zone: int) -> Iterator[tuple[str, str]]:
        """Pairs the composed machine accepts with the edit at one of the first `zone` places: one
        replaced (short, short) or one inserted code point (short, long)."""
        todo = [(short, long, "")]
        while todo:
            p, q, read = todo.pop()
            if p is None or len(read) >= zone:
                continue
            mine = [*self.edges[p].items()]
            theirs = self.edges[q] if q is not None else {}
            for i, (a, after_a) in enumerate(mine):
                for b, after_b in mine[i + 1 :]:
                    for rest in self.common(after_a, after_b):
                        yield read + a + rest, read + b + rest
                todo.append((after_a, theirs.get(a), read + a))
            for b, after_b in theirs.items():
                for rest in self.common(p, after_b, but=b):
                    yield read + rest, read + b + rest


def near_pairs(size: int, low: int, high: int, words: list[str]) -> Iterator[tuple[str, str]]:
    """Near pairs of one partition: words of `size` and `size` + 1 code points with the same first
    `low` and the same behind `high`, whose common beginning ends in low .. high - 1."""
    machine, tail = Acceptors(), words[0][high + len(words[0]) - size :]
    middles: list[list[str]] = [[], []]
    for word in words:
        middles[len(word) - size].append(word[low : len(word) - len(tail)])
    head = words[0][:low]
    short, long = (machine.add(sorted(m)) for m in middles)
    for a, b in machine.one_edit(short, long, high - low):
        yield head + a + tail, head + b + tail


def partitions(words: DataFrame, least_length: int, limit: int) -> DataFrame:
    """Stored rows (s, lo, hi, word, n): each word in the partitions where it meets its near words."""

    def keyed(rows: DataFrame) -> DataFrame:
        longer = F.char_length("word") - F.col("s")
        return rows.withColumn("head", F.expr("substring(word, 1, lo)")).withColumn(
            "tail", F.substring("word", F.col("hi") + longer + 1, F.char_length("word"))
        )

    def zones(low: Column, high: Column) -> Column:
        middle = F.floor((low + high) / 2).cast("int")
        return F.explode(F.array(
            F.struct(low.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), high.alias("hi"))
        ))

    size = F.char_length("word").cast("int")
    rows = (
        words.withColumn("s", F.explode(F.array(size, size - 1)))
        .filter(F.col("s") >= least_length)
        .withColumn("zone", zones(F.lit(0), F.col("s") + 1))
        .select("s", "zone.lo", "zone.hi", "word", "n")
    )
    rows, done = materialized(keyed(rows), "spelling-partitions"), []
    key = ["s", "lo", "hi", "head", "tail"]
    while True:
        many = materialized(
            rows.groupBy(*key).agg(F.count("*").alias("words"))
            .filter((F.col("words") > limit) & (F.col("hi") - F.col("lo") > 1))
            .select(*key, F.lit(True).alias("many")),
            "spelling-many",
        )
        if many.isEmpty():
            break
        marked = materialized(lookup_join(rows, many, key), "spelling-marked")
        done.append(marked.filter("many IS NULL").drop("many"))
        cut = marked.filter("many").withColumn("zone", zones(F.col("lo"), F.col("hi")))
        rows = materialized(keyed(cut.select("s", "zone.lo", "zone.hi", "word", "n")), "spelling-partitions")
    for more in done:
        rows = rows.unionByName(more)
    return rows


def near_words(words: DataFrame, least_length: int, limit: int) -> DataFrame:
    """Per word with a near one: n_near, and the best near word with its count."""
    rows = partitions(words, least_length, limit)
    tasks = 1 + rows.count() // TASK_ROWS

    def compose(table: pa.Table) -> pa.Table:
        counts: dict[str, int] = {}
        groups: dict[tuple, list[str]] = defaultdict(list)
        for s, lo, hi, word, n in zip(*(table.column(c).to_pylist() for c in ("s", "lo", "hi", "word", "n"))):
            counts[word] = n
            groups[s, lo, hi, word[:lo], word[hi + len(word) - s :]].append(word)
        found: Counter = Counter()
        best: dict[str, tuple[int, str]] = {}
        for (s, lo, hi, _, _), own in groups.items():
            if len(own) == 1:
                continue
            for a, b in near_pairs(s, lo, hi, own):
                for word, other in ((a, b), (b, a)):
                    found[word] += 1
                    offer = (-counts[other], other)
                    if word not in best or offer < best[word]:
                        best[word] = offer
        return pa.table({
            "word": pa.array([*found], pa.string()),
            "n_near": pa.array([*found.values()], pa.int64()),
            "near_n": pa.array([-best[w][0] for w in found], pa.int64()),
            "near": pa.array([best[w][1] for w in found], pa.string()),
        })

    met = rows.withColumn("task", F.pmod(F.xxhash64("s", "lo", "hi", "head", "tail"), F.lit(tasks)))
    parts = met.select("task", "s", "lo", "hi", "word", "n").groupBy("task").applyInArrow(
        compose, "word string, n_near long, near_n long, near string"
    )
    return parts.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for stored (word, form): forms followed to the last, doubling the step."""
    steps = forms.select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialized(lookup_join(steps, further, ["root"]), "spelling-roots")
        steps = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.filter("further IS NOT NULL").isEmpty():
            return steps


def spelling_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    form_factor: int = FORM_FACTOR,
    partition_words: int = PARTITION_WORDS,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = vocabulary(docs, key, text, least_length, least_count)
    near = near_words(words, least_length, partition_words)
    likely = F.col("best.minus") <= -form_factor * F.col("n")
    formed = materialized(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(likely, F.col("best.near")).alias("form"),
            F.when(likely, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    last = roots(formed.filter("form IS NOT NULL").select("word", "form"))
    return lookup_join(formed, last, ["word"]).select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
