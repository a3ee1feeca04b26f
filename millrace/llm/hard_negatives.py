"""Hard negatives by Fagin's threshold algorithm over blocks of candidates.

1. Vectors become whole numbers and are packed into candidate blocks and anchor blocks of bounded
   bytes; each pair of blocks is a group of its own.
2. In a pair, every dimension has a list of the candidates sorted by that component. An anchor reads
   each list from the top where its own component is positive, from the bottom where it is
   negative (sorted access). Candidates met for the first time are scored in full (random access).
   The threshold is the score of an imagined candidate that has the component reached in every
   list: nothing unseen can score higher.
3. First search: the best rows of the anchor's label, until the threshold falls strictly below the
   k-th best, so ties are all seen. Blocks' lists are merged by rank.
4. Second search: every positive opens a window of scores for rows of other labels. A window is
   done when it holds k rows and the threshold is strictly below its k-th, or when the threshold is
   strictly below its lower bound. An anchor is done when all its windows are.

A pair answers with at most k rows per anchor (and window), so merging never meets a group that
grows with the rows. Blocks are dealt by row number, so a label or vector that fills a third of the table is
spread evenly.

Cases: rows with a null id, label or vector, or with a null or non-finite component take no part;
shorter vectors are taken as ending in zeros; anchors of zeros score 0 everywhere; equal scores are
ordered by id, then by row; repeated rows are rows of their own (a row is never its own positive, its
repeat may be), and each repeated anchor gives its own results; an empty table gives an empty
result; other columns are not read. Scores beyond 53 bits are computed exactly, slowly, and are cut
to the range of a long when returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.runtime import materialized

#: Components are multiplied by this and floored.
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: Negatives score between these shares (in hundredths) of the positive's score.
LOW_PERCENT, HIGH_PERCENT = 50, 95
#: Bytes of packed vectors in a candidate block and in an anchor block, about.
CANDIDATE_BYTES, ANCHOR_BYTES = 4 << 20, 1 << 19
#: Sums of whole numbers up to here are exact as doubles.
EXACT = float(1 << 53)
#: Entries read from each list in the first step, and how many times more in every next one.
FIRST_DEPTH, DEEPER = 16, 4

LONGS = np.iinfo(np.int64)


def usable(vectors: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """Stored (row, id, label, vector) of the rows that take part."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return materialized(
        vectors.select(
            F.col(f"`{key}`").cast("long").alias("id"),
            F.col(f"`{label}`").cast("long").alias("label"),
            F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        )
        .dropna(subset=["id", "label", "vector"])
        .filter(~bad)
        .withColumn("row", F.monotonically_increasing_id()),
        "negatives-rows",
    )


def scaled(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(SCALE * v)
    return out


def packed(rows: DataFrame, blocks: int, width: int, *carry: str) -> DataFrame:
    """One row per block: its ids, labels and row numbers, the matrix, and carried columns as lists."""
    kinds = dict(rows.dtypes)
    shape = ", ".join(
        ["block int", "id array<long>", "label array<long>", "row array<long>", "matrix binary"]
        + [f"{c} array<{kinds[c]}>" for c in carry]
    )
    columns = to_arrow_schema(T.StructType.fromDDL(shape))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        vectors = [np.asarray(v, np.float64) for v in table.column("vector").to_pylist()]
        n = pa.array([0, table.num_rows], pa.int32())
        made = {
            c: pa.ListArray.from_arrays(n, table.column(c).combine_chunks())
            for c in ("id", "label", "row", *carry)
        } | {
            "block": table.column("block").slice(0, 1).combine_chunks(),
            "matrix": pa.array([scaled(vectors, width).tobytes()], pa.binary()),
        }
        return pa.table({f.name: made[f.name].cast(f.type) for f in columns})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(pack, shape)


class Lists:
    """A candidate block with its per-dimension sorted lists."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        across = np.ascontiguousarray(matrix.T)
        self.order = np.argsort(across, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(across, self.order, axis=1)
        self.largest = float(np.abs(matrix).max(initial=0.0))

    def scores(self, rows: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (self.matrix[rows] @ anchor).astype(np.int64)
        whole = np.array([int(x) for x in anchor.tolist()], object)
        return np.array(
            [sum(int(x) * a for x, a in zip(r, whole)) for r in self.matrix[rows].tolist()], object
        )

    def read(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Rows met for the first time, their scores, and the threshold after reading them."""
        n = len(self.matrix)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        # Rounded sums would not tell a tie from a lower score.
        exact = float(np.abs(anchor).sum()) * self.largest < EXACT
        unseen, left, depth, step, swept = np.ones(n, bool), n, 0, FIRST_DEPTH, None
        if not len(up) and not len(down):
            yield np.arange(n), np.zeros(n, np.int64), -np.inf
            return
        while left:
            to = min(n, depth + step)
            met = np.zeros(n, bool)
            met[self.order[up, n - to : n - depth].ravel()] = True
            met[self.order[down, depth:to].ravel()] = True
            new = np.flatnonzero(met & unseen)
            unseen[new] = False
            left -= len(new)
            if not left:
                threshold = -np.inf
            elif exact:
                threshold = float(anchor[up] @ self.values[up, n - to] + anchor[down] @ self.values[down, to - 1])
            else:
                threshold = np.inf
            if exact and swept is None and 8 * len(new) > n:  # one sweep is cheaper than many jumps
                swept = self.matrix @ anchor
            scores = self.scores(new, anchor, exact) if swept is None else swept[new].astype(np.int64)
            yield new, scores, threshold
            depth, step = to, DEEPER * step


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first by score, id and row."""
    if len(scores) > 4 * k and scores.dtype != object:
        # The k-th score bounds what can be among the first.
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= kth)
        return some[np.lexsort((rows[some], ids[some], -scores[some]))[:k]]
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i], rows[i]))[:k]
    return np.array(order, np.int64)


def first_of_label(block: Lists, ids, labels, rows, anchor, label: int, row: int, k: int):
    """Places and scores of the k best rows of the label, the anchor's own row left out."""
    mine = (labels == label) & (rows != row)
    places, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    for new, got, threshold in block.read(anchor):
        fit = mine[new]
        places, scores = np.concatenate([places, new[fit]]), np.concatenate([scores, got[fit]])
        keep = best(scores, ids[places], rows[places], k)
        places, scores = places[keep], scores[keep]
        if len(places) == k and threshold < scores[-1]:
            break
    return places, scores


def first_in_windows(block: Lists, ids, labels, rows, anchor, label: int, windows: list[tuple[int, int]], k: int):
    """Per window (lowest and highest score) places and scores of the k best rows of other labels."""
    others = labels != label
    found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
    open_windows = [i for i, (low, high) in enumerate(windows) if low <= high]
    if not open_windows:
        return found
    lowest = min(windows[i][0] for i in open_windows)
    for new, got, threshold in block.read(anchor):
        fit = np.flatnonzero(others[new] & (got >= lowest))
        new, got = new[fit], got[fit]
        still = []
        for i in open_windows:
            low, high = windows[i]
            inside = np.flatnonzero((got >= low) & (got <= high))
            if len(inside):
                places = np.concatenate([found[i][0], new[inside]])
                scores = np.concatenate([found[i][1], got[inside]])
                keep = best(scores, ids[places], rows[places], k)
                found[i] = places[keep], scores[keep]
            full = len(found[i][0]) == k and threshold < found[i][1][-1]
            if not full and not threshold < low:
                still.append(i)
        open_windows = still
        if not open_windows:
            break
    return found


def window_of(score: int, low_percent: int, high_percent: int) -> tuple[int, int]:
    """Whole scores s with low_percent * score <= 100 * s <= high_percent * score."""
    return -(-low_percent * score // 100), high_percent * score // 100


def met(anchors: DataFrame, candidates: DataFrame, width: int, search: Callable, shape: str) -> DataFrame:
    """Runs `search` for every anchor of every pair of an anchor block and a candidate block.

    Both sides are dealt by the pair's two numbers, so pairs spread evenly and a task holds one at
    a time.
    """

    def numbers(blocks: DataFrame) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks.agg(F.max("block")).first()[0] or 0)))

    ours = anchors.withColumn("other", numbers(candidates))
    theirs = candidates.withColumnRenamed("block", "other").withColumn("block", numbers(anchors))

    def work(asked: pa.Table, given: pa.Table) -> pa.Table:
        if not asked.num_rows or not given.num_rows:
            return empty
        pair, other = asked.to_pylist()[0], given.to_pylist()[0]
        block = Lists(np.frombuffer(other["matrix"]).reshape(-1, width))
        ids, labels, rows = (np.array(other[c], np.int64) for c in ("id", "label", "row"))
        matrix = np.frombuffer(pair["matrix"]).reshape(-1, width)
        return pa.concat_tables(
            search(block, ids, labels, rows, anchor, pair, i) for i, anchor in enumerate(matrix)
        )

    empty = pa.table({c.split()[0]: pa.array([], pa.int64()) for c in shape.split(", ")})
    return ours.groupBy("block", "other").cogroup(theirs.groupBy("block", "other")).applyInArrow(work, shape)


def whole(scores: np.ndarray) -> pa.Array:
    return pa.array([min(max(int(s), LONGS.min), LONGS.max) for s in scores.tolist()], pa.int64())


def hard_negatives(
    vectors: DataFrame,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    anchors: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    `anchors` is a condition on the columns `id` and `label` that names the rows to mine for; all
    rows without it.
    """
    rows = usable(vectors, key, label, vector)
    asked = rows if anchors is None else rows.filter(anchors)
    total = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    n, width = total["n"], max(total["width"] or 1, 1)
    n_anchors = asked.count()
    each = 8 * width
    blocks, a_blocks = 1 + n * each // CANDIDATE_BYTES, 1 + n_anchors * each // ANCHOR_BYTES
    candidates = materialized(packed(rows, blocks, width), "negatives-candidates")

    def same_label(block, ids, labels, nums, anchor, pair, i):
        places, scores = first_of_label(
            block, ids, labels, nums, anchor, pair["label"][i], pair["row"][i], positives
        )
        return pa.table({
            "row": pa.array(np.full(len(places), pair["row"][i], np.int64)),
            "positive_id": pa.array(ids[places]), "positive_row": pa.array(nums[places]),
            "score": whole(scores),
        })

    first = packed(asked, a_blocks, width)
    first = materialized(first, "negatives-anchors")
    near = met(first, candidates, width, same_label, "row long, positive_id long, positive_row long, score long")
    by_rank = Window.partitionBy("row").orderBy(F.desc("score"), "positive_id", "positive_row")
    near = near.withColumn("at", F.row_number().over(by_rank)).filter(F.col("at") <= positives)
    # At most `positives` entries a row.
    windows = near.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("at", "positive_id", "score"))).alias("windows")
    )
    second = materialized(
        packed(asked.join(windows, "row"), a_blocks, width, "windows"), "negatives-windows"
    )

    def in_windows(block, ids, labels, nums, anchor, pair, i):
        own = pair["windows"][i]
        bounds = [window_of(w["score"], low_percent, high_percent) for w in own]
        found = first_in_windows(block, ids, labels, nums, anchor, pair["label"][i], bounds, negatives)
        counts = [len(p) for p, _ in found]
        places = np.concatenate([p for p, _ in found])
        scores = np.concatenate([s for _, s in found])
        repeat = lambda values: pa.array(np.repeat(np.array(values, np.int64), counts))
        return pa.table({
            "row": pa.array(np.full(len(places), pair["row"][i], np.int64)),
            "anchor_id": pa.array(np.full(len(places), pair["id"][i], np.int64)),
            "at": repeat([w["at"] for w in own]),
            "positive_id": repeat([w["positive_id"] for w in own]),
            "positive_score": repeat([w["score"] for w in own]),
            "negative_id": pa.array(ids[places]), "negative_row": pa.array(nums[places]),
            "negative_score": whole(scores),
        })

    hard = met(
        second, candidates, width, in_windows,
        "row long, anchor_id long, at long, positive_id long, positive_score long, "
        "negative_id long, negative_row long, negative_score long",
    )
    by_score = Window.partitionBy("row", "at").orderBy(
        F.desc("negative_score"), "negative_id", "negative_row"
    )
    return hard.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def shifted(vectors: DataFrame, key: str = "vec_id", label: str = "label") -> DataFrame:
    """Every seventh id gets the next of ten labels: rows whose label misleads."""
    moved = F.when(F.col(key) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))
    return vectors.withColumn(label, moved)
