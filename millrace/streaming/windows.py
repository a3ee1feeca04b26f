"""Sliding-window sums kept up with their inverse: add the slide that enters, subtract the one that leaves.

The state is a table of signed changes per (key, slide): a slide's count when it enters the windows and
its negative `size / slide` slides later. What lies before the horizon is folded into one running sum per
key, so a window's value is the one before it plus the changes of its last slide; no window is counted
again from its rows. A key whose changes cancel out is gone from the state.

The horizon is the last slide whose windows are closed. It follows the greatest time seen, less the
delay. Rows behind it are not lost: each closed window they belong to is corrected by a row of its own, and the
running sum takes them in. Window values are the sums of their output rows.

State and horizon are one commit. Output is stored under the batch's key before that commit, so a batch
that is replayed writes the same output again, or finds itself in the state and does nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.runtime import materialized
from millrace.sinks.commits import FOLD_AFTER, CommittedTable
from millrace.sinks.ledger import BatchKey, put_batch, read_batches, summed
from millrace.streaming.jobs import start

HORIZON = "horizon"


class InverseWindow:
    """Counts per (sliding window, key) of event time; lengths are in seconds."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: str,
        size: int,
        slide: int,
        delay: int = 0,
        ts: str = "ts",
        fold_after: int = FOLD_AFTER,
    ) -> None:
        if size % slide:
            raise ValueError("a window is a whole number of slides")
        self.key, self.ts, self.slide, self.size = key, ts, slide, size
        self.slides, self.delay = size // slide, -(-delay // slide)
        self.out = f"{root}/out"
        self.state = CommittedTable(spark, f"{root}/state", self._merged, fold_after)

    def start(self, events: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return start(events, self.add, checkpoint, trigger=trigger)

    def add(self, batch: DataFrame, key: BatchKey) -> None:
        """Takes in a batch and closes the windows that its times have made complete."""
        at = self.state.latest()
        if at.holds(key):
            return
        micros = F.unix_micros(F.col(self.ts).cast("timestamp"))
        width = self.slide * 1_000_000
        slot = ((micros - F.pmod(micros, F.lit(width))) / width).cast("long")
        counts = materialized(
            batch.filter(F.col(self.ts).isNotNull())
            .groupBy(F.col(self.key), slot.alias("slot")).agg(F.count("*").alias("n")),
            "window-counts",
        )
        low, high = counts.agg(F.min("slot"), F.max("slot")).first()
        if low is None:
            return
        before = at.note.get(HORIZON, low - 1)
        after = max(before, high - self.delay - 1)
        fresh = counts.select(
            self.key,
            F.explode(F.array(
                F.struct("slot", F.col("n").alias("change")),
                F.struct((F.col("slot") + self.slides).alias("slot"), (-F.col("n")).alias("change")),
            )).alias("c"),
        ).select(self.key, "c.slot", "c.change")
        last = F.least(F.col("slot") + self.slides - 1, F.lit(before))
        late = counts.filter(F.col("slot") <= before).select(
            F.explode(F.sequence("slot", last)).alias("slot"), self.key, "n"
        )
        known = self.state.read(at)
        closed = self._closed(fresh if known is None else known.unionByName(fresh), before, after)
        put_batch(closed.unionByName(late), self.out, key)
        self.state.put(fresh, key, {HORIZON: after})

    def close(self) -> None:
        """Closes all windows that hold rows, for an input that has ended."""
        at = self.state.latest()
        if HORIZON not in at.note:
            return
        before = at.note[HORIZON]
        rows = self.state.read(at)
        after = rows.agg(F.max("slot")).first()[0]
        if after is None or after <= before:
            return
        key = BatchKey("close", after)
        put_batch(self._closed(rows, before, after), self.out, key)
        self.state.put(rows.limit(0), key, {HORIZON: after})

    def totals(self) -> DataFrame:
        """win_start, win_end, key and n of all windows closed so far."""
        stored = summed(read_batches(self.state.spark, self.out), ["slot", self.key], ["n"])
        end = (F.col("slot") + 1) * self.slide
        return stored.select(
            F.timestamp_seconds(end - self.size).alias("win_start"),
            F.timestamp_seconds(end).alias("win_end"), self.key, "n",
        )

    def _closed(self, changes: DataFrame, before: int, after: int) -> DataFrame:
        """(slot, key, n) of the windows that end with slides before < slot <= after.

        A key has at most one row per slide here, whatever its number of events.
        """
        running = Window.partitionBy(self.key).orderBy("slot")
        steps = (
            _collapsed(changes, self.key, before).filter(F.col("slot") <= after)
            .withColumn("n", F.sum("change").over(running.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("until", F.coalesce(F.lead("slot").over(running), F.lit(after + 1)) - 1)
            .withColumn("first", F.greatest("slot", F.lit(before + 1)))
            .filter((F.col("n") != 0) & (F.col("first") <= F.col("until")))
        )
        return steps.select(F.explode(F.sequence("first", "until")).alias("slot"), self.key, "n")

    def _merged(self, changes: DataFrame, note: dict) -> DataFrame:
        return _collapsed(changes, self.key, note[HORIZON]).filter("change <> 0")


def _collapsed(changes: DataFrame, key: str, horizon: int) -> DataFrame:
    """Changes up to the horizon as one running sum per key, the others summed per slide."""
    slot = F.greatest(F.col("slot"), F.lit(horizon)).alias("slot")
    return changes.select(key, slot, "change").groupBy(key, "slot").agg(F.sum("change").alias("change"))
