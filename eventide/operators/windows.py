"""Tumbling and sliding event-time counts.

Spark's `window()` copies every row into each sliding window that covers it: 720 copies for one hour
sliding by five seconds. Here rows are first counted per (key, pane), a pane being one slide long, so
a hot key shrinks before the first shuffle. A pane adds its count to the windows it enters and takes
it away where it leaves, hence a window's count is the running sum of those changes. Only the changes
are shuffled, and the counts come out as runs of windows with the same value.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.eventtime import bucket, epoch_micros, instant, micros, window_end

# Changes are summed in blocks of this many window sizes, which bounds the rows per (key, block).
SIZES_PER_BLOCK = 24


def tumbling_count(events: DataFrame, size: timedelta, keys: list[str] | None = None) -> DataFrame:
    return (events.groupBy(window_end("ts", size).alias("window_end"), *(keys or []))
            .agg(F.count(F.lit(1)).alias("cnt")))


def salted_tumbling_count(events: DataFrame, size: timedelta, salt_on: str, salts: int = 8) -> DataFrame:
    """Two-phase count: per (window, salt), then per window. The salt is a hash of a row id, so a
    retried task puts the same row under the same salt."""
    salt = F.pmod(F.xxhash64(salt_on), F.lit(salts))
    partial = (events.groupBy(window_end("ts", size).alias("window_end"), salt.alias("salt"))
               .agg(F.count(F.lit(1)).alias("partial")))
    return partial.groupBy("window_end").agg(F.sum("partial").alias("cnt"))


def pane_counts(events: DataFrame, keys: list[str], slide: timedelta) -> DataFrame:
    pane = bucket(epoch_micros("ts"), micros(slide))
    return events.groupBy(*keys, pane.alias("pane")).agg(F.count(F.lit(1)).alias("cnt"))


def panes_per_window(size: timedelta, slide: timedelta) -> int:
    if slide <= timedelta(0) or size % slide:
        raise ValueError("window size must be a multiple of the slide")
    return size // slide


def runs_of_panes(panes: DataFrame, keys: list[str], per_window: int) -> DataFrame:
    """(keys, block, first, until, cnt): windows ending at panes first .. until-1 hold cnt rows."""
    block = per_window * SIZES_PER_BLOCK
    width = F.lit(block).cast("long")
    enter, leave = F.col("pane") + 1, F.col("pane") + per_window + 1
    home, spill = bucket(enter, block), bucket(leave - 1, block)

    def change(in_block, at, delta):
        return F.struct(in_block.alias("block"), at.alias("at"), delta.alias("delta"))

    none = F.array().cast("array<struct<block:bigint,at:bigint,delta:bigint>>")
    cnt = F.col("cnt")
    changes = F.concat(
        F.array(change(home, enter, cnt)),
        F.when(spill > home, F.array(change(spill, spill * width, cnt))).otherwise(none),
        F.when(leave < (spill + 1) * width, F.array(change(spill, leave, -cnt))).otherwise(none),
    )
    moves = (panes.select(*keys, F.explode(changes).alias("c"))
             .select(*keys, "c.block", "c.at", "c.delta")
             .repartition(*keys, "block")
             .groupBy(*keys, "block", "at").agg(F.sum("delta").alias("delta"))
             .filter(F.col("delta") != 0))
    w = Window.partitionBy(*keys, "block").orderBy("at")
    running = F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    until = F.coalesce(F.lead("at").over(w), (F.col("block") + 1) * width)
    return (moves.select(*keys, "block", F.col("at").alias("first"), until.alias("until"),
                         running.alias("cnt"))
            .filter(F.col("cnt") > 0))


def hop_runs(events: DataFrame, keys: list[str], size: timedelta, slide: timedelta) -> DataFrame:
    """Sliding count as runs: every window ending from `first_window_end` to `last_window_end`
    (both included, one per slide) holds `cnt` rows of the key. Windows with no row are absent.

    Lossless, and its volume follows the number of rows, not size / slide. Runs are maximal.
    """
    step = micros(slide)
    runs = _uncut(key_runs(events, keys, size, slide), keys, panes_per_window(size, slide))
    return runs.select(*keys, instant(F.col("first"), step).alias("first_window_end"),
                       instant(F.col("until") - 1, step).alias("last_window_end"),
                       (F.col("until") - F.col("first")).alias("windows"), "cnt")


def _uncut(runs: DataFrame, keys: list[str], per_window: int) -> DataFrame:
    """Joins runs of one count that meet where a block ends. Only runs at an edge of their block are
    looked at together, two per key and block: their number follows the time span, not the rows."""
    width = F.lit(per_window * SIZES_PER_BLOCK).cast("long")
    edge = (F.col("first") == F.col("block") * width) | (F.col("until") == (F.col("block") + 1) * width)
    w = Window.partitionBy(*keys).orderBy("first")
    goes_on = F.coalesce((F.lag("until").over(w) == F.col("first")) & (F.lag("cnt").over(w) == F.col("cnt")),
                         F.lit(False))
    joined = (runs.filter(edge).withColumn("new", (~goes_on).cast("int"))
              .withColumn("island", F.sum("new").over(w))
              .groupBy(*keys, "island", "cnt").agg(F.min("first").alias("first"), F.max("until").alias("until")))
    names = [*keys, "first", "until", "cnt"]
    return runs.filter(~edge).select(*names).unionByName(joined.select(*names))


def key_runs(events: DataFrame, keys: list[str], size: timedelta, slide: timedelta) -> DataFrame:
    """The runs in pane numbers: windows ending at panes first .. until-1 hold cnt rows."""
    return runs_of_panes(pane_counts(events, keys, slide), keys, panes_per_window(size, slide))


def hop_counts(events: DataFrame, keys: list[str], size: timedelta, slide: timedelta) -> DataFrame:
    """Sliding count, one row per key and window. Runs are unrolled after the last shuffle."""
    runs = key_runs(events, keys, size, slide)
    ends = F.explode(F.sequence(F.col("first"), F.col("until") - 1))
    return (runs.select(*keys, "cnt", ends.alias("end"))
            .select(*keys, instant(F.col("end"), micros(slide)).alias("window_end"), "cnt"))
