"""Unique visitors: exact, bitmap, approximate, mergeable and running. A null user is no visitor."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.eventtime import bucket, epoch_micros, instant, micros, window_end
from eventide.functions.hashing import BITMAP_CAPACITY, bitmap_offset

HOUR = timedelta(hours=1)


def uv(behaviour: DataFrame, size: timedelta = HOUR) -> DataFrame:
    """Exact. Repeats of a user are dropped in the map tasks, so a busy user or hour stays small."""
    return (behaviour.groupBy(window_end("ts", size).alias("window_end"))
            .agg(F.count_distinct("user_id").alias("uv")))


def uv_bitmap(behaviour: DataFrame, size: timedelta = HOUR, capacity: int = BITMAP_CAPACITY) -> DataFrame:
    """Distinct bit positions of a one-hash bitmap; two users on one position count once.

    The bitmap is kept in pieces of a fixed number of bits, one row per (window, piece in use), so its
    memory is bounded by the capacity. Repeats of a position are dropped in the map tasks, so only
    positions in use are sent; nothing of the users' ids is.
    """
    at = behaviour.select(window_end("ts", size).alias("window_end"), bitmap_offset(F.col("user_id"), capacity).alias("pos")).distinct()
    pieces = (at.groupBy("window_end", F.bitmap_bucket_number("pos").alias("piece"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("pos")).alias("bits")))
    return pieces.groupBy("window_end").agg(F.sum(F.bitmap_count("bits")).alias("uv"))


def uv_approx(behaviour: DataFrame, size: timedelta = HOUR, rsd: float = 0.02) -> DataFrame:
    """HyperLogLog estimate with relative standard error `rsd`, in constant memory per window."""
    return (behaviour.groupBy(window_end("ts", size).alias("window_end"))
            .agg(F.approx_count_distinct("user_id", rsd).alias("uv")))


def uv_approx_check(behaviour: DataFrame, size: timedelta = HOUR, rsd: float = 0.02) -> DataFrame:
    """Per window, whether the estimate lies within three standard errors, or one visitor, of the exact
    number."""
    both = uv(behaviour, size).join(uv_approx(behaviour, size, rsd).withColumnRenamed("uv", "estimate"), "window_end")
    allowed = F.greatest(F.lit(1.0), 3 * rsd * F.col("uv"))
    return both.select("window_end", (F.abs(F.col("estimate") - F.col("uv")) <= allowed).alias("close"))


#: Size of a sketch: 2^12 buckets, a relative standard error of about 1.6 %.
SKETCH_LOG = 12


def uv_sketches(behaviour: DataFrame, pane: timedelta, log_buckets: int = SKETCH_LOG) -> DataFrame:
    """(pane, sketch): one sketch of the users of each pane. A log is read once for it; sketches can be stored, and any
    longer stretch of time is a merge of them."""
    return (behaviour.groupBy(bucket(epoch_micros("ts"), micros(pane)).alias("pane"))
            .agg(F.hll_sketch_agg("user_id", F.lit(log_buckets)).alias("sketch")))


def uv_sliding_approx(sketches: DataFrame, pane: timedelta, size: timedelta, slide: timedelta) -> DataFrame:
    """Estimated distinct users of every sliding window from its panes' sketches; a day is a window that slides by one.

    A user in many panes of a window counts once, as sketches of the same users merge into the same sketch.
    """
    if slide <= timedelta(0) or size % slide or slide % pane:
        raise ValueError("the size must be a multiple of the slide, and the slide of the pane")
    at = F.col("pane") * F.lit(micros(pane)).cast("long")
    first = bucket(at, micros(slide)) + 1
    ends = F.explode(F.sequence(first, first + (size // slide - 1)))
    return (sketches.select("sketch", ends.alias("end")).groupBy("end").agg(F.hll_union_agg("sketch").alias("sketch"))
            .select(instant(F.col("end"), micros(slide)).alias("window_end"), F.hll_sketch_estimate("sketch").alias("uv")))


def uv_sliding(behaviour: DataFrame, pane: timedelta, size: timedelta, slide: timedelta) -> DataFrame:
    """Exact distinct users of every sliding window; only a user's first row of a pane goes into the windows."""
    visits = behaviour.select(bucket(epoch_micros("ts"), micros(pane)).alias("pane"), "user_id").distinct()
    first = bucket(F.col("pane") * F.lit(micros(pane)).cast("long"), micros(slide)) + 1
    return (visits.select("user_id", F.explode(F.sequence(first, first + (size // slide - 1))).alias("end"))
            .groupBy(instant(F.col("end"), micros(slide)).alias("window_end")).agg(F.count_distinct("user_id").alias("uv")))


def uv_sliding_check(behaviour: DataFrame, pane: timedelta, size: timedelta, slide: timedelta,
                     log_buckets: int = SKETCH_LOG) -> DataFrame:
    """Per window, whether the estimate lies within three standard errors, or one visitor, of the exact number."""
    return sliding_close(uv_sliding_approx(uv_sketches(behaviour, pane, log_buckets), pane, size, slide), behaviour, pane, size,
                         slide, log_buckets)


def sliding_close(estimates: DataFrame, behaviour: DataFrame, pane: timedelta, size: timedelta, slide: timedelta,
                  log_buckets: int = SKETCH_LOG) -> DataFrame:
    """The same check of estimates (window_end, uv), wherever they come from."""
    estimate = estimates.withColumnRenamed("uv", "estimate")
    allowed = F.greatest(F.lit(1.0), 3 * 1.04 / 2 ** (log_buckets / 2) * F.col("uv"))
    return (uv_sliding(behaviour, pane, size, slide).join(estimate, "window_end", "left")
            .select("window_end", F.coalesce(F.abs(F.col("estimate") - F.col("uv")) <= allowed, F.lit(False)).alias("close")))


def uv_running(behaviour: DataFrame, size: timedelta = HOUR, slots: int = 720) -> DataFrame:
    """For every event, the distinct users of its window up to and including that event.

    A running count over a whole window would put the window into one task. The window is cut into
    `slots` slices instead: every slice starts from the number of users first seen in earlier slices
    and only counts on from there.
    """
    width = micros(size)
    if width % slots:
        raise ValueError("the window must divide into the slots")
    slice_width = width // slots
    rows = behaviour.select("event_id", "ts", "user_id", epoch_micros("ts").alias("t"))
    firsts = (rows.filter(F.col("user_id").isNotNull()).groupBy(bucket(F.col("t"), width).alias("win"), "user_id")
              .agg(F.min(F.struct("t", "event_id")).alias("f")))
    arrivals = firsts.select("win", bucket(F.col("f.t"), slice_width).alias("slot"),
                             F.col("f.t").alias("t"), F.col("f.event_id").alias("event_id"))

    # Users seen before each slice: at most `slots` rows per window.
    per_slot = arrivals.groupBy("win", "slot").agg(F.count(F.lit(1)).alias("new"))
    all_slots = (per_slot.select("win").distinct()
                 .withColumn("slot", F.explode(F.sequence(F.col("win") * slots,
                                                          F.col("win") * slots + (slots - 1)))))
    earlier = (Window.partitionBy("win").orderBy("slot")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = (all_slots.withColumn("new", F.lit(0).cast("long"))
               .unionByName(per_slot)
               .groupBy("win", "slot").agg(F.sum("new").alias("new"))
               .withColumn("seen", F.coalesce(F.sum("new").over(earlier), F.lit(0)).cast("long")))

    def part(df, kind, step, t, event_id):
        return df.select("slot", F.lit(kind).alias("kind"), step.cast("long").alias("step"),
                         t.cast("long").alias("t"), event_id.cast("long").alias("event_id"))

    # kind orders rows at the same instant: the carry opens the slice, then a first sight counts
    # before the event that made it.
    low = F.lit(None).cast("long")
    line = (
        part(carried.filter(F.col("seen") > 0), 0, F.col("seen"), low, low)
        .unionByName(part(arrivals, 1, F.lit(1), F.col("t"), F.col("event_id")))
        .unionByName(part(rows.withColumn("slot", bucket(F.col("t"), slice_width)), 2, F.lit(0),
                          F.col("t"), F.col("event_id")))
    )
    upto = (Window.partitionBy("slot").orderBy(F.col("t").asc_nulls_first(), "event_id", "kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (line.withColumn("uv", F.sum("step").over(upto))
            .filter(F.col("kind") == 2)
            .select("event_id", instant(bucket(F.col("t"), width) + 1, width).alias("window_end"), "uv"))
