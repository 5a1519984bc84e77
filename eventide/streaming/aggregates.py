"""Streaming counts, unique visitors and top-N."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.eventtime import bucket, epoch_micros, micros
from eventide.functions.hashing import BITMAP_CAPACITY, bitmap_offset
from eventide.operators.topn import DEFAULT_N, ITEM_REPORT, contenders, report, top_n
from eventide.operators.uniques import SKETCH_LOG
from eventide.operators.windows import panes_per_window, runs_of_panes
from eventide.streaming import runner
from eventide.streaming.versions import Versions


def pv(page_views: DataFrame, size: str = "1 hour", delay: str = "0 seconds") -> DataFrame:
    return (page_views.withWatermark("ts", delay)
            .groupBy(F.window("ts", size).alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.col("w.end").alias("window_end"), "cnt"))


def uv(page_views: DataFrame, size: str = "1 hour", delay: str = "0 seconds") -> DataFrame:
    """Exact: one state row per (window, user), closed into one count per window."""
    users = (page_views.filter(F.col("user_id").isNotNull()).withWatermark("ts", delay)
             .groupBy(F.window("ts", size).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("visits")))
    return (users.groupBy(F.window(F.window_time("w"), size).alias("w2"))
            .agg(F.count(F.lit(1)).alias("uv"))
            .select(F.col("w2.end").alias("window_end"), "uv"))


def pv_salted(page_views: DataFrame, salt_on: str = "event_id", salts: int = 8, size: str = "1 hour",
              delay: str = "0 seconds") -> DataFrame:
    """Two stateful steps: a count per (window, salt), and when these close their sum. No window has its rows counted in
    one state store; the salt is a hash of a row id, so a repeated micro-batch puts rows under the same salts."""
    salt = F.pmod(F.xxhash64(salt_on), F.lit(salts))
    partial = (page_views.withWatermark("ts", delay).groupBy(F.window("ts", size).alias("w"), salt.alias("salt"))
               .agg(F.count(F.lit(1)).alias("partial")))
    return (partial.groupBy(F.window(F.window_time("w"), size).alias("w2")).agg(F.sum("partial").alias("cnt"))
            .select(F.col("w2.end").alias("window_end"), "cnt"))


def uv_bitmap(page_views: DataFrame, size: str = "1 hour", delay: str = "0 seconds",
              capacity: int = BITMAP_CAPACITY) -> DataFrame:
    """Distinct bit positions of a one-hash bitmap. State holds the bitmap's pieces in use, each of a fixed number of bits,
    so it is bounded by the capacity however many users come."""
    at = page_views.withWatermark("ts", delay).select(
        F.window("ts", size).alias("w"), bitmap_offset(F.col("user_id"), capacity).alias("pos"))
    pieces = (at.groupBy("w", F.bitmap_bucket_number("pos").alias("piece"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("pos")).alias("bits")))
    return (pieces.groupBy(F.window(F.window_time("w"), size).alias("w2")).agg(F.sum(F.bitmap_count("bits")).alias("uv"))
            .select(F.col("w2.end").alias("window_end"), "uv"))


def uv_sliding_approx(page_views: DataFrame, pane: str, size: str, slide: str, delay: str = "0 seconds",
                      log_buckets: int = SKETCH_LOG) -> DataFrame:
    """Estimated distinct users of sliding windows: one sketch per pane as state, and closed panes' sketches merged into
    the windows over them. State does not grow with the users."""
    sketches = (page_views.withWatermark("ts", delay).groupBy(F.window("ts", pane).alias("pane"))
                .agg(F.hll_sketch_agg("user_id", F.lit(log_buckets)).alias("sketch")))
    return (sketches.groupBy(F.window(F.window_time("pane"), size, slide).alias("w"))
            .agg(F.hll_union_agg("sketch").alias("sketch"))
            .select(F.col("w.end").alias("window_end"), F.hll_sketch_estimate("sketch").alias("uv")))


def hop_counts(events: DataFrame, key: str, size: str, slide: str, delay: str = "0 seconds") -> DataFrame:
    """Sliding count in two stateful steps: rows are counted per pane, and only closed panes, not
    rows, are copied into the windows that cover them."""
    panes = (events.withWatermark("ts", delay)
             .groupBy(F.window("ts", slide).alias("pane"), key).agg(F.count(F.lit(1)).alias("n")))
    return (panes.groupBy(F.window(F.window_time("pane"), size, slide).alias("w"), key)
            .agg(F.sum("n").alias("cnt"))
            .select(F.col("w.end").alias("window_end"), key, "cnt"))


def rank_closed(n: int = DEFAULT_N, key: str = "item_id"):
    """Batch step that ranks closed counts: all counts of a window close in one micro-batch, so each
    batch holds whole windows."""
    return lambda batch: top_n(batch, key, n)


def report_closed(n: int = DEFAULT_N, key: str = "item_id", style: dict = ITEM_REPORT):
    """Batch step that writes the text of every closed window."""
    return lambda batch: report(top_n(batch, key, n), key, style)


def uv_running(page_views: DataFrame, size: str = "1 hour", delay: str = "0 seconds") -> DataFrame:
    """Unique visitors so far of every window that a micro-batch adds visitors to, for update mode.

    State holds one row per (window, user) at its first sight, spread by both, and one count per window. Repeats of a
    user end at the first.
    """
    firsts = (page_views.filter(F.col("user_id").isNotNull()).withWatermark("ts", delay)
              .select(F.window("ts", size).alias("w"), "user_id").dropDuplicates(["w", "user_id"]))
    return (firsts.groupBy("w").agg(F.count(F.lit(1)).alias("uv"))
            .select(F.col("w.end").alias("window_end"), "uv"))


def newest(updates: DataFrame, key: str = "window_end") -> DataFrame:
    """The last row of every key among the updates of all micro-batches."""
    value = F.struct("batch_id", *[c for c in updates.columns if c not in (key, "batch_id")])
    return updates.groupBy(key).agg(F.max(value).alias("v")).select(key, "v.*").drop("batch_id")


# Panes and top lists are kept in stretches of this many window lengths: four hours for ten-minute windows. A batch writes
# the stretches it touches anew.
STRETCH_WINDOWS = 24


class LateTopN:
    """Top-N of sliding windows, refined as rows arrive, with the changes every micro-batch made to it.

    State holds pane counts only. Of every micro-batch, the windows that its panes touch are counted again from the panes
    as they are now. What their top-N was before is compared with what it is now: rows that left or changed are
    retracted, rows that took their place are added. Panes that no window in reach of the watermark needs are removed.
    """

    def __init__(self, spark: SparkSession, home: str, key: str, key_type: str, size: timedelta, slide: timedelta,
                 n: int = DEFAULT_N, delay: str = "0 seconds"):
        self.spark, self.home, self.key, self.slide, self.n, self.delay = spark, home, key, slide, n, delay
        self.per_window = panes_per_window(size, slide)
        self.width = self.per_window * STRETCH_WINDOWS
        self.panes = Versions(spark, f"{home}/panes", f"pane bigint, {key} {key_type}, cnt bigint")
        self.tops = Versions(spark, f"{home}/tops", f"window_end timestamp, rank int, {key} {key_type}, cnt bigint")
        self._changed = f"pane bigint, {key} {key_type}, cnt bigint"
        self._change = f"change string, window_end timestamp, rank int, {key} {key_type}, cnt bigint, batch_id bigint"

    def _stretch(self, pane: Column) -> Column:
        return bucket(pane, self.width)

    def pane_stream(self, events: DataFrame) -> DataFrame:
        pane = F.window("ts", f"{micros(self.slide)} microseconds")
        return (events.withWatermark("ts", self.delay).groupBy(pane.alias("w"), self.key)
                .agg(F.count(F.lit(1)).alias("cnt"))
                .select(bucket(epoch_micros("w.start"), micros(self.slide)).alias("pane"), self.key, "cnt"))

    def absorb(self, batch: DataFrame, batch_id: int) -> None:
        staged = f"{self.home}/changed/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(staged)
        changed = self.spark.read.schema(self._changed).parquet(staged)
        pane, reach = F.col("pane"), self.per_window
        low, high = changed.agg(F.min("pane"), F.max("pane")).first()
        if low is None:
            return
        # Only the stretches that the batch touches or its windows reach into are read, however far apart its times lie.
        both = changed.select(self._stretch(pane).alias("own"),
                              F.explode(F.sequence(self._stretch(pane - reach), self._stretch(pane + reach))).alias("near"))
        lists = both.agg(F.collect_set("own"), F.collect_set("near")).first()
        touched, near = set(lists[0]), set(lists[1])
        self._tidy(batch_id)

        fresh = changed.select("*", F.lit(batch_id).cast("long").alias("version"))
        kept = self.panes.before(batch_id, touched).select("pane", self.key, "cnt", "version")
        merged = kept.unionByName(fresh).groupBy("pane", self.key).agg(F.max_by("cnt", "version").alias("cnt"))
        self.panes.write(merged.withColumn("stretch", self._stretch(pane)), batch_id)

        # The windows that cover a changed pane end one to per_window panes after it.
        step = F.lit(micros(self.slide)).cast("long")
        windows = (changed.select("pane").distinct()
                   .select(F.explode(F.sequence(pane + 1, pane + reach)).alias("end")).distinct()
                   .select(F.timestamp_micros(F.col("end") * step).alias("window_end")))
        current = self.panes.before(batch_id + 1, near).filter(pane.between(low - reach, high + reach))
        runs = runs_of_panes(current.select(self.key, "pane", "cnt"), [self.key], reach)
        counts = contenders(runs, self.key, reach, self.slide, self.n)
        now = top_n(counts.join(windows, "window_end", "left_semi"), self.key, self.n)

        columns = ["window_end", "rank", self.key, "cnt"]
        was = self.tops.before(batch_id, near)
        rest = was.join(windows, "window_end", "left_anti").select(columns)
        stretch = self._stretch(bucket(epoch_micros("window_end"), micros(self.slide)))
        self.tops.write(now.select(columns).unionByName(rest).withColumn("stretch", stretch), batch_id)
        self._log(was.join(windows, "window_end", "left_semi").select(columns),
                  self.tops.before(batch_id + 1, near).join(windows, "window_end", "left_semi").select(columns), batch_id)

    def _log(self, was: DataFrame, now: DataFrame, batch_id: int) -> None:
        """A row that is the same before and after cancels out."""
        signed = now.withColumn("sign", F.lit(1)).unionByName(was.withColumn("sign", F.lit(-1)))
        (signed.groupBy("window_end", "rank", self.key, "cnt").agg(F.sum("sign").alias("sign")).filter("sign <> 0")
         .select(F.when(F.col("sign") > 0, "+").otherwise("-").alias("change"), "window_end", "rank", self.key, "cnt")
         .write.mode("overwrite").parquet(f"{self.home}/changes/batch_id={batch_id}"))

    def _tidy(self, batch_id: int) -> None:
        """Rows of the last two batches may lie as far back as the watermark was before them. A stretch written earlier
        than that tells how far the watermark had come at least."""
        earlier = [stretch for stretch, versions in self.panes.listing().items() if versions[0] < batch_id - 1]
        horizon = None
        if earlier:
            delay = self.spark.range(1).select(F.unix_micros(F.expr(f"timestamp_micros(0) + INTERVAL {self.delay}"))).first()[0]
            late = -(-delay // micros(self.slide))
            horizon = (max(earlier) * self.width - late - self.per_window) // self.width
        self.panes.tidy(batch_id, horizon)
        self.tops.tidy(batch_id)

    def latest(self) -> DataFrame:
        """The newest top-N of every window."""
        return self.tops.before(None).drop("stretch", "version")

    def changes(self) -> DataFrame:
        """What each micro-batch retracted ('-') and added ('+'), by batch_id."""
        return self.spark.read.schema(self._change).parquet(f"{self.home}/changes")


def replayed(changes: DataFrame) -> DataFrame:
    """What is left after all retractions."""
    keys = [c for c in changes.columns if c not in ("change", "batch_id")]
    sign = F.when(F.col("change") == "+", 1).otherwise(-1)
    return changes.groupBy(*keys).agg(F.sum(sign).alias("left")).filter("left > 0").drop("left")


def refined_top_n(spark: SparkSession, events: DataFrame, home: str, key: str, size: timedelta, slide: timedelta,
                  n: int = DEFAULT_N, delay: str = "0 seconds") -> LateTopN:
    """Runs the refining top-N over all input."""
    late = LateTopN(spark, home, key, dict(events.dtypes)[key], size, slide, n, delay)
    runner.run(late.pane_stream(events), late.absorb, f"{home}/checkpoint", mode="update")
    return late


def hot_urls(spark: SparkSession, gets: DataFrame, home: str, size: timedelta = timedelta(minutes=10),
             slide: timedelta = timedelta(seconds=5), n: int = DEFAULT_N, delay: str = "62 seconds") -> LateTopN:
    """Hot URLs; the delay is 2 s out-of-orderness plus 60 s lateness."""
    return refined_top_n(spark, gets, home, "url", size, slide, n, delay)
