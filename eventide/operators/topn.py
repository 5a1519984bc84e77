"""Top-N per window, its text report, its SQL form and its changelog."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import timedelta
from itertools import islice, zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from eventide.functions.eventtime import bucket, instant, micros, utc_clock
from eventide.operators.windows import (SIZES_PER_BLOCK, hop_counts, key_runs, pane_counts,
                                       panes_per_window)

DEFAULT_N = 5

# Beyond this many rows a group Spark no longer trims groups in the map tasks.
TRIM_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
PARTS = 64

# Segments in one window length; see contenders.
SEGMENTS_PER_WINDOW = 4

# With fewer windows over an event, unrolling them costs less than finding out which to leave out.
CONTENDERS_FROM = 48

# Fixed report formats: rule around the header, and the texts around the rank, the key and the count
ITEM_REPORT = {"rule": "=" * 13, "top": "Top", "key": " ItemId:", "count": " Count:"}
URL_REPORT = {"rule": "=" * 11, "top": "Top ", "key": " URL:", "count": " Count:"}


def top_n(counts: DataFrame, key: str, n: int = DEFAULT_N, window: str = "window_end") -> DataFrame:
    """The n largest counts of each window, ties by key ascending.

    The filter on row_number lets Spark keep n rows per window in every map task before the shuffle,
    so a window's whole count list never meets in one task. Beyond Spark's limit for that, a window is trimmed in parts
    first: its first n are among the first n of each part.
    """
    by = [F.col("cnt").desc(), F.col(key)]
    if n > int(counts.sparkSession.conf.get(TRIM_LIMIT_CONF, "1000")):
        part = F.pmod(F.xxhash64(key), F.lit(PARTS))
        nth = F.row_number().over(Window.partitionBy(window, "_part").orderBy(*by))
        counts = counts.withColumn("_part", part).withColumn("_nth", nth).filter(F.col("_nth") <= n).drop("_part", "_nth")
    order = Window.partitionBy(window).orderBy(*by)
    return (counts.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= n)
            .select(window, "rank", key, "cnt"))


def top_n_hop(events: DataFrame, key: str, size: timedelta, slide: timedelta,
              n: int = DEFAULT_N) -> DataFrame:
    """Top-N of every sliding window."""
    per_window = panes_per_window(size, slide)
    if per_window < CONTENDERS_FROM:
        return top_n(hop_counts(events, [key], size, slide), key, n)
    return top_n(contenders(key_runs(events, [key], size, slide), key, per_window, slide, n), key, n)


def contenders(runs: DataFrame, key: str, per_window: int, slide: timedelta, n: int) -> DataFrame:
    """Counts per key and window, without the keys that cannot be among a window's n largest.

    Runs are cut into segments of a few windows. If n keys hold at least `low` rows in every window of
    a segment, a key that never holds more than that there is behind all of them in each window, and is
    dropped before its windows are unrolled. Equal counts are settled by key, as in the ranking itself,
    so the result is exact.
    """
    length = max(1, per_window // SEGMENTS_PER_WINDOW)
    width = F.lit(length).cast("long")
    segments = F.sequence(bucket(F.col("first"), length), bucket(F.col("until") - 1, length))
    parts = runs.withColumn("segment", F.explode(segments)).select(
        key, "block", "segment", "cnt", F.greatest("first", F.col("segment") * width).alias("first"),
        F.least("until", (F.col("segment") + 1) * width).alias("until"))
    # Laid out by (key, block) already: no shuffle for these.
    mine = Window.partitionBy(key, "block", "segment")
    covered = F.sum(F.col("until") - F.col("first")).over(mine)
    parts = parts.select("*", F.max("cnt").over(mine).alias("high"),
                         F.when(covered == length, F.min("cnt").over(mine)).alias("low"))
    # The n-th best sure count of each segment: n rows per segment leave a task, one is kept.
    best = Window.partitionBy("segment").orderBy(F.col("low").desc(), F.col(key))
    bars = (parts.filter(F.col("low").isNotNull() & (F.col("first") == F.col("segment") * width))
            .withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n)
            .filter(F.col("place") == n)
            .select("segment", F.col("low").alias("bar"), F.col(key).alias("bar_key")))
    behind = (F.col("high") < F.col("bar")) | ((F.col("high") == F.col("bar")) & (F.col(key) > F.col("bar_key")))
    return (parts.join(bars, "segment", "left")
            .filter(~F.coalesce(behind, F.lit(False)))
            .select(key, "cnt", F.explode(F.sequence(F.col("first"), F.col("until") - 1)).alias("end"))
            .select(key, "cnt", instant(F.col("end"), micros(slide)).alias("window_end")))


def report(ranked: DataFrame, key: str, style: dict = ITEM_REPORT) -> DataFrame:
    """One text per window: a header with the window's end, then one line per rank."""
    line = F.concat(F.lit(style["top"]), F.col("rank"), F.lit(style["key"]), F.col(key),
                    F.lit(style["count"]), F.col("cnt"), F.lit("\n"))
    lines = F.array_sort(F.collect_list(F.struct(F.col("rank"), line.alias("line"))))
    header = F.concat(F.lit(style["rule"]), F.substring(utc_clock("window_end").cast("string"), 1, 19),
                      F.lit(".0"), F.lit(style["rule"]), F.lit("\n"))
    return (ranked.groupBy("window_end").agg(lines.alias("lines"))
            .select("window_end",
                    F.concat(header, F.array_join(F.transform("lines", lambda r: r["line"]), ""))
                    .alias("report")))


HOT_ITEMS_SQL = """
WITH agg AS (
  SELECT item_id, window.end AS window_end, count(item_id) AS cnt
  FROM {behaviour}
  WHERE behavior = 'pv'
  GROUP BY item_id, window(ts, '1 hour', '5 minutes')
), ranked AS (
  SELECT item_id, window_end, cnt,
         row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num
  FROM agg
)
SELECT window_end, row_num, item_id, cnt FROM ranked WHERE row_num <= 5
"""


def hot_items_sql(spark: SparkSession, behaviour: DataFrame) -> DataFrame:
    """Hot items written as SQL over the behaviour table."""
    return spark.sql(HOT_ITEMS_SQL, behaviour=behaviour)


def _first_of_steps(so_far: DataFrame, key: str, n: int) -> DataFrame:
    """Of the counts so far (key, end, pane, cnt), the n largest among those that grew at the same step of a window.

    Counts only grow within a window, so a key comes into its top-N, or moves up there, only at a step at which it grows
    itself. A key that n others beat at that step is behind them until it grows again. What is left are at most n rows a
    step at which anything grew, however many keys there are and however many steps nothing happens.
    """
    at = so_far.select(F.struct("end", "pane").alias("at"), key, "cnt")
    return top_n(at, key, n, "at").select("at.end", "at.pane", key, "cnt")


def _steps(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, list[tuple]]]:
    """(end, pane, [(key, cnt)]) of rows sorted by end and pane."""
    at, grown = None, []
    for batch in batches:
        for end, pane, key, cnt in zip(*(c.to_pylist() for c in batch.columns)):
            if at != (end, pane):
                if grown:
                    yield *at, grown
                at, grown = (end, pane), []
            grown.append((key, cnt))
    if grown:
        yield *at, grown


def _changes(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[tuple]:
    """(end, step, change, rank, key, cnt) wherever a step makes a place of a window's top-N differ; holds one top-N."""
    own, top = None, []
    for end, pane, grown in _steps(batches):
        if end != own:
            own, top = end, []
        keys = {k for k, _ in grown}
        now = sorted([*(row for row in top if row[0] not in keys), *grown],
                     key=lambda row: (-row[1], row[0] is not None, row[0]))[:n]
        for rank, (old, new) in enumerate(zip_longest(top, now), 1):
            if old != new:
                if old:
                    yield end, pane + 1, "-", rank, *old
                yield end, pane + 1, "+", rank, *new  # a top-N never gets shorter
        top = now


def top_n_changelog(events: DataFrame, key: str, size: timedelta, slide: timedelta,
                    n: int = DEFAULT_N) -> DataFrame:
    """How each window's top-N came about, as a retract stream.

    `as_of` steps through the panes of a window. At each step the rows that left the top-N or changed
    rank or count are retracted ('-') and the rows that took their place are added ('+').

    A window's rows are followed from change to change, in order, by one task that holds its present top-N: at most n
    rows for each step that brought anything, and none for the others.
    """
    per_window = panes_per_window(size, slide)
    block = per_window * SIZES_PER_BLOCK
    panes = pane_counts(events, [key], slide)
    # A pane is part of the windows ending per_window panes ahead, which lie in at most two blocks.
    first, last = bucket(F.col("pane") + 1, block), bucket(F.col("pane") + per_window, block)
    spread = (panes.withColumn("block", F.explode(F.sequence(first, last)))
              .repartition(key, "block"))
    low = F.greatest(F.col("pane") + 1, F.col("block") * block)
    high = F.least(F.col("pane") + per_window, (F.col("block") + 1) * block - 1)
    hits = spread.withColumn("end", F.explode(F.sequence(low, high)))
    upto = (Window.partitionBy(key, "block", "end").orderBy("pane")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    grown = _first_of_steps(hits.select(key, "end", "pane", F.sum("cnt").over(upto).alias("cnt")), key, n)
    kind = grown.schema[key].dataType

    def follow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, key_type = ["end", "step", "change", "rank", "key", "cnt"], to_arrow_type(kind)
        types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), key_type, pa.int64()]
        rows = _changes(batches, n)
        while part := list(islice(rows, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names=names)

    ordered = grown.repartition("end").sortWithinPartitions("end", "pane")
    step = micros(slide)
    return (ordered.mapInArrow(follow, f"end long, step long, change string, rank int, key {kind.simpleString()}, cnt long")
            .select(instant(F.col("end"), step).alias("window_end"), instant(F.col("step"), step).alias("as_of"),
                    "change", "rank", F.col("key").alias(key), "cnt"))
