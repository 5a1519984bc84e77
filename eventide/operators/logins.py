"""Login-failure patterns that look back over a bounded time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.blocks import Blocked, in_blocks, with_neighbours
from eventide.functions.eventtime import epoch_micros, micros

FAIL = "fail"


def known_users(logins: DataFrame) -> DataFrame:
    """Log-ins without a user belong to nobody: no pattern is reported for them."""
    return logins.filter(F.col("user_id").isNotNull())


_ORDER = ["ts", "event_id"]


def _blocked(logins: DataFrame) -> Blocked:
    return in_blocks(known_users(logins).select("user_id", "event_id", "event_type", "ts"), "user_id", "ts")


def fail_pairs(logins: DataFrame, within: timedelta = timedelta(seconds=2)) -> DataFrame:
    """Two consecutive fails of a user at most `within` apart; a success in between breaks the pair."""
    seen = with_neighbours(_blocked(logins), "user_id", _ORDER, lambda w: {
        "prev_type": F.lag("event_type").over(w), "prev_ts": F.lag("ts").over(w)})
    gap = epoch_micros("ts") - epoch_micros("prev_ts")
    return (seen.filter((F.col("event_type") == FAIL) & (F.col("prev_type") == FAIL) & (gap <= micros(within)))
            .select("user_id", F.col("prev_ts").alias("first_ts"), F.col("ts").alias("last_ts")))


def fail_runs(logins: DataFrame, n: int = 5, within: timedelta = timedelta(seconds=5)) -> DataFrame:
    """`n` consecutive fails of a user whose first and last are less than `within` apart. Overlapping
    runs are all reported."""
    if n < 2:
        raise ValueError("a run has at least two fails")
    is_fail = (F.col("event_type") == FAIL).cast("long")
    seen = with_neighbours(_blocked(logins), "user_id", _ORDER, lambda w: {
        "first_ts": F.lag("ts", n - 1).over(w),
        "fails": F.sum(is_fail).over(w.rowsBetween(-(n - 1), Window.currentRow))}, reach=n - 1)
    span = epoch_micros("ts") - epoch_micros("first_ts")
    return (seen.filter((F.col("fails") == n) & (span < micros(within)))
            .select("user_id", "first_ts", F.col("ts").alias("last_ts"), F.col("fails").alias("n")))


def fail_two_step(logins: DataFrame, within: timedelta = timedelta(seconds=2)) -> DataFrame:
    return fail_runs(logins, 2, within)
