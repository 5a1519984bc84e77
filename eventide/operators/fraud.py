"""Daily ad-click cap and its blacklist."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.eventtime import local_day
from eventide.operators.windows import hop_runs

DEFAULT_CAP = 100
DAY_ZONE = "+08:00"
# Fixed text of a blacklist alert
BLACKLIST_MESSAGE = "blacklisted"

# Beyond this many rows a group Spark no longer trims groups in the map tasks.
_TRIM_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
_SALTS = 64


def _first_clicks(clicks: DataFrame, upto: int, zone: str) -> DataFrame:
    """The first `upto` clicks of each (user, ad, local day), numbered by (ts, event_id)."""
    day = clicks.withColumn("day", local_day("ts", zone))
    keys = ["user_id", "ad_id", "day"]
    if upto > int(clicks.sparkSession.conf.get(_TRIM_LIMIT_CONF, "1000")):
        # Too many for the map-side trim: trim a hot group in salted parts first. The first `upto`
        # rows of the group are among the first `upto` of each part.
        salt = F.pmod(F.xxhash64("event_id"), F.lit(_SALTS))
        parts = Window.partitionBy(*keys, "_salt").orderBy("ts", "event_id")
        day = (day.withColumn("_salt", salt).withColumn("_nth", F.row_number().over(parts))
               .filter(F.col("_nth") <= upto).drop("_salt", "_nth"))
    order = Window.partitionBy(*keys).orderBy("ts", "event_id")
    return (day.withColumn("nth", F.row_number().over(order))
            .filter(F.col("nth") <= upto))


def _check(cap: int) -> None:
    if cap < 2:
        raise ValueError("cap must be at least 2")


def capped_clicks(clicks: DataFrame, cap: int = DEFAULT_CAP, zone: str = DAY_ZONE) -> DataFrame:
    """Clicks that pass: numbers 1 to cap-1 of each user, ad and local day."""
    _check(cap)
    return _first_clicks(clicks, cap - 1, zone)


def blacklist(clicks: DataFrame, cap: int = DEFAULT_CAP, zone: str = DAY_ZONE) -> DataFrame:
    """One alert per user, ad and local day, at the click that reaches the cap."""
    _check(cap)
    return (_first_clicks(clicks, cap, zone).filter(F.col("nth") == cap)
            .select("user_id", "ad_id", "day", F.col("ts").alias("alert_ts"),
                    F.lit(BLACKLIST_MESSAGE).alias("warning")))


def clicks_by_province(clicks: DataFrame, cap: int, size: timedelta, slide: timedelta,
                       zone: str = DAY_ZONE) -> DataFrame:
    """Sliding count by province of the clicks that pass the cap, as runs of equal windows."""
    return hop_runs(capped_clicks(clicks, cap, zone), ["province"], size, slide)
