"""Adapters from the `events` table to the streams the operators take.

Each adapter selects only the columns its operators read, so the parquet scan is pruned to them.
`event_id` is carried as the tie-breaker of equal timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.eventtime import from_utc_clock


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instants(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Zone-less timestamps become UTC instants, whatever the session's zone is."""
    return df.withColumn(ts, from_utc_clock(ts)) if dict(df.dtypes)[ts] == "timestamp_ntz" else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instants(table(spark, sf_dir, "events"))


def item_id() -> Column:
    return F.regexp_extract("props", "[0-9]+", 0).cast("bigint")


def views(ev: DataFrame) -> DataFrame:
    """The events that become page views. Filtering the raw column, not the derived one, lets the
    parquet scan skip row groups."""
    return ev.filter(F.col("event_type") == "view")


def requests(ev: DataFrame) -> DataFrame:
    """The events that become GET requests; an event without a type is none."""
    return ev.filter(F.col("event_type") != "error")


def behaviour(ev: DataFrame) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type"))
    item = item_id()
    return ev.select("event_id", "ts", "user_id", item.alias("item_id"),
                     (item % 10).cast("int").alias("category_id"), kind.alias("behavior"))


def access_log(ev: DataFrame) -> DataFrame:
    method = F.when(F.col("event_type") == "error", "POST").otherwise("GET")
    return ev.select("event_id", "ts", F.concat(F.lit("10.0.0."), F.col("user_id") % 256).alias("ip"),
                     F.col("user_id").cast("string").alias("user_id"), method.alias("method"),
                     F.concat(F.lit("/k/"), item_id()).alias("url"))


def logins(ev: DataFrame) -> DataFrame:
    outcome = F.when(F.col("event_type") == "error", "fail").otherwise("success")
    return ev.select("event_id", "ts", "user_id", outcome.alias("event_type"))


def orders(ev: DataFrame) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "create").otherwise("pay")
    return (ev.filter(F.col("event_type").isin("signup", "purchase"))
            .select("event_id", "ts", F.col("user_id").alias("order_id"), kind.alias("event_type")))


def payments(ev: DataFrame) -> DataFrame:
    return (ev.filter(F.col("event_type") == "purchase")
            .select(F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts"),
                    F.col("user_id").alias("tx_id")))


def receipts(ev: DataFrame) -> DataFrame:
    return (ev.filter(F.col("event_type") == "click")
            .select(F.col("event_id").alias("receipt_id"), F.col("ts").alias("receipt_ts"),
                    F.col("user_id").alias("tx_id")))


def ad_clicks(ev: DataFrame) -> DataFrame:
    return (ev.filter(F.col("event_type") == "click")
            .select("event_id", "ts", "user_id", (item_id() % 2).alias("ad_id")))


def add_province(clicks: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Province of the clicking user. No broadcast hint: the optimizer broadcasts a side only while
    its size is under the session's limit, and splits a hot user's partition otherwise."""
    home = (customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
            .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("province")))
    return clicks.join(home, "user_id")


def channel_behaviour(ev: DataFrame) -> DataFrame:
    channel = F.concat(F.lit("channel-"), item_id() % 4)
    return ev.select("event_id", "ts", "user_id", channel.alias("channel"),
                     F.col("event_type").alias("behavior"))
