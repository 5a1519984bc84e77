"""Streaming payment / receipt reconciliation."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.eventtime import bucket, epoch_micros, micros
from eventide.operators.reconcile import EARLY, LATE, MATCHED, PAY_ONLY, RECEIPT_ONLY


def reconcile(pays: DataFrame, receipts: DataFrame, early: timedelta = EARLY, late: timedelta = LATE,
              delay: str = "0 seconds") -> DataFrame:
    """Stream-stream joins on (transaction, time slice), so that a busy transaction id is spread over its slices' state.

    A pay goes to every slice that its reach touches, two at most, and meets each receipt in the receipt's own slice: that
    gives the pairs, and the receipts without one. Receipts in turn go to the slices that a pay could lie in, and the
    pays without one are those that meet none in their own slice. The time bounds and the watermarks let Spark drop a row
    from state once no partner can come, and report it as unmatched then. Rows without a transaction id have no partner
    and are reported at once.
    """
    named = F.col("tx_id").isNotNull()
    p = pays.filter(named).select("tx_id", "pay_id", "pay_ts").withWatermark("pay_ts", delay)
    r = receipts.filter(named).select("tx_id", "receipt_id", "receipt_ts").withWatermark("receipt_ts", delay)
    e, l, width = micros(early), micros(late), max(micros(early + late), 1)
    pay_t, receipt_t = epoch_micros("pay_ts"), epoch_micros("receipt_ts")

    def spread(rows: DataFrame, low, high) -> DataFrame:
        return rows.withColumn("slice", F.explode(F.sequence(bucket(low, width), bucket(high, width))))

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        left, right = left.alias("p"), right.alias("r")
        same = ((F.col("p.tx_id") == F.col("r.tx_id")) & (F.col("p.slice") == F.col("r.slice"))
                & (F.col("r.receipt_ts") >= F.col("p.pay_ts") - F.lit(early))
                & (F.col("r.receipt_ts") <= F.col("p.pay_ts") + F.lit(late)))
        return left.join(right, same, how).select(
            F.coalesce("p.tx_id", "r.tx_id").alias("tx_id"), "pay_id", "pay_ts", "receipt_id", "receipt_ts")

    pairs = joined(spread(p, pay_t - e, pay_t + l), r.withColumn("slice", bucket(receipt_t, width)), "rightOuter")
    alone = joined(p.withColumn("slice", bucket(pay_t, width)), spread(r, receipt_t - l, receipt_t + e), "leftOuter")
    status = F.when(F.col("pay_id").isNull(), RECEIPT_ONLY).otherwise(MATCHED)
    return (pairs.withColumn("status", status)
            .unionByName(alone.filter(F.col("receipt_id").isNull()).withColumn("status", F.lit(PAY_ONLY)))
            .unionByName(nameless(pays, receipts)))


def nameless(pays: DataFrame, receipts: DataFrame) -> DataFrame:
    """Rows without a transaction id, as unmatched."""
    none = {name: F.lit(None).cast(kind) for side in (pays, receipts) for name, kind in side.dtypes}
    p = pays.filter(F.col("tx_id").isNull()).select(
        "tx_id", "pay_id", "pay_ts", none["receipt_id"].alias("receipt_id"),
        none["receipt_ts"].alias("receipt_ts"), F.lit(PAY_ONLY).alias("status"))
    r = receipts.filter(F.col("tx_id").isNull()).select(
        "tx_id", none["pay_id"].alias("pay_id"), none["pay_ts"].alias("pay_ts"), "receipt_id", "receipt_ts",
        F.lit(RECEIPT_ONLY).alias("status"))
    return p.unionByName(r)
