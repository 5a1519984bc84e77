"""Order payment: matches, timeouts and the full order status.

Both rules need the rows next to a row only, so they run per (order, time block).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.blocks import Blocked, in_blocks, nearest_outside, with_neighbours
from eventide.functions.eventtime import epoch_micros, micros

PAY_WITHIN = timedelta(minutes=15)
CREATE, PAY = "create", "pay"
PAID, NO_PAY, LATE = "paid", "no_pay", "late_or_orphan"


def creates_and_pays(orders: DataFrame) -> DataFrame:
    """The events the rules are about; any other type in between changes nothing."""
    return orders.filter(F.col("event_type").isin(CREATE, PAY))


def _blocked(orders: DataFrame) -> Blocked:
    """Rows by (order, block). The id is wrapped, as a null in a struct equals another: a missing id is an order too."""
    rows = creates_and_pays(orders).select(F.struct("order_id").alias("order_id"), "event_id", "event_type", "ts")
    return in_blocks(rows, "order_id", "ts")


def _creates(orders: DataFrame, within: timedelta) -> DataFrame:
    """Every create with the first later pay less than `within` after it, else a null pay_ts."""
    rows = _blocked(orders)
    # Latest first, so that "the next pay" is a running value and each row is visited once.
    back = (Window.partitionBy("order_id", "block").orderBy(F.col("ts").desc(), F.col("event_id").desc())
            .rowsBetween(Window.unboundedPreceding, -1))
    pay_ts = F.when(F.col("event_type") == "pay", F.col("ts"))
    next_pay = F.coalesce(F.last(pay_ts, ignorenulls=True).over(back), "after_pay")
    seen = (nearest_outside(rows, "order_id", {"pay": pay_ts})
            .select("order_id.order_id", "event_id", "event_type", "ts", next_pay.alias("next_pay")))
    in_time = epoch_micros("next_pay") - epoch_micros("ts") < micros(within)
    return (seen.filter(F.col("event_type") == "create")
            .select("order_id", F.col("event_id").alias("create_id"), F.col("ts").alias("create_ts"),
                    F.when(in_time, F.col("next_pay")).alias("pay_ts")))


def pay_matches(orders: DataFrame, within: timedelta = PAY_WITHIN) -> DataFrame:
    return _creates(orders, within).filter(F.col("pay_ts").isNotNull())


def pay_timeouts(orders: DataFrame, within: timedelta = PAY_WITHIN) -> DataFrame:
    return _creates(orders, within).filter(F.col("pay_ts").isNull()).drop("pay_ts")


def order_status(orders: DataFrame, within: timedelta = PAY_WITHIN) -> DataFrame:
    """paid / no_pay / late_or_orphan for every create and pay.

    A pay is good exactly when the order's event right before it is a create at most `within` old:
    another create would have replaced that create, and another pay would have used it up. A create
    is unpaid exactly when the event right after it is not such a pay. So the status needs only the
    two neighbours of a row, not a fold over the order's history.
    """
    t = epoch_micros("ts")
    names = ["event_type", "ts", "event_id"]
    seen = with_neighbours(_blocked(orders), "order_id", ["ts", "event_id"],
                           lambda w: {f"prev_{c}": F.lag(c).over(w) for c in names},
                           lambda w: {f"next_{c}": F.lead(c).over(w) for c in names[:2]})
    limit = micros(within)
    paid = F.coalesce((F.col("prev_event_type") == "create") & (t - epoch_micros("prev_ts") <= limit),
                      F.lit(False))
    gets_paid = F.coalesce((F.col("next_event_type") == "pay") & (epoch_micros("next_ts") - t <= limit),
                           F.lit(False))
    is_pay = F.col("event_type") == "pay"
    # A create that gets paid is told by its pay's row.
    return (seen.filter(is_pay | ~gets_paid)
            .select("order_id.order_id",
                    F.when(~is_pay, F.col("event_id")).when(paid, F.col("prev_event_id")).alias("create_id"),
                    F.when(~is_pay, F.col("ts")).when(paid, F.col("prev_ts")).alias("create_ts"),
                    F.when(is_pay, F.col("event_id")).alias("pay_id"),
                    F.when(is_pay, F.col("ts")).alias("pay_ts"),
                    F.when(~is_pay, NO_PAY).when(paid, PAID).otherwise(LATE).alias("status")))


def late_payments(orders: DataFrame, within: timedelta = PAY_WITHIN) -> DataFrame:
    return (order_status(orders, within).filter(F.col("status") == LATE)
            .select("order_id", "pay_id", "pay_ts"))
