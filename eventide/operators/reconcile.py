"""Payments against receipts: interval join and three-way reconciliation."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.blocks import in_blocks, nearest_outside
from eventide.functions.eventtime import bucket, epoch_micros, micros

EARLY, LATE = timedelta(seconds=3), timedelta(seconds=5)
MATCHED, PAY_ONLY, RECEIPT_ONLY = "matched", "pay_only", "receipt_only"
PAY, RECEIPT = "pay", "receipt"


def interval_join(pays: DataFrame, receipts: DataFrame, early: timedelta = EARLY,
                  late: timedelta = LATE) -> DataFrame:
    """Pairs of a pay and a receipt of one transaction with
    pay_ts - early <= receipt_ts <= pay_ts + late.

    Joined on (tx_id, time slice), each pay going to every slice its interval touches (two at most).
    A transaction id with very many rows is so spread over its slices, and a pair is formed only
    where both rows lie in reach of each other.

    Both records come out whole: columns besides the id and time follow, those that both sides have as pay_<name> and
    receipt_<name>.
    """
    fixed = ["tx_id", "pay_id", "pay_ts", "receipt_id", "receipt_ts"]
    shared = set(pays.columns) & set(receipts.columns) - {"tx_id"}
    pays = pays.withColumnsRenamed({c: f"pay_{c}" for c in shared})
    receipts = receipts.withColumnsRenamed({c: f"receipt_{c}" for c in shared})
    payload = [c for side in (pays, receipts) for c in side.columns if c not in fixed]
    width = max(micros(early + late), 1)
    p, r = epoch_micros("pay_ts"), epoch_micros("receipt_ts")
    reach = F.sequence(bucket(p - micros(early), width), bucket(p + micros(late), width))
    left = pays.withColumn("_slice", F.explode(reach))
    right = receipts.withColumn("_slice", bucket(r, width))
    gap = r - p
    return (left.join(right, ["tx_id", "_slice"])
            .filter((gap >= -micros(early)) & (gap <= micros(late)))
            .select(*fixed, *payload))


def _both(pays: DataFrame, receipts: DataFrame) -> DataFrame:
    """The rows of both sides: (tx_id, side, id, ts, t)."""
    return (pays.select("tx_id", F.lit(PAY).alias("side"), F.col("pay_id").alias("id"), F.col("pay_ts").alias("ts"))
            .unionByName(receipts.select("tx_id", F.lit(RECEIPT).alias("side"), F.col("receipt_id").alias("id"),
                                         F.col("receipt_ts").alias("ts")))
            .withColumn("t", epoch_micros("ts")))


def _unmatched(pays: DataFrame, receipts: DataFrame, early: timedelta, late: timedelta) -> DataFrame:
    """Rows of either side with no partner in reach, in one pass over both sides.

    A row has a partner if the nearest row of the other side before it, or the nearest after it, lies
    in reach; no pair has to be formed to know that. A row without a transaction id has no partner.
    """
    both = _both(pays, receipts)
    nameless = both.filter(F.col("tx_id").isNull()).select("tx_id", "side", "id", "ts")
    is_pay = F.col("side") == PAY
    blocked = in_blocks(both.filter(F.col("tx_id").isNotNull()), "tx_id", "ts")
    part = Window.partitionBy("tx_id", "block")
    # Both frames take in all rows at the same instant.
    before = part.orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = part.orderBy(F.col("t").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    pay_t, receipt_t = F.when(is_pay, F.col("t")), F.when(~is_pay, F.col("t"))
    seen = nearest_outside(blocked, "tx_id", {"pay": pay_t, "receipt": receipt_t}).select(
        "tx_id", "side", "id", "ts", "t",
        F.coalesce(F.max(pay_t).over(before), "before_pay").alias("pay_before"),
        F.coalesce(F.max(receipt_t).over(before), "before_receipt").alias("receipt_before"),
        F.coalesce(F.min(pay_t).over(after), "after_pay").alias("pay_after"),
        F.coalesce(F.min(receipt_t).over(after), "after_receipt").alias("receipt_after"))
    t, e, l = F.col("t"), micros(early), micros(late)
    pay_has = (t - F.col("receipt_before") <= e) | (F.col("receipt_after") - t <= l)
    receipt_has = (t - F.col("pay_before") <= l) | (F.col("pay_after") - t <= e)
    has = F.when(is_pay, pay_has).otherwise(receipt_has)
    alone = seen.filter(~F.coalesce(has, F.lit(False)))
    return alone.select("tx_id", "side", "id", "ts").unionByName(nameless)


def pay_without_receipt(pays: DataFrame, receipts: DataFrame, early: timedelta = EARLY,
                        late: timedelta = LATE) -> DataFrame:
    return (_unmatched(pays, receipts, early, late).filter(F.col("side") == PAY)
            .select("tx_id", F.col("id").alias("pay_id"), F.col("ts").alias("pay_ts")))


def receipt_without_pay(pays: DataFrame, receipts: DataFrame, early: timedelta = EARLY,
                        late: timedelta = LATE) -> DataFrame:
    return (_unmatched(pays, receipts, early, late).filter(F.col("side") == RECEIPT)
            .select("tx_id", F.col("id").alias("receipt_id"), F.col("ts").alias("receipt_ts")))


def _one_sided(rows: DataFrame) -> DataFrame:
    """(tx_id, side, id, ts) as result rows without a partner."""
    def only(side: str, name: str) -> Column:
        return F.when(F.col("side") == side, F.col(name))

    return rows.select("tx_id", only(PAY, "id").alias("pay_id"), only(PAY, "ts").alias("pay_ts"),
                       only(RECEIPT, "id").alias("receipt_id"), only(RECEIPT, "ts").alias("receipt_ts"),
                       F.when(F.col("side") == PAY, PAY_ONLY).otherwise(RECEIPT_ONLY).alias("status"))


def reconcile(pays: DataFrame, receipts: DataFrame, early: timedelta = EARLY,
              late: timedelta = LATE) -> DataFrame:
    """matched pairs, pay_only and receipt_only in one result, told apart by `status`."""
    pairs = interval_join(pays, receipts, early, late).select(
        "tx_id", "pay_id", "pay_ts", "receipt_id", "receipt_ts", F.lit(MATCHED).alias("status"))
    return pairs.unionByName(_one_sided(_unmatched(pays, receipts, early, late)))


def reconcile_one_to_one(pays: DataFrame, receipts: DataFrame, early: timedelta = EARLY,
                         late: timedelta = LATE) -> DataFrame:
    """Reconciliation for transaction ids that repeat: every row is used once.

    Rows of an id are gone through in time. One row waits at a time: the next row matches it if it is of the other side
    and in reach, and takes its place otherwise. So a row can only match the row right before it. Call two such rows
    linked. In an unbroken chain of links the first row matches the second, the third the fourth, and so on: a row's
    number in its chain decides, and no history has to be followed. Where a chain comes from an earlier block, the
    number goes on from the rows since the last break, which a running sum over the blocks' summaries tells.

    A row without an id has no partner. Equal times go by row id, then pay before receipt.
    """
    both = _both(pays, receipts)
    nameless = both.filter(F.col("tx_id").isNull())
    rows = in_blocks(both.filter(F.col("tx_id").isNotNull()), "tx_id", "ts").rows
    w = Window.partitionBy("tx_id", "block").orderBy("t", "id", "side")
    row = F.struct("t", "id", "side", "ts")

    def links(first: str, second: str) -> Column:
        """`first` waits for `second`: a pay until `late` after it, a receipt until `early` after it."""
        wait = F.when(F.col(f"{first}.side") == PAY, micros(late)).otherwise(micros(early))
        near = F.col(f"{second}.t") - F.col(f"{first}.t") <= wait
        return F.coalesce((F.col(f"{first}.side") != F.col(f"{second}.side")) & near, F.lit(False))

    seen = rows.select("tx_id", "block", row.alias("own"), F.lag(row).over(w).alias("prev"), F.lead(row).over(w).alias("next"),
                       F.row_number().over(w).alias("nth"))
    upto = Window.partitionBy("tx_id", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = seen.withColumn("start", F.max(F.when(~links("prev", "own"), F.col("nth"))).over(upto))

    # The first and last row of each block, and what lies across its borders.
    line = Window.partitionBy("tx_id").orderBy("own.t", "own.id", "own.side")
    ends = (placed.filter(F.col("prev").isNull() | F.col("next").isNull())
            .withColumn("before", F.lag("own").over(line)).withColumn("after", F.lead("own").over(line)))
    is_first, is_last = F.col("prev").isNull(), F.col("next").isNull()
    blocks = ends.groupBy("tx_id", "block").agg(
        F.max(F.when(is_first, links("before", "own"))).alias("joined"), F.max(F.when(is_last, links("own", "after"))).alias("leads_on"),
        F.max_by(F.when(is_first, F.col("before")), F.when(is_first, 1)).alias("prev_row"),
        F.max(F.when(is_last, F.col("nth"))).alias("rows"), F.max(F.when(is_last, F.col("start"))).alias("last_start"))
    earlier = Window.partitionBy("tx_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    broken = F.when((F.col("last_start") > 1) | ~F.col("joined"), F.col("last_start"))
    blocks = blocks.withColumn("rows_before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    begun = F.last(F.col("rows_before") + broken, ignorenulls=True).over(earlier)
    blocks = blocks.select("tx_id", "block", "joined", "leads_on", "prev_row", (F.col("rows_before") - begun).alias("since_start"))
    goes_on = (F.col("start") == 1) & F.col("joined")
    number = F.when(goes_on, F.col("since_start") + F.col("nth")).otherwise(F.col("nth") - F.col("start"))
    # Numbers start from 0: an odd one matches the row before it, an even one the row after it if that is linked.
    numbered = placed.join(blocks, ["tx_id", "block"]).select(
        "tx_id", "own", F.coalesce("prev", "prev_row").alias("prev"), (number % 2 == 1).alias("odd"),
        F.when(F.col("next").isNull(), F.col("leads_on")).otherwise(links("own", "next")).alias("goes_on"))

    def of(side: str, name: str) -> Column:
        return F.when(F.col("own.side") == side, F.col(f"own.{name}")).otherwise(F.col(f"prev.{name}"))

    pairs = numbered.filter("odd").select("tx_id", of(PAY, "id").alias("pay_id"), of(PAY, "ts").alias("pay_ts"),
                                          of(RECEIPT, "id").alias("receipt_id"), of(RECEIPT, "ts").alias("receipt_ts"),
                                          F.lit(MATCHED).alias("status"))
    alone = numbered.filter("not odd and not goes_on").select("tx_id", "own.side", "own.id", "own.ts")
    return pairs.unionByName(_one_sided(alone.unionByName(nameless.select("tx_id", "side", "id", "ts"))))
