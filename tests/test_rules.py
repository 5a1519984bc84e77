"""Rules that hold in batch and stream alike: missing keys, other event types, ids of any value, session zones."""

import pytest
from conftest import frame
from pyspark.sql import functions as F

from eventide.operators import episodes, fraud, logins, orders, reconcile, topn, uniques
from eventide.sources import logs, tables
from eventide.streaming import aggregates, joins, keyed, runner

PAYS = [(1, None, 10.0), (2, 7, 20.0), (3, -1, 30.0), (4, 8, 40.0)]
RECEIPTS = [(11, None, 11.0), (12, 7, 21.0), (13, -1, 31.0)]
WANT = sorted([(None, 1, None, "pay_only"), (None, None, 11, "receipt_only"), (7, 2, 12, "matched"),
               (-1, 3, 13, "matched"), (8, 4, None, "pay_only")], key=str)


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def sides(spark):
    pays = frame(spark, PAYS, "pay_id long, tx_id long, s double").withColumnRenamed("ts", "pay_ts")
    receipts = frame(spark, RECEIPTS, "receipt_id long, tx_id long, s double").withColumnRenamed("ts", "receipt_ts")
    return pays, receipts


def test_reconcile_keeps_rows_without_id(spark):
    pays, receipts = sides(spark)
    got = rows(reconcile.reconcile(pays, receipts), "tx_id", "pay_id", "receipt_id", "status")
    assert got == WANT
    assert rows(reconcile.pay_without_receipt(pays, receipts), "pay_id") == [(1,), (4,)]
    assert rows(reconcile.receipt_without_pay(pays, receipts), "receipt_id") == [(11,)]


@pytest.fixture
def replay(spark, tmp_path):
    """A replay of rows (event_id, user_id, event_type, s) in the shape of the event files."""
    def make(data, kinds):
        raw = frame(spark, data, "event_id long, user_id long, event_type string, s double")
        raw = raw.select("event_id", raw.ts.cast("timestamp_ntz").alias("ts"), "user_id", "event_type",
                         F.lit(1.0).alias("value"), F.lit('{"k": 3}').alias("props"))
        folder = str(tmp_path / "events.parquet")
        raw.coalesce(1).write.parquet(folder)
        return runner.Replay(runner.stream_session(spark, 2), folder, kinds, pattern="*.parquet")
    return make


def past(df, *times):
    return df.filter(F.coalesce(*times) < F.lit(runner.FLUSH_AT))


@pytest.mark.parametrize("form", [joins.reconcile, keyed.reconcile_one_to_one])
def test_stream_reconcile_keeps_rows_without_id(spark, replay, form):
    data = [(i, tx, "purchase", s) for i, tx, s in PAYS] + [(i, tx, "click", s) for i, tx, s in RECEIPTS]
    play = replay(data, ["purchase", "click"])
    out = form(tables.payments(play.events), tables.receipts(play.events), delay="100 seconds")
    got = past(runner.collect_appended(play, out, "rule-reconcile"), "pay_ts", "receipt_ts")
    assert rows(got, "tx_id", "pay_id", "receipt_id", "status") == WANT


ORDERS = [(1, 5, "create", 0.0), (2, 5, "refund", 5.0), (3, 5, "pay", 9.0), (4, 6, "modify", 1.0), (5, 7, None, 1.0),
          (6, -1, "create", 2.0)]
STATUS = sorted([(5, 1, 3, "paid"), (-1, 6, None, "no_pay")], key=str)


def test_other_order_events_change_nothing(spark):
    df = frame(spark, ORDERS, "event_id long, order_id long, event_type string, s double")
    assert rows(orders.order_status(df), "order_id", "create_id", "pay_id", "status") == STATUS
    assert rows(orders.pay_matches(df), "order_id", "create_id") == [(5, 1)]
    assert rows(orders.pay_timeouts(df), "order_id") == [(-1,)]
    assert orders.late_payments(df).collect() == []


def test_other_order_events_change_nothing_in_a_stream(spark, replay):
    play = replay(ORDERS, ["create", "pay"])
    df = play.events.withColumnRenamed("user_id", "order_id")
    got = past(runner.collect_appended(play, keyed.order_status(df, delay="100 seconds"), "rule-orders"), "create_ts", "pay_ts")
    assert rows(got, "order_id", "create_id", "pay_id", "status") == STATUS


LOGINS = [(1, None, "fail", 0.0), (2, None, "fail", 1.0), (3, -1, "fail", 0.0), (4, -1, "fail", 1.0)]


def test_logins_without_user(spark, replay):
    df = frame(spark, LOGINS, "event_id long, user_id long, event_type string, s double")
    for found in (logins.fail_pairs(df), logins.fail_two_step(df), episodes.fail_episodes(df)):
        assert rows(found, "user_id") == [(-1,)]
    play = replay(LOGINS, ["fail"])
    out = keyed.fail_episodes(play.events, delay="100 seconds")
    assert rows(past(runner.collect_appended(play, out, "rule-logins"), "last_ts"), "user_id", "n") == [(-1, 2)]


def test_visitors_without_user(spark, replay):
    views = [(1, None, "pv", 0.0), (2, 3, "pv", 1.0), (3, None, "pv", 2.0), (4, 4, "pv", 3.0)]
    df = frame(spark, views, "event_id long, user_id long, behavior string, s double")
    for count in (uniques.uv, uniques.uv_bitmap, uniques.uv_approx):
        assert rows(count(df), "uv") == [(2,)]
    assert rows(uniques.uv_running(df), "event_id", "uv") == [(1, 0), (2, 1), (3, 1), (4, 2)]
    assert rows(uniques.uv_approx_check(df), "close") == [(True,)]
    play = replay(views, ["pv"])
    got = past(runner.collect_appended(play, aggregates.uv(play.events, delay="100 seconds"), "rule-uv"), "window_end")
    assert rows(got, "uv") == [(2,)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_session_zone_plays_no_part(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 15:59:59 and 16:00:00 UTC are two days at UTC+8
        clicks = frame(spark, [(1, 5, 9, 57599.0), (2, 5, 9, 57600.0)], "event_id long, user_id long, ad_id long, s double")
        kept = fraud.capped_clicks(clicks, 2)
        assert rows(kept.select("event_id", F.col("day").cast("string").alias("day")), "event_id", "day") == [
            (1, "2024-01-01"), (2, "2024-01-02")]
        ranked = clicks.select(F.col("ts").alias("window_end"), F.lit(1).alias("rank"), "ad_id", F.lit(2).alias("cnt"))
        assert all("2024-01-01 1" in r.report for r in topn.report(ranked, "ad_id").collect())
        line = spark.createDataFrame([("1.2.3.4 u - 10/03/2024:02:30:00 +0000 GET /x",)], "value string")
        assert logs.parse_access_log(line).select(F.unix_seconds("ts")).first()[0] == 1710037800
        raw = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS ts")
        assert tables.instants(raw).select(F.unix_seconds("ts")).first()[0] == 1710037800
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


