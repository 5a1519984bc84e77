"""The named queries, over the tables in one folder.

Operators keep the reference periods as their defaults; the synthetic `events` table is sparser than
a live log, so the pattern queries pass wider bounds.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta as td

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.eventtime import utc_clock
from eventide.operators import (episodes, filters, fraud, logins, orders, reconcile, topn, uniques,
                                windows)
from eventide.sources import logs, tables

Query = Callable[[SparkSession, str], DataFrame]

HOUR, FIVE_MINUTES, FIVE_SECONDS = td(hours=1), td(minutes=5), td(seconds=5)
LOGIN_WITHIN, RUN_WITHIN, RUN_LENGTH = td(hours=12), td(days=1), 3
PAY_WITHIN = td(hours=12)
EARLY, LATE = td(hours=3), td(hours=5)
CAP = 2


def plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC timestamps, the type the source tables use, and days as text."""
    shown = {"timestamp": utc_clock, "date": lambda name: F.col(name).cast("string")}
    return df.select(*[shown[kind](name).alias(name) if kind in shown else F.col(name)
                       for name, kind in df.dtypes])


# -- inputs -------------------------------------------------------------------------------------

def _behaviour(spark, d):
    return tables.behaviour(tables.events(spark, d))


def _page_views(spark, d):
    return filters.page_views(tables.behaviour(tables.views(tables.events(spark, d))))


def _gets(spark, d):
    return filters.get_requests(tables.access_log(tables.requests(tables.events(spark, d))))


def _logins(spark, d):
    return tables.logins(tables.events(spark, d))


def _orders(spark, d):
    return tables.orders(tables.events(spark, d))


def _pay_receipt(spark, d):
    ev = tables.events(spark, d)
    return tables.payments(ev), tables.receipts(ev)


def _clicks(spark, d):
    return tables.ad_clicks(tables.events(spark, d))


def _with_province(spark, d, clicks):
    return tables.add_province(clicks, tables.table(spark, d, "customer"), tables.table(spark, d, "nation"))


# -- log scans: events written as text lines, then parsed back ------------------------------------

def _lines(df: DataFrame, sep: str, *cols) -> DataFrame:
    return df.select(F.concat_ws(sep, *[c.cast("string") for c in cols]).alias("value"))


def _seconds():
    return F.unix_seconds("ts")


def _behavior_lines(spark, d):
    b = _behaviour(spark, d)
    return _lines(b, ",", F.col("user_id"), F.col("item_id"), F.col("category_id"), F.col("behavior"),
                  _seconds())


def login_lines(spark, d):
    return _lines(_logins(spark, d), ",", F.col("user_id"),
                  F.concat(F.lit("10.0.0."), F.col("user_id") % 256), F.col("event_type"), _seconds())


def _order_lines(spark, d):
    tx = F.when(F.col("event_type") == "pay", F.concat(F.lit("tx"), F.col("event_id"))).otherwise("")
    return _lines(_orders(spark, d), ",", F.col("order_id"), F.col("event_type"), tx, _seconds())


def _receipt_lines(spark, d):
    r = tables.receipts(tables.events(spark, d)).withColumnRenamed("receipt_ts", "ts")
    channel = F.when(F.col("receipt_id") % 2 == 0, "wechat").otherwise("alipay")
    return _lines(r, ",", F.concat(F.lit("tx"), F.col("tx_id")), channel, _seconds())


def _ad_lines(spark, d):
    c = _with_province(spark, d, _clicks(spark, d))
    city = F.concat(F.lit("city-"), F.col("user_id") % 10)
    return _lines(c, ",", F.col("user_id"), F.col("ad_id"), F.col("province"), city, _seconds())


def _access_lines(spark, d):
    a = tables.access_log(tables.events(spark, d))
    return _lines(a, " ", F.col("ip"), F.col("user_id"), F.lit("-"),
                  F.date_format(utc_clock("ts"), "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), F.col("method"),
                  F.col("url"))


def _market_lines(spark, d):
    m = tables.channel_behaviour(tables.events(spark, d))
    return _lines(m, ",", F.col("user_id"), F.col("behavior"), F.col("channel"), F.unix_millis("ts"))


def _pay_lines(spark, d):
    """Pays under the transaction ids of the receipt lines."""
    o = _orders(spark, d)
    tx = F.when(F.col("event_type") == "pay", F.concat(F.lit("tx"), F.col("order_id"))).otherwise("")
    return _lines(o, ",", F.col("order_id"), F.col("event_type"), tx, _seconds())


def _logged_sides(spark, d):
    return (logs.payments(logs.parse_order_log(_pay_lines(spark, d), with_id=True)),
            logs.receipts(logs.parse_receipt_log(_receipt_lines(spark, d), with_id=True)))


# -- queries ------------------------------------------------------------------------------------

def _hot_item_counts(spark, d):
    return windows.hop_counts(_page_views(spark, d), ["item_id"], HOUR, FIVE_MINUTES)


def hot_items_topn(spark, d):
    return topn.top_n_hop(_page_views(spark, d), "item_id", HOUR, FIVE_MINUTES)


BATCH: dict[str, Query] = {
    "parse_behavior_log": lambda s, d: logs.parse_behavior_log(_behavior_lines(s, d)),
    "parse_login_log": lambda s, d: logs.parse_login_log(login_lines(s, d)),
    "parse_order_log": lambda s, d: logs.parse_order_log(_order_lines(s, d)),
    "parse_receipt_log": lambda s, d: logs.parse_receipt_log(_receipt_lines(s, d)),
    "parse_ad_log": lambda s, d: logs.parse_ad_log(_ad_lines(s, d)),
    "parse_access_log": lambda s, d: logs.parse_access_log(_access_lines(s, d)),
    "parse_market_log": lambda s, d: logs.parse_market_log(_market_lines(s, d)),
    # From log lines to results: the rows' ids come from the lines alone.
    "login_fail_pair_from_log": lambda s, d: logins.fail_pairs(
        logs.parse_login_log(login_lines(s, d), with_id=True), LOGIN_WITHIN),
    "order_status_from_log": lambda s, d: orders.order_status(
        logs.parse_order_log(_order_lines(s, d), with_id=True), PAY_WITHIN).select("order_id", "create_ts", "pay_ts", "status"),
    "reconcile_from_log": lambda s, d: reconcile.reconcile(*_logged_sides(s, d), EARLY, LATE)
        .select("tx_id", "pay_ts", "receipt_ts", "status"),
    "interval_join_from_log": lambda s, d: reconcile.interval_join(*_logged_sides(s, d), EARLY, LATE)
        .select("tx_id", "order_id", "pay_ts", "pay_channel", "receipt_ts"),
    "pv_filter": lambda s, d: _page_views(s, d),
    "get_requests": lambda s, d: _gets(s, d),
    "hot_items_hop_count": lambda s, d: _hot_item_counts(s, d),
    "hot_items_topn": hot_items_topn,
    "hot_items_sql": lambda s, d: topn.hot_items_sql(s, tables.behaviour(tables.views(tables.events(s, d)))),
    "topn_report": lambda s, d: topn.report(hot_items_topn(s, d), "item_id"),
    "topn_changelog": lambda s, d: topn.top_n_changelog(_page_views(s, d), "item_id", HOUR, FIVE_MINUTES),
    "hot_urls_hop_count": lambda s, d: windows.hop_runs(_gets(s, d), ["url"], td(minutes=10), FIVE_SECONDS),
    "hot_urls_topn": lambda s, d: topn.top_n_hop(_gets(s, d), "url", td(minutes=10), FIVE_SECONDS),
    "pv_hourly": lambda s, d: windows.tumbling_count(_page_views(s, d), HOUR),
    "pv_hourly_salted": lambda s, d: windows.salted_tumbling_count(_page_views(s, d), HOUR, "event_id"),
    "uv_hourly": lambda s, d: uniques.uv(_page_views(s, d)),
    "uv_hourly_bitmap": lambda s, d: uniques.uv_bitmap(_page_views(s, d)),
    "uv_hourly_approx": lambda s, d: uniques.uv_approx_check(_page_views(s, d)),
    "uv_sliding_approx": lambda s, d: uniques.uv_sliding_check(_page_views(s, d), FIVE_MINUTES, HOUR, FIVE_MINUTES),
    "uv_daily_approx": lambda s, d: uniques.uv_sliding_check(_page_views(s, d), FIVE_MINUTES, td(days=1), td(days=1)),
    "uv_running": lambda s, d: uniques.uv_running(_page_views(s, d)),
    "channel_behavior_hop_count": lambda s, d: windows.hop_runs(
        tables.channel_behaviour(tables.events(s, d)), ["channel", "behavior"], HOUR, FIVE_SECONDS),
    "ad_click_capped": lambda s, d: fraud.capped_clicks(_clicks(s, d), CAP),
    "ad_blacklist": lambda s, d: fraud.blacklist(_clicks(s, d), CAP),
    # Capped before the join: a user clicking without end adds only a few rows to it.
    "ad_clicks_by_province": lambda s, d: windows.hop_runs(
        _with_province(s, d, fraud.capped_clicks(_clicks(s, d), CAP)), ["province"], HOUR, FIVE_SECONDS),
    "login_fail_pair": lambda s, d: logins.fail_pairs(_logins(s, d), LOGIN_WITHIN),
    "login_fail_episode": lambda s, d: episodes.fail_episodes(_logins(s, d), LOGIN_WITHIN),
    "login_fail_run": lambda s, d: logins.fail_runs(_logins(s, d), RUN_LENGTH, RUN_WITHIN),
    "login_fail_two_step": lambda s, d: logins.fail_two_step(_logins(s, d), LOGIN_WITHIN),
    "order_pay_match": lambda s, d: orders.pay_matches(_orders(s, d), PAY_WITHIN),
    "order_pay_timeout": lambda s, d: orders.pay_timeouts(_orders(s, d), PAY_WITHIN),
    "order_status": lambda s, d: orders.order_status(_orders(s, d), PAY_WITHIN)
        .select("order_id", "create_ts", "pay_ts", "status"),
    "order_late_payment": lambda s, d: orders.late_payments(_orders(s, d), PAY_WITHIN),
    "pay_receipt_interval_join": lambda s, d: reconcile.interval_join(*_pay_receipt(s, d), EARLY, LATE),
    "pay_receipt_reconcile": lambda s, d: reconcile.reconcile(*_pay_receipt(s, d), EARLY, LATE)
        .select("tx_id", "pay_ts", "receipt_ts", "status"),
    "pay_receipt_one_to_one": lambda s, d: reconcile.reconcile_one_to_one(*_pay_receipt(s, d), EARLY, LATE)
        .select("tx_id", "pay_ts", "receipt_ts", "status"),
    "pay_without_receipt": lambda s, d: reconcile.pay_without_receipt(*_pay_receipt(s, d), EARLY, LATE),
    "receipt_without_pay": lambda s, d: reconcile.receipt_without_pay(*_pay_receipt(s, d), EARLY, LATE),
}


def batch_queries() -> dict[str, Query]:
    return {name: (lambda s, d, q=q: plain(q(s, d))) for name, q in BATCH.items()}
