"""The streaming twins as finite replays of the `events` file, one per batch query they must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import filters, uniques
from eventide.operators.orders import NO_PAY, PAID
from eventide.plans import catalog
from eventide.plans.catalog import (CAP, EARLY, FIVE_MINUTES, FIVE_SECONDS, HOUR, LATE, LOGIN_WITHIN, PAY_WITHIN, Query,
                                    RUN_LENGTH, RUN_WITHIN, plain)
from eventide.session import durable_dir
from eventide.sources import logs, tables
from eventide.streaming import aggregates, joins, keyed, runner


def _replay(spark, sf_dir, *event_types):
    return runner.Replay(runner.stream_session(spark), sf_dir, list(event_types))


def _without_flush(df, key, *times):
    """The rows of real events, whatever their times: what a flush row makes has the flush's key and time."""
    late = F.coalesce(F.coalesce(*times) >= F.lit(runner.FLUSH_AT), F.lit(False))
    return df.filter(~(late & F.col(key).eqNullSafe(F.lit(runner.FLUSH_KEY))))


def _page_views(ev):
    return filters.page_views(tables.behaviour(tables.views(ev)))


def pv(spark, sf_dir):
    replay = _replay(spark, sf_dir, "view")
    return runner.collect_appended(replay, aggregates.pv(_page_views(replay.events)), "pv")


def uv(spark, sf_dir):
    replay = _replay(spark, sf_dir, "view")
    return runner.collect_appended(replay, aggregates.uv(_page_views(replay.events)), "uv")


def pv_salted(spark, sf_dir):
    replay = _replay(spark, sf_dir, "view")
    return runner.collect_appended(replay, aggregates.pv_salted(_page_views(replay.events)), "pv-salted")


def uv_bitmap(spark, sf_dir):
    replay = _replay(spark, sf_dir, "view")
    return runner.collect_appended(replay, aggregates.uv_bitmap(_page_views(replay.events)), "uv-bitmap")


def uv_sliding_approx(spark, sf_dir):
    """Whether the stream's estimates are close to the exact numbers, which a batch counts."""
    replay = _replay(spark, sf_dir, "view")
    found = runner.collect_appended(replay, aggregates.uv_sliding_approx(
        _page_views(replay.events), "5 minutes", "1 hour", "5 minutes"), "uv-sliding")
    exact = _page_views(tables.events(replay.events.sparkSession, sf_dir))
    return uniques.sliding_close(found, exact, FIVE_MINUTES, HOUR, FIVE_MINUTES)


#: A replay in time order takes this many micro-batches.
PIECES = 4


def _in_order(spark, sf_dir):
    """The events in micro-batches that follow each other in time, on a stream's own session."""
    own = runner.stream_session(spark)
    return own, tables.instants(runner.events_stream(own, runner.in_time_order(own, sf_dir, PIECES), "*.parquet", 1))


def uv_running(spark, sf_dir):
    """The last count of each window; every micro-batch before told the count so far."""
    own, ev = _in_order(spark, sf_dir)
    home = durable_dir(own, "uv-running")
    runner.run(aggregates.uv_running(_page_views(ev)), runner.append_batches(f"{home}/out"), f"{home}/checkpoint", "update")
    return aggregates.newest(own.read.parquet(f"{home}/out"))


def topn_changelog(spark, sf_dir):
    """What the changes of all micro-batches come to."""
    own, ev = _in_order(spark, sf_dir)
    top = aggregates.refined_top_n(own, _page_views(ev), durable_dir(own, "changelog"), "item_id", HOUR, FIVE_MINUTES)
    return aggregates.replayed(top.changes())


def hot_items_topn(spark, sf_dir):
    replay = _replay(spark, sf_dir, "view")
    counts = aggregates.hop_counts(_page_views(replay.events), "item_id", "1 hour", "5 minutes")
    return runner.collect_appended(replay, counts, "hot-items", aggregates.rank_closed())


def topn_report(spark, sf_dir):
    replay = _replay(spark, sf_dir, "view")
    counts = aggregates.hop_counts(_page_views(replay.events), "item_id", "1 hour", "5 minutes")
    return runner.collect_appended(replay, counts, "report", aggregates.report_closed())


def hot_urls(spark, sf_dir):
    # Update mode reports open windows too, so nothing has to be flushed.
    own = runner.stream_session(spark)
    ev = tables.instants(runner.events_stream(own, sf_dir))
    gets = filters.get_requests(tables.access_log(tables.requests(ev)))
    return aggregates.hot_urls(own, gets, durable_dir(own, "hot-urls")).latest()


def ad_guard(spark, sf_dir):
    replay = _replay(spark, sf_dir, "click")
    guarded = runner.collect_appended(replay, keyed.capped_clicks(tables.ad_clicks(replay.events), CAP),
                                      "ad-guard")
    return _without_flush(guarded, "user_id", "ts").select("user_id", "ad_id", "day", "ts", "status")


def ad_clicks_by_province(spark, sf_dir):
    """The click cap, the province and the sliding count in one stream: three stateful steps, no batch step."""
    replay = _replay(spark, sf_dir, "click")
    own = replay.events.sparkSession
    kept = keyed.capped_clicks(tables.ad_clicks(replay.events), CAP).filter(F.col("status") == keyed.KEPT)
    by_province = tables.add_province(kept, tables.table(own, sf_dir, "customer"), tables.table(own, sf_dir, "nation"))
    return runner.collect_appended(replay, keyed.hop_runs(by_province, ["province"], HOUR, FIVE_SECONDS), "by-province")


def channel_behavior(spark, sf_dir):
    replay = _replay(spark, sf_dir, "view", "error", "click", "signup", "purchase")
    runs = keyed.hop_runs(tables.channel_behaviour(replay.events), ["channel", "behavior"], HOUR, FIVE_SECONDS, "0 seconds")
    return runner.collect_appended(replay, runs, "channels")


def login_fail(spark, sf_dir):
    replay = _replay(spark, sf_dir, "error", "view")
    alerts = keyed.fail_episodes(tables.logins(replay.events), LOGIN_WITHIN)
    return _without_flush(runner.collect_appended(replay, alerts, "login-fail"), "user_id", "last_ts")


def login_fail_pair(spark, sf_dir):
    replay = _replay(spark, sf_dir, "error", "view")
    pairs = keyed.fail_pairs(tables.logins(replay.events), LOGIN_WITHIN)
    return _without_flush(runner.collect_appended(replay, pairs, "login-pairs"), "user_id", "last_ts")


def login_fail_run(spark, sf_dir):
    replay = _replay(spark, sf_dir, "error", "view")
    runs = keyed.fail_runs(tables.logins(replay.events), RUN_LENGTH, RUN_WITHIN)
    return _without_flush(runner.collect_appended(replay, runs, "login-runs"), "user_id", "last_ts")


def login_fail_two_step(spark, sf_dir):
    replay = _replay(spark, sf_dir, "error", "view")
    runs = keyed.fail_runs(tables.logins(replay.events), 2, LOGIN_WITHIN)
    return _without_flush(runner.collect_appended(replay, runs, "login-two-step"), "user_id", "last_ts")


def _first_pays(spark, sf_dir, status):
    replay = _replay(spark, sf_dir, "signup", "purchase")
    found = runner.collect_appended(replay, keyed.first_pays(tables.orders(replay.events), PAY_WITHIN), "first-pays")
    return _without_flush(found.filter(F.col("status") == status), "order_id", "create_ts").drop("status")


def order_pay_match(spark, sf_dir):
    return _first_pays(spark, sf_dir, PAID)


def order_pay_timeout(spark, sf_dir):
    return _first_pays(spark, sf_dir, NO_PAY).drop("pay_ts")


def login_fail_from_log(spark, sf_dir):
    """Episodes from log lines: the lines are written as files, read as a stream of lines and parsed."""
    own = runner.stream_session(spark)
    folder = durable_dir(own, "login-lines")
    catalog.login_lines(own, sf_dir).write.text(folder)
    alerts = keyed.fail_episodes(logs.stream_log(own, "login", folder, with_id=True), LOGIN_WITHIN)
    last = f"-1,0.0.0.0,success,{int(runner.FLUSH_AT.timestamp())}"

    def end():
        own.createDataFrame([(last,)], "value string").coalesce(1).write.mode("append").text(folder)

    return _without_flush(runner.collect_ended(end, alerts, "login-fail-lines"), "user_id", "last_ts")


def order_status(spark, sf_dir):
    replay = _replay(spark, sf_dir, "signup", "purchase")
    status = keyed.order_status(tables.orders(replay.events), PAY_WITHIN)
    return (_without_flush(runner.collect_appended(replay, status, "order-status"), "order_id", "create_ts", "pay_ts")
            .select("order_id", "create_ts", "pay_ts", "status"))


def reconcile(spark, sf_dir):
    replay = _replay(spark, sf_dir, "purchase", "click")
    ev = replay.events
    joined = joins.reconcile(tables.payments(ev), tables.receipts(ev), EARLY, LATE)
    return (_without_flush(runner.collect_appended(replay, joined, "reconcile"), "tx_id", "pay_ts", "receipt_ts")
            .select("tx_id", "pay_ts", "receipt_ts", "status"))


def reconcile_one_to_one(spark, sf_dir):
    replay = _replay(spark, sf_dir, "purchase", "click")
    ev = replay.events
    settled = keyed.reconcile_one_to_one(tables.payments(ev), tables.receipts(ev), EARLY, LATE)
    return (_without_flush(runner.collect_appended(replay, settled, "one-to-one"), "tx_id", "pay_ts", "receipt_ts")
            .select("tx_id", "pay_ts", "receipt_ts", "status"))


STREAMS: dict[str, Query] = {
    "stream_pv": pv,
    "stream_pv_salted": pv_salted,
    "stream_uv": uv,
    "stream_uv_bitmap": uv_bitmap,
    "stream_uv_sliding_approx": uv_sliding_approx,
    "stream_uv_running": uv_running,
    "stream_hot_items_topn": hot_items_topn,
    "stream_topn_changelog": topn_changelog,
    "stream_topn_report": topn_report,
    "stream_hot_urls": hot_urls,
    "stream_ad_guard": ad_guard,
    "stream_ad_clicks_by_province": ad_clicks_by_province,
    "stream_channel_behavior": channel_behavior,
    "stream_login_fail": login_fail,
    "stream_login_fail_pair": login_fail_pair,
    "stream_login_fail_run": login_fail_run,
    "stream_login_fail_two_step": login_fail_two_step,
    "stream_order_pay_match": order_pay_match,
    "stream_order_pay_timeout": order_pay_timeout,
    "stream_login_fail_from_log": login_fail_from_log,
    "stream_order_status": order_status,
    "stream_reconcile": reconcile,
    "stream_reconcile_one_to_one": reconcile_one_to_one,
}


def stream_queries() -> dict[str, Query]:
    return {name: (lambda s, d, q=q: plain(q(s, d))) for name, q in STREAMS.items()}
