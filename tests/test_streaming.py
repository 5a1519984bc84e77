"""Each streaming twin must end with the rows of its batch query, however its input is cut."""

import random
from datetime import timedelta as td

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import frame, random_events, secs
from eventide.operators import episodes, filters, fraud, logins, orders, reconcile, topn, uniques, windows
from eventide.sources import logs, tables
from eventide.streaming import aggregates, joins, keyed, runner

KINDS = ["view", "error", "click", "signup", "purchase"]
SPAN = 6 * 3600


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Events in four files, each out of order inside, and all of them as a batch table."""
    folder = str(tmp_path_factory.mktemp("events"))
    rows = random_events(11, 1200, 12, SPAN, KINDS, step=3.0)
    df = (frame(spark, rows, "event_id bigint, user_id bigint, event_type string, s double")
          .withColumn("props", F.format_string('{"k": %d}', F.col("event_id") % 7)))
    cut = [0, SPAN / 4, SPAN / 2, 3 * SPAN / 4, SPAN]
    t = F.unix_micros("ts") / 1_000_000 - 1704067200
    for i in range(4):
        (df.filter((t >= cut[i]) & (t < cut[i + 1])).orderBy(F.xxhash64("event_id"))
         .coalesce(1).write.mode("append").parquet(folder))
    return folder, spark.read.parquet(folder)


def replay(spark, folder, *kinds):
    return runner.Replay(runner.stream_session(spark), folder, list(kinds), pattern="*.parquet", files_per_trigger=1)


def rows(df, *names):
    return sorted((tuple(r) for r in (df.select(*names) if names else df).collect()), key=str)


def page_views(ev):
    return filters.page_views(tables.behaviour(ev))


def real(df, *_):
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.filter(F.coalesce(*times) < F.lit(runner.FLUSH_AT))


# Files are listed in any order, so the replay allows rows as late as the whole span.
LATE = f"{SPAN} seconds"


def test_counts_and_unique_visitors(spark, source):
    folder, ev = source
    play = replay(spark, folder, "view")
    got = runner.collect_appended(play, aggregates.pv(page_views(play.events), delay=LATE), "t-pv")
    assert rows(got) == rows(windows.tumbling_count(page_views(ev), td(hours=1)))
    play = replay(spark, folder, "view")
    got = runner.collect_appended(play, aggregates.uv(page_views(play.events), delay=LATE), "t-uv")
    assert rows(got) == rows(uniques.uv(page_views(ev)))


def test_salted_and_bitmap_counts(spark, source):
    folder, ev = source
    play = replay(spark, folder, "view")
    got = runner.collect_appended(play, aggregates.pv_salted(page_views(play.events), delay=LATE), "t-salted")
    assert rows(got) == rows(windows.tumbling_count(page_views(ev), td(hours=1)))
    play = replay(spark, folder, "view")
    got = runner.collect_appended(play, aggregates.uv_bitmap(page_views(play.events), delay=LATE, capacity=64), "t-bits")
    assert rows(got) == rows(uniques.uv_bitmap(page_views(ev), capacity=64))


def test_sliding_estimates(spark, source):
    folder, ev = source
    five, hour = td(minutes=5), td(hours=1)
    play = replay(spark, folder, "view")
    got = runner.collect_appended(play, aggregates.uv_sliding_approx(
        page_views(play.events), "5 minutes", "1 hour", "5 minutes", LATE), "t-sketch")
    batch = uniques.uv_sliding_approx(uniques.uv_sketches(page_views(ev), five), five, hour, five)
    assert rows(got) == rows(batch)  # merged sketches do not depend on how the rows were cut into batches
    assert all(r.close for r in uniques.sliding_close(got, page_views(ev), five, hour, five).collect())


def test_report_of_closed_windows(spark, source):
    folder, ev = source
    play = replay(spark, folder, "view")
    counts = aggregates.hop_counts(page_views(play.events), "item_id", "1 hour", "5 minutes", LATE)
    got = runner.collect_appended(play, counts, "t-report", aggregates.report_closed())
    assert rows(got) == rows(topn.report(topn.top_n_hop(page_views(ev), "item_id", td(hours=1), td(minutes=5)), "item_id"))


def test_hot_items(spark, source):
    folder, ev = source
    play = replay(spark, folder, "view")
    counts = aggregates.hop_counts(page_views(play.events), "item_id", "1 hour", "5 minutes", LATE)
    got = runner.collect_appended(play, counts, "t-hot", aggregates.rank_closed())
    want = topn.top_n(windows.hop_counts(page_views(ev), ["item_id"], td(hours=1), td(minutes=5)), "item_id")
    assert rows(got) == rows(want)


def test_hot_urls_are_refined_by_late_rows(spark, source, tmp_path):
    folder, ev = source
    own = runner.stream_session(spark)
    stream = tables.instants(runner.events_stream(own, folder, "*.parquet", files_per_trigger=1))
    size, slide = td(minutes=10), td(seconds=60)
    late = aggregates.hot_urls(own, filters.get_requests(tables.access_log(stream)), str(tmp_path), size, slide,
                               delay=LATE)
    gets = filters.get_requests(tables.access_log(ev))
    want = topn.top_n(windows.hop_counts(gets, ["url"], size, slide), "url")
    assert rows(late.latest(), *want.columns) == rows(want)


def test_rows_on_each_side_of_the_lateness_limit(spark, tmp_path):
    """With 2 s out-of-orderness and 60 s lateness, a row of a pane that closed 62 s before the newest
    row is refused and one of the next pane still refines its windows."""
    folder, home = tmp_path / "in", str(tmp_path / "home")
    folder.mkdir()
    own = runner.stream_session(spark)

    def line(second, url):
        return f"10.0.0.1 - - 01/01/2024:{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d} +0000 GET {url}"

    def after(name, *lines):
        (folder / name).write_text("\n".join(lines))
        gets = filters.get_requests(logs.stream_log(own, "access", str(folder)))
        late = aggregates.hot_urls(own, gets, home, td(seconds=10), td(seconds=1))
        return {(secs(r["window_end"]), r["url"]): r["cnt"] for r in late.latest().collect()}

    first = after("1.log", line(937, "/a"), line(938, "/a"), line(1000, "/b"))
    assert first[939, "/a"] == 2 and first[1001, "/b"] == 1
    second = after("2.log", line(937, "/late"), line(938, "/a"), line(1001, "/b"))
    assert not [key for key in second if key[1] == "/late"]
    assert second[939, "/a"] == 3 and second[938, "/a"] == 1
    assert second[1002, "/b"] == 2


@pytest.mark.parametrize("files", [1, 2, 4])
def test_running_unique_visitors(spark, source, tmp_path, files):
    """Counts never fall, and the last of a window is its number of visitors, however the input is cut."""
    folder, ev = source
    own = runner.stream_session(spark)
    stream = tables.instants(runner.events_stream(own, folder, "*.parquet", files_per_trigger=files))
    runner.run(aggregates.uv_running(page_views(stream), delay=LATE), runner.append_batches(f"{tmp_path}/out"), f"{tmp_path}/cp", "update")
    updates = own.read.parquet(f"{tmp_path}/out")
    assert rows(aggregates.newest(updates)) == rows(uniques.uv(page_views(ev)))
    told = {}
    for r in updates.orderBy("batch_id").collect():
        assert r["uv"] > told.get(r["window_end"], 0)
        told[r["window_end"]] = r["uv"]


def test_replay_in_time_order(spark, source):
    folder, ev = source
    own = runner.stream_session(spark)
    ordered = own.read.parquet(runner.in_time_order(own, folder, 3, "*.parquet"))
    assert rows(ordered) == rows(ev)


@pytest.mark.parametrize("files", [1, 2, 4])
def test_changes_of_a_top_n_replay_to_it(spark, source, tmp_path, files):
    folder, ev = source
    own = runner.stream_session(spark)
    stream = tables.instants(runner.events_stream(own, folder, "*.parquet", files_per_trigger=files))
    top = aggregates.refined_top_n(own, page_views(stream), str(tmp_path), "item_id", td(hours=1), td(minutes=5), 3, LATE)
    want = topn.top_n(windows.hop_counts(page_views(ev), ["item_id"], td(hours=1), td(minutes=5)), "item_id", 3)
    assert rows(aggregates.replayed(top.changes()), *want.columns) == rows(want)
    assert rows(top.latest(), *want.columns) == rows(want)
    # batch by batch: what is retracted is there, what is added is not
    held = set()
    for batch in sorted({r["batch_id"] for r in top.changes().select("batch_id").distinct().collect()}):
        marked = [(r["change"], tuple(r[c] for c in want.columns)) for r in top.changes().filter(F.col("batch_id") == batch).collect()]
        gone = {row for change, row in marked if change == "-"}
        added = {row for change, row in marked if change == "+"}
        assert gone <= held and not added & held and len(gone) + len(added) == len(marked)
        held = held - gone | added
    assert files == 4 or any(r["change"] == "-" for r in top.changes().collect())


def test_refined_panes_are_removed_behind_the_watermark(spark, tmp_path):
    """The number of pane files follows the windows that can still change, not the batches."""
    own = runner.stream_session(spark)
    folder, home = tmp_path / "in", tmp_path / "home"
    folder.mkdir()
    sizes = []
    for i in range(12):
        # two minutes go by with every file; the first row of each comes late
        second = 120 * i
        lines = [f"10.0.0.1 - - 01/01/2024:{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d} +0000 GET /{s % 3}"
                 for s in (max(0, second - 5), second, second + 1, second + 60)]
        (folder / f"{i:02d}.log").write_text("\n".join(lines))
        gets = filters.get_requests(logs.stream_log(own, "access", str(folder), files_per_trigger=1))
        late = aggregates.hot_urls(own, gets, str(home), td(seconds=10), td(seconds=1), delay="30 seconds")
        sizes.append(len(late.panes.listing()))
        assert all(len(versions) <= 2 for versions in late.panes.listing().values())
    assert max(sizes) <= 4
    all_gets = filters.get_requests(logs.read_log(spark, "access", str(folder)))
    want = topn.top_n(windows.hop_counts(all_gets, ["url"], td(seconds=10), td(seconds=1)), "url")
    assert rows(late.latest(), *want.columns) == rows(want)


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    own = runner.stream_session(spark)
    top = aggregates.LateTopN(own, str(tmp_path), "k", "bigint", td(seconds=10), td(seconds=1), 2)
    first = own.createDataFrame([(100, 1, 5), (101, 2, 4), (101, 3, 4)], "pane bigint, k bigint, cnt bigint")
    second = own.createDataFrame([(101, 3, 6), (102, 1, 1)], "pane bigint, k bigint, cnt bigint")
    top.absorb(first, 0)
    top.absorb(second, 1)
    once = rows(top.latest()), rows(top.changes())
    top.absorb(second, 1)
    assert (rows(top.latest()), rows(top.changes())) == once
    top.absorb(first.limit(0), 2)
    assert rows(top.latest()) == once[0]


def test_runs_of_equal_windows(spark, source):
    folder, ev = source
    play = replay(spark, folder, *KINDS)
    got = real(runner.collect_appended(play, keyed.hop_runs(tables.channel_behaviour(play.events), ["channel", "behavior"],
                                                            td(minutes=30), td(seconds=30), LATE), "t-runs"))
    want = windows.hop_runs(tables.channel_behaviour(ev), ["channel", "behavior"], td(minutes=30), td(seconds=30))
    assert rows(got, *want.columns) == rows(want)


def test_runs_of_clicks_below_the_cap(spark, source):
    """Cap and sliding count are one stream of several stateful steps."""
    folder, ev = source
    play = replay(spark, folder, "click")
    kept = keyed.capped_clicks(tables.ad_clicks(play.events), 4, delay=LATE).filter(F.col("status") == keyed.KEPT)
    got = runner.collect_appended(play, keyed.hop_runs(kept, ["ad_id"], td(minutes=30), td(seconds=30)), "t-cap-runs")
    want = windows.hop_runs(fraud.capped_clicks(tables.ad_clicks(ev), 4), ["ad_id"], td(minutes=30), td(seconds=30))
    assert rows(got, *want.columns) == rows(want)


class Held:
    """The state calls of a processor, in memory, counting what is read."""

    class Value:
        def __init__(self):
            self.now = None

        def exists(self):
            return self.now is not None

        def get(self):
            return self.now

        def update(self, value):
            self.now = tuple(value)

        def clear(self):
            self.now = None

    class Map(dict):
        reads = 0

        def getValue(self, key):
            Held.Map.reads += len(self[key][0])
            return self[key]

        def updateValue(self, key, value):
            self[key] = value

        def removeKey(self, key):
            del self[key]

    def getValueState(self, name, schema):
        return self.Value()

    def getMapState(self, name, key_schema, schema):
        return self.Map()

    def registerTimer(self, at):
        pass

    deleteTimer = registerTimer


class Clock:
    def __init__(self, millis):
        self.getCurrentWatermarkInMs = lambda: millis


def held_rows(processor, times):
    pdf = pd.DataFrame({"t": times, "event_id": range(len(times)), "what": ["86400000000"] * len(times)})
    list(processor.handleInputRows((1, 1, None), iter([pdf]), Clock(0)))


def test_a_timer_reads_the_due_slices_alone():
    processor = keyed.FailEpisodes(16_000_000)
    processor.init(Held())
    held_rows(processor, [s * 1_000_000 for s in range(10_000)])
    Held.Map.reads = 0
    list(processor.handleExpiredTimer((1,), Clock(20_500), None))
    assert Held.Map.reads == 21  # one second is a slice here
    assert sum(len(v[0]) for v in processor.pending.values()) == 10_000 - 21


def test_all_creates_that_are_due_time_out_at_once():
    processor = keyed.FirstPay(10_000_000)
    processor.init(Held())
    pdf = pd.DataFrame({"t": [0, 1_000_000, 2_000_000], "event_id": [1, 2, 3], "what": ["create"] * 3})
    list(processor.handleInputRows((1,), iter([pdf]), Clock(0)))
    out = pd.concat(processor.handleExpiredTimer((1,), Clock(11_500), None))
    assert list(out["create_id"]) == [1, 2] and processor.memory.get() == ([3], [2_000_000])


def test_a_full_cap_stores_nothing_more():
    processor = keyed.ClickCap(5)
    processor.init(Held())
    held_rows(processor, list(range(1000, 0, -1)))
    assert sum(len(v[0]) for v in processor.pending.values()) == 5
    out = pd.concat(processor.handleExpiredTimer((1, 1, None), Clock(1), None))
    assert list(out["status"]) == [keyed.KEPT] * 4 + [keyed.BLACKLISTED]
    held_rows(processor, [2_000, 3_000])
    assert not processor.pending and not processor.index.exists()


def test_click_cap(spark, source):
    folder, ev = source
    play = replay(spark, folder, "click")
    got = real(runner.collect_appended(play, keyed.capped_clicks(tables.ad_clicks(play.events), 4, delay=LATE), "t-ads"))
    clicks = tables.ad_clicks(ev)
    kept = got.filter(F.col("status") == keyed.KEPT)
    assert rows(kept, "event_id") == rows(fraud.capped_clicks(clicks, 4), "event_id")
    alerts = got.filter(F.col("status") == keyed.BLACKLISTED)
    want = fraud.blacklist(clicks, 4)
    assert want.count() > 0
    assert rows(alerts, "user_id", "ad_id", "day", "ts") == rows(want, "user_id", "ad_id", "day", "alert_ts")


def test_login_episodes(spark, source):
    folder, ev = source
    within = td(minutes=10)
    play = replay(spark, folder, "error", "view")
    got = real(runner.collect_appended(play, keyed.fail_episodes(tables.logins(play.events), within, LATE), "t-login"))
    want = episodes.fail_episodes(tables.logins(ev), within)
    assert want.count() > 0
    assert rows(got, *want.columns) == rows(want)


def test_login_pairs_and_runs(spark, source):
    folder, ev = source
    play = replay(spark, folder, "error", "view")
    got = real(runner.collect_appended(play, keyed.fail_pairs(tables.logins(play.events), td(minutes=10), LATE), "t-pairs"))
    want = logins.fail_pairs(tables.logins(ev), td(minutes=10))
    assert want.count() > 0 and rows(got, *want.columns) == rows(want)
    play = replay(spark, folder, "error", "view")
    got = real(runner.collect_appended(play, keyed.fail_runs(tables.logins(play.events), 3, td(minutes=9), LATE), "t-login-runs"))
    want = logins.fail_runs(tables.logins(ev), 3, td(minutes=9))
    assert want.count() > 0 and rows(got, *want.columns) == rows(want)


def test_first_pays(spark, source):
    folder, ev = source
    play = replay(spark, folder, "signup", "purchase")
    got = real(runner.collect_appended(play, keyed.first_pays(tables.orders(play.events), td(minutes=9), LATE), "t-pays"))
    for status, want in (("paid", orders.pay_matches(tables.orders(ev), td(minutes=9))),
                         ("no_pay", orders.pay_timeouts(tables.orders(ev), td(minutes=9)))):
        assert want.count() > 0
        assert rows(got.filter(F.col("status") == status), *want.columns) == rows(want)


def test_a_busy_transaction_uses_many_stores(spark, tmp_path):
    """One id holds all rows; its slices lie in many state stores, and the rows come out as in the batch query."""
    folder, home = tmp_path / "in", tmp_path / "home"
    rng = random.Random(4)
    events = [(i, 7, rng.choice(["purchase", "click"]), float(rng.randrange(4000))) for i in range(600)]
    frame(spark, events, "event_id bigint, user_id bigint, event_type string, s double").coalesce(1).write.parquet(str(folder))
    own = runner.stream_session(spark, 8)
    ev = tables.instants(runner.events_stream(own, str(folder), "*.parquet"))
    bounds = td(seconds=5), td(seconds=9)
    joined = joins.reconcile(tables.payments(ev), tables.receipts(ev), *bounds, "0 seconds")
    runner.run(joined, runner.append_batches(f"{home}/out"), f"{home}/cp")
    for operator in (0, 1):
        held = (own.read.format("statestore").option("operatorId", operator).option("batchId", 0).option("joinSide", "left")
                .load(f"{home}/cp").groupBy("partition_id").count().collect())
        assert len(held) >= 7 and max(r["count"] for r in held) < sum(r["count"] for r in held) / 3
    ev = tables.instants(spark.read.parquet(str(folder)))
    want = rows(reconcile.reconcile(tables.payments(ev), tables.receipts(ev), *bounds))
    got = rows(own.read.parquet(f"{home}/out").drop("batch_id"), "tx_id", "pay_id", "pay_ts", "receipt_id", "receipt_ts", "status")
    # what the last watermark has not passed is still open
    assert set(got) <= set(want) and len(want) - len(got) < 10


def test_order_status(spark, source):
    folder, ev = source
    within = td(minutes=15)
    play = replay(spark, folder, "signup", "purchase")
    got = real(runner.collect_appended(play, keyed.order_status(tables.orders(play.events), within, LATE), "t-order"),
               "order_id")
    want = orders.order_status(tables.orders(ev), within)
    assert rows(got, *want.columns) == rows(want)


def test_reconcile(spark, source):
    folder, ev = source
    play, bounds = replay(spark, folder, "purchase", "click"), (td(minutes=3), td(minutes=5))
    joined = joins.reconcile(tables.payments(play.events), tables.receipts(play.events), *bounds, LATE)
    got = real(runner.collect_appended(play, joined, "t-rec"), "tx_id")
    want = reconcile.reconcile(tables.payments(ev), tables.receipts(ev), *bounds)
    assert rows(got, *want.columns) == rows(want)


def test_reconcile_one_to_one(spark, source):
    folder, ev = source
    early, late = 180, 300
    play = replay(spark, folder, "purchase", "click")
    settled = keyed.reconcile_one_to_one(tables.payments(play.events), tables.receipts(play.events),
                                         td(seconds=early), td(seconds=late), LATE)
    got = real(runner.collect_appended(play, settled, "t-one"), "tx_id")
    want, waiting = [], {}

    def alone(user):
        side, event_id, _ = waiting.pop(user)
        want.append((event_id, None, "pay_only") if side == "pay" else (None, event_id, "receipt_only"))

    for r in sorted(ev.filter("event_type in ('purchase', 'click')").collect(), key=lambda r: (r["ts"], r["event_id"])):
        user, side = r["user_id"], "pay" if r["event_type"] == "purchase" else "receipt"
        other = waiting.get(user)
        if other and (other[0] == side or r["ts"] - other[2] > td(seconds=late if other[0] == "pay" else early)):
            alone(user)
            other = None
        if other:
            del waiting[user]
            want.append((*((r["event_id"], other[1]) if side == "pay" else (other[1], r["event_id"])), "matched"))
        else:
            waiting[user] = (side, r["event_id"], r["ts"])
    for user in list(waiting):
        alone(user)
    assert rows(got, "pay_id", "receipt_id", "status") == sorted(want, key=str)


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    """Half the order log, a stop, the other half: state and results carry over, nothing repeats."""
    folder, home = tmp_path / "in", tmp_path / "home"
    folder.mkdir()
    base = 1704067200
    (folder / "1.csv").write_text(f"1,create,,{base}\n2,create,,{base + 100}")
    own = runner.stream_session(spark)

    def run_once():
        lines = logs.stream_log(own, "order", str(folder)).withColumn("event_id", F.unix_seconds("ts"))
        runner.run(keyed.order_status(lines), runner.append_batches(f"{home}/out"), f"{home}/checkpoint")
        out = own.read.option("basePath", f"{home}/out").parquet(f"{home}/out/*")
        return rows(out.select("order_id", "status"))

    assert run_once() == []
    (folder / "2.csv").write_text(f"1,pay,tx1,{base + 160}\n2,pay,tx2,{base + 1200}\n9,create,,{base + 90000}")
    assert run_once() == [(1, "paid"), (2, "late_or_orphan"), (2, "no_pay")]
    (folder / "3.csv").write_text(f"8,create,,{base + 200000}")
    assert run_once() == [(1, "paid"), (2, "late_or_orphan"), (2, "no_pay"), (9, "no_pay")]
