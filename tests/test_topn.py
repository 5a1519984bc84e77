from collections import defaultdict
from datetime import timedelta as td

import pytest
from pyspark.sql import functions as F

from conftest import at, frame, random_events, secs
from eventide.operators import topn, windows


def counts(spark, rows):
    return spark.createDataFrame([(at(w), k, c) for w, k, c in rows], "window_end timestamp, item_id bigint, cnt bigint")


def test_ties_go_to_the_smaller_key(spark):
    got = topn.top_n(counts(spark, [(300, 9, 4), (300, 2, 4), (300, 5, 7), (600, 1, 1)]), "item_id", 2)
    assert sorted((secs(r[0]), r[1], r[2], r[3]) for r in got.collect()) == [
        (300, 1, 5, 7), (300, 2, 2, 4), (600, 1, 1, 1)]


def test_trimmed_before_the_shuffle(spark):
    plan = topn.top_n(counts(spark, [(300, 9, 4)]), "item_id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_report_text(spark):
    ranked = topn.top_n(counts(spark, [(300, 9, 4), (300, 2, 5)]), "item_id")
    assert topn.report(ranked, "item_id").collect()[0]["report"] == (
        "=============2024-01-01 00:05:00.0=============\nTop1 ItemId:2 Count:5\nTop2 ItemId:9 Count:4\n")
    urls = ranked.withColumnRenamed("item_id", "url")
    assert topn.report(urls, "url", topn.URL_REPORT).collect()[0]["report"] == (
        "===========2024-01-01 00:05:00.0===========\nTop 1 URL:2 Count:5\nTop 2 URL:9 Count:4\n")


def test_sql_form_equals_dataframe_form(spark):
    ev = (frame(spark, random_events(2, 200, 6, 9000, ["pv", "buy"]),
                "event_id bigint, item_id bigint, behavior string, s double"))
    sql = topn.hot_items_sql(spark, ev).select("window_end", "row_num", "item_id", "cnt")
    pv = ev.filter(F.col("behavior") == "pv")
    ours = topn.top_n(windows.hop_counts(pv, ["item_id"], td(hours=1), td(minutes=5)), "item_id")
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, ours.collect()))


def test_changelog_replays_to_the_final_top_n(spark):
    ev = frame(spark, random_events(3, 250, 12, 3000, ["pv"], step=7.0),
               "event_id bigint, item_id bigint, behavior string, s double")
    size, slide = td(minutes=10), td(minutes=1)
    log = topn.top_n_changelog(ev, "item_id", size, slide, n=3).collect()
    shown = defaultdict(set)
    # Retractions of a step come before its additions.
    for r in sorted(log, key=lambda r: (r["as_of"], r["change"] == "+")):
        row = (r["rank"], r["item_id"], r["cnt"])
        assert r["as_of"] <= r["window_end"]
        if r["change"] == "+":
            assert row not in shown[r["window_end"]]
            shown[r["window_end"]].add(row)
        else:
            shown[r["window_end"]].remove(row)
    final = defaultdict(set)
    for r in topn.top_n(windows.hop_counts(ev, ["item_id"], size, slide), "item_id", 3).collect():
        final[r["window_end"]].add((r["rank"], r["item_id"], r["cnt"]))
    assert dict(shown) == dict(final)
    assert any(r["change"] == "-" for r in log)


def test_dropping_hopeless_keys_changes_nothing(spark):
    for seed, n, span, step, top in [(1, 2000, 1800, 1.0, 3), (2, 400, 3000, 5.0, 5), (3, 3000, 900, 0.5, 1)]:
        ev = frame(spark, random_events(seed, n, 15, span, ["pv"], hot_share=0.3, step=step),
                   "event_id bigint, item_id bigint, behavior string, s double")
        for size, slide in [(600, 5), (60, 10), (70, 70)]:
            size, slide = td(seconds=size), td(seconds=slide)
            want = topn.top_n(windows.hop_counts(ev, ["item_id"], size, slide), "item_id", top)
            runs = windows.key_runs(ev, ["item_id"], size, slide)
            left = topn.top_n(topn.contenders(runs, "item_id", size // slide, slide, top), "item_id", top)
            expected = sorted(map(tuple, want.collect()))
            assert sorted(map(tuple, left.collect())) == expected
            assert sorted(map(tuple, topn.top_n_hop(ev, "item_id", size, slide, top).collect())) == expected


def test_hopeless_keys_are_dropped_early(spark):
    # Nine busy items and ninety-one rare ones: few of the rare ones' windows are unrolled.
    rows = [(i, i % 9, "pv", i * 0.5) for i in range(7200)]
    rows += [(10_000 + i, 100 + i % 91, "pv", i * 9.0) for i in range(400)]
    ev = frame(spark, rows, "event_id bigint, item_id bigint, behavior string, s double")
    size, slide = td(minutes=10), td(seconds=5)
    every = windows.hop_counts(ev, ["item_id"], size, slide)
    left = topn.contenders(windows.key_runs(ev, ["item_id"], size, slide), "item_id", 120, slide, 5)
    assert left.filter("item_id >= 100").count() < every.filter("item_id >= 100").count() / 20


def test_more_ranks_than_spark_trims(spark):
    rows = [(300 * (1 + i % 2), i, (i * 7919) % 97) for i in range(5000)]
    got = {(secs(r["window_end"]), r["rank"]): (r["item_id"], r["cnt"]) for r in topn.top_n(counts(spark, rows), "item_id", 1500).collect()}
    for window in (300, 600):
        best = sorted((-c, k) for w, k, c in rows if w == window)[:1500]
        assert [got[window, i + 1] for i in range(1500)] == [(k, -c) for c, k in best]


@pytest.mark.parametrize("seed,slots,n,keys", [(1, 12, 5, 60), (2, 7, 2, 9), (3, 24, 3, 200), (4, 1, 2, 5)])
def test_changelog_against_brute_force(spark, seed, slots, n, keys):
    """Every window followed step by step, with far more keys than places."""
    rows = random_events(seed, 500, keys, 3 * 3600, ["pv"], hot_share=0.1, step=1.0)
    slide = 300
    panes = {}
    for _, key, _, s in rows:
        panes.setdefault(int(s // slide), []).append(key)
    want = []
    for end in range(min(panes) + 1, max(panes) + slots + 1):
        before, held = [], {}
        for step in range(end - slots, end):
            for key in panes.get(step, ()):
                held[key] = held.get(key, 0) + 1
            now = [(i + 1, k, c) for i, (k, c) in enumerate(sorted(held.items(), key=lambda x: (-x[1], x[0]))[:n])]
            want += [(end, step + 1, "-", *row) for row in before if row not in now]
            want += [(end, step + 1, "+", *row) for row in now if row not in before]
            before = now
    df = frame(spark, rows, "event_id bigint, item_id bigint, behavior string, s double")
    got = [(secs(r["window_end"]) // slide, secs(r["as_of"]) // slide, r["change"], r["rank"], r["item_id"], r["cnt"])
           for r in topn.top_n_changelog(df, "item_id", td(seconds=slide * slots), td(seconds=slide), n).collect()]
    assert sorted(got) == sorted(want)


def test_keys_out_of_the_running_are_not_followed_step_by_step(spark):
    """Rows that reach the ranking follow the first places, not the number of keys."""
    rows = [(i, i % 3, "pv", float(i % 3600)) for i in range(3000)] + [(10_000 + i, 100 + i, "pv", 1800.0 + i % 100) for i in range(2000)]
    df = frame(spark, rows, "event_id bigint, item_id bigint, behavior string, s double")
    plain = topn._first_of_steps
    seen = []

    def counting(so_far, *args):
        out = plain(so_far, *args)
        seen.append((so_far.count(), out.count()))
        return out

    topn._first_of_steps = counting
    try:
        topn.top_n_changelog(df, "item_id", td(hours=1), td(minutes=5), 3).count()
    finally:
        topn._first_of_steps = plain
    assert seen[0][1] < seen[0][0] / 5
