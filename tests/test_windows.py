from datetime import timedelta as td

import pytest
from pyspark.sql import functions as F

from conftest import frame, random_events, secs
from eventide.operators import windows

SCHEMA = "event_id bigint, item bigint, kind string, s double"


def events(spark, seed=1, n=300, span=7200, step=0.5):
    return frame(spark, random_events(seed, n, 5, span, ["a", "b"], step=step), SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size,slide", [(3600, 300), (600, 5), (60, 60), (90, 30)])
def test_hop_counts_equal_builtin_windows(spark, size, slide):
    ev = events(spark, n=120)
    ours = windows.hop_counts(ev, ["item", "kind"], td(seconds=size), td(seconds=slide))
    builtin = (ev.groupBy("item", "kind", F.window("ts", f"{size} seconds", f"{slide} seconds"))
               .agg(F.count("*").alias("cnt"))
               .select("item", "kind", F.col("window.end").alias("window_end"), "cnt"))
    assert rows(ours) == rows(builtin)


def test_runs_unroll_to_counts_and_are_maximal(spark):
    ev, size, slide = events(spark), td(seconds=600), td(seconds=5)
    runs = windows.hop_runs(ev, ["item"], size, slide)
    unrolled = runs.select("item", F.explode(F.sequence(
        "first_window_end", "last_window_end", F.expr("interval 5 seconds"))).alias("window_end"), "cnt")
    assert rows(unrolled) == rows(windows.hop_counts(ev, ["item"], size, slide))
    ordered = sorted(runs.collect(), key=lambda r: (r["item"], r["first_window_end"]))
    for a, b in zip(ordered, ordered[1:]):
        touching = a["item"] == b["item"] and secs(b["first_window_end"]) - secs(a["last_window_end"]) == 5
        if touching:
            assert a["cnt"] != b["cnt"]
    assert all((r["last_window_end"] - r["first_window_end"]).total_seconds() / 5 + 1 == r["windows"]
               for r in ordered)


def test_runs_go_on_over_block_ends(spark):
    # one row a minute for five days: windows of ten minutes hold ten rows all along
    ev = frame(spark, [(i, 1, "a", 60.0 * i) for i in range(5 * 1440)] + [(9999, 2, "a", 86400.0)], SCHEMA)
    runs = windows.hop_runs(ev, ["item"], td(minutes=10), td(minutes=1))
    assert sorted((r["item"], r["windows"], r["cnt"]) for r in runs.collect() if r["cnt"] == 10 or r["item"] == 2) == [
        (1, 5 * 1440 - 9, 10), (2, 10, 1)]


def test_window_bounds(spark):
    ev = frame(spark, [(0, 1, "a", 0.0), (1, 1, "a", 299.999999), (2, 1, "a", 300.0)], SCHEMA)
    got = {secs(r["window_end"]): r["cnt"]
           for r in windows.hop_counts(ev, ["item"], td(minutes=10), td(minutes=5)).collect()}
    assert got == {300: 2, 600: 3, 900: 1}
    tumbling = {secs(r["window_end"]): r["cnt"]
                for r in windows.tumbling_count(ev, td(minutes=5)).collect()}
    assert tumbling == {300: 2, 600: 1}


def test_before_the_epoch(spark):
    ev = frame(spark, [(0, 1, "a", -1704067200.0 - 1)], SCHEMA)  # one second before 1970
    got = [r["window_end"].timestamp() for r in windows.hop_counts(ev, ["item"], td(minutes=1), td(minutes=1)).collect()]
    assert got == [0.0]


def test_salted_equals_plain(spark):
    ev = events(spark)
    assert rows(windows.salted_tumbling_count(ev, td(minutes=20), "event_id")) == rows(
        windows.tumbling_count(ev, td(minutes=20)))


def test_size_must_be_a_multiple_of_the_slide(spark):
    with pytest.raises(ValueError):
        windows.hop_counts(events(spark, n=5), ["item"], td(seconds=10), td(seconds=3))


def test_empty(spark):
    none = events(spark, n=5).filter("false")
    assert windows.hop_counts(none, ["item"], td(minutes=10), td(seconds=5)).count() == 0
    assert windows.hop_runs(none, ["item"], td(minutes=10), td(seconds=5)).count() == 0


def test_hot_key_is_counted_before_it_is_shuffled(spark):
    plan = windows.hop_counts(events(spark), ["item"], td(minutes=10), td(seconds=5))
    text = plan._jdf.queryExecution().sparkPlan().toString()
    assert "partial_count" in text
    assert "Expand" not in text  # no copy of raw rows per window
