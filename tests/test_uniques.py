from collections import defaultdict
from datetime import timedelta as td

import pytest
from pyspark.sql import functions as F

from conftest import frame, random_events, secs
from eventide.functions.hashing import bitmap_offset
from eventide.operators import uniques

SCHEMA = "event_id bigint, user_id bigint, kind string, s double"


def visits(spark, seed=5, n=400):
    return frame(spark, random_events(seed, n, 40, 4 * 3600, ["pv"], step=15.0), SCHEMA)


def by_window(df):
    return {secs(r["window_end"]): r["uv"] for r in df.collect()}


def test_exact_bitmap_and_approximate(spark):
    v = visits(spark)
    exact = by_window(uniques.uv(v))
    assert by_window(uniques.uv_bitmap(v)) == exact  # short ids never share a position
    approx = by_window(uniques.uv_approx(v))
    assert approx.keys() == exact.keys()
    assert all(abs(approx[w] - exact[w]) <= max(2, 0.1 * exact[w]) for w in exact)


def test_offset_equals_direct_computation(spark):
    ids = [0, 7, 10, 123456, 1234567, 9223372036854775807]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "v bigint").select(bitmap_offset(F.col("v"))).collect()]
    for value, pos in zip(ids, got):
        want = 0
        for ch in str(value):
            want = want * 32 + ord(ch)
        assert pos == want % (1 << 30)
    with pytest.raises(ValueError):
        bitmap_offset(F.lit(1), 1000)


def test_ids_with_one_position_count_once(spark):
    v = frame(spark, [(0, 1000001, "pv", 1.0), (1, 2000001, "pv", 2.0)], SCHEMA)
    assert by_window(uniques.uv(v)) == {3600: 2}
    assert by_window(uniques.uv_bitmap(v)) == {3600: 1}


def test_running_count_row_by_row(spark):
    rows = random_events(6, 500, 60, 2 * 3600, ["pv"], step=3.0)
    got = {r["event_id"]: r["uv"] for r in uniques.uv_running(frame(spark, rows, SCHEMA)).collect()}
    seen = defaultdict(set)
    for event_id, user, _, s in sorted(rows, key=lambda r: (r[3], r[0])):
        seen[s // 3600].add(user)
        assert got[event_id] == len(seen[s // 3600])
    assert len(got) == len(rows)


def test_last_running_count_is_the_total(spark):
    v = visits(spark)
    last = {secs(r[0]): r[1] for r in
            uniques.uv_running(v).groupBy("window_end").agg(F.max("uv")).collect()}
    assert last == by_window(uniques.uv(v))


def test_running_count_has_no_task_per_window(spark):
    plan = uniques.uv_running(visits(spark, n=10), td(hours=1))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(slot" in plan


def test_empty(spark):
    none = visits(spark, n=2).filter("false")
    for op in (uniques.uv, uniques.uv_bitmap, uniques.uv_approx, uniques.uv_running):
        assert op(none).count() == 0


@pytest.mark.parametrize("pane,size,slide", [(60, 600, 60), (30, 600, 120), (600, 3600, 3600)])
def test_sliding_uniques_from_merged_sketches(spark, pane, size, slide):
    rows = random_events(31, 3000, 700, 2 * 3600, ["pv"], hot_share=0.3)
    rows += [(10_000 + i, None, "pv", float(i)) for i in range(20)]
    df = frame(spark, rows, "event_id bigint, user_id bigint, behavior string, s double")
    spans = td(seconds=pane), td(seconds=size), td(seconds=slide)
    exact = {}
    for _, user, _, s in rows:
        end = int(s // slide) * slide + slide
        for at in range(end, end + size, slide):
            exact.setdefault(at, set()).add(user)
    exact = {at: len(users - {None}) for at, users in exact.items()}
    assert {secs(r["window_end"]): r["uv"] for r in uniques.uv_sliding(df, *spans).collect()} == exact
    sketches = uniques.uv_sketches(df, spans[0])
    found = {secs(r["window_end"]): r["uv"] for r in uniques.uv_sliding_approx(sketches, *spans).collect()}
    assert found.keys() == exact.keys()
    assert all(abs(found[at] - exact[at]) <= max(1, 0.05 * exact[at]) for at in exact)
    assert all(r["close"] for r in uniques.uv_sliding_check(df, *spans).collect())


def test_sketches_need_windows_of_whole_panes(spark):
    df = frame(spark, [(1, 1, "pv", 0.0)], "event_id bigint, user_id bigint, behavior string, s double")
    with pytest.raises(ValueError):
        uniques.uv_sliding_approx(uniques.uv_sketches(df, td(seconds=7)), td(seconds=7), td(seconds=60), td(seconds=10))
