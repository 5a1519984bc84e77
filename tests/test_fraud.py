from datetime import timedelta as td

import pytest
from pyspark.sql import functions as F

from conftest import frame, random_events, secs
from eventide.operators import fraud

SCHEMA = "event_id bigint, user_id bigint, ad_id bigint, s double"


def clicks(spark, n, user=937166, ad=1715, start=0.0, first_id=0):
    return frame(spark, [(first_id + i, user, ad, start + i) for i in range(n)], SCHEMA)


def test_cap_of_a_hundred(spark):
    both = clicks(spark, 121).unionByName(clicks(spark, 22, user=1, first_id=1000))
    kept = fraud.capped_clicks(both)
    assert kept.count() == 121  # 99 + 22
    alerts = fraud.blacklist(both).collect()
    assert [(r["user_id"], r["ad_id"], secs(r["alert_ts"])) for r in alerts] == [(937166, 1715, 99.0)]
    assert alerts[0]["warning"] == "blacklisted"


def test_exactly_below_the_cap(spark):
    assert fraud.blacklist(clicks(spark, 99)).count() == 0
    assert fraud.capped_clicks(clicks(spark, 99)).count() == 99
    assert fraud.capped_clicks(clicks(spark, 100)).count() == 99


def test_day_changes_at_sixteen_hours_utc(spark):
    edge = 16 * 3600.0
    rows = frame(spark, [(0, 1, 1, edge - 2), (1, 1, 1, edge - 1), (2, 1, 1, edge), (3, 1, 1, edge + 1)], SCHEMA)
    assert sorted(r["event_id"] for r in fraud.capped_clicks(rows, 2).collect()) == [0, 2]
    assert sorted(secs(r["alert_ts"]) for r in fraud.blacklist(rows, 2).collect()) == [edge - 1, edge + 1]
    assert [r["event_id"] for r in fraud.capped_clicks(rows, 2, zone="+00:00").collect()] == [0]


def test_equal_times_go_by_id_and_kept_plus_dropped_is_all(spark):
    rows = [(i, u, i % 2, s) for i, u, _, s in random_events(4, 300, 5, 400000, ["x"], step=20000.0)]
    ev = frame(spark, rows, SCHEMA)
    kept = {r["event_id"] for r in fraud.capped_clicks(ev, 3).collect()}
    seen, want = {}, set()
    for i, u, ad, s in sorted(rows, key=lambda r: (r[3], r[0])):
        key = (u, ad, (s + 8 * 3600) // 86400)
        seen[key] = seen.get(key, 0) + 1
        if seen[key] < 3:
            want.add(i)
    assert kept == want


def test_trim_happens_before_the_shuffle_and_large_caps_agree(spark):
    ev = clicks(spark, 60)
    assert "WindowGroupLimit" in fraud.capped_clicks(ev, 50)._jdf.queryExecution().executedPlan().toString()
    plain = sorted(r["event_id"] for r in fraud.capped_clicks(ev, 50).collect())
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        salted = sorted(r["event_id"] for r in fraud.capped_clicks(ev, 50).collect())
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert plain == salted == list(range(49))


def test_cap_below_two_is_refused(spark):
    with pytest.raises(ValueError):
        fraud.capped_clicks(clicks(spark, 2), 1)


def test_by_province_counts_only_kept_clicks(spark):
    ev = clicks(spark, 10).withColumn("province", F.lit("beijing"))
    runs = fraud.clicks_by_province(ev, 4, td(hours=1), td(seconds=5))
    assert runs.agg(F.max("cnt")).collect()[0][0] == 3


def test_empty(spark):
    assert fraud.capped_clicks(clicks(spark, 3).filter("false")).count() == 0
