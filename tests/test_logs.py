import hashlib
from datetime import timedelta as td

import pytest

from conftest import secs
from eventide.operators import episodes, filters, fraud, logins, orders, reconcile, topn, uniques
from eventide.sources import logs


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


T = "1704067260"  # one minute past the base time


def one(df):
    row = df.collect()[0].asDict()
    row["ts"] = secs(row["ts"])
    return row


def test_delimited_formats(spark):
    assert one(logs.parse_behavior_log(lines(spark, f"5,17,3,pv,{T}"))) == {
        "user_id": 5, "item_id": 17, "category_id": 3, "behavior": "pv", "ts": 60}
    assert one(logs.parse_login_log(lines(spark, f"5,10.0.0.1,fail,{T}"))) == {
        "user_id": 5, "ip": "10.0.0.1", "event_type": "fail", "ts": 60}
    assert one(logs.parse_order_log(lines(spark, f"5,create,,{T}"))) == {
        "order_id": 5, "event_type": "create", "tx_id": "", "ts": 60}
    assert one(logs.parse_receipt_log(lines(spark, f"tx1,wechat,{T}"))) == {
        "tx_id": "tx1", "pay_channel": "wechat", "ts": 60}
    assert one(logs.parse_ad_log(lines(spark, f"5,17,beijing,beijing,{T}"))) == {
        "user_id": 5, "ad_id": 17, "province": "beijing", "city": "beijing", "ts": 60}


def test_access_format(spark):
    line = "83.149.9.216 - - 01/01/2024:00:01:00 +0000 GET /presentations/a.png"
    assert one(logs.parse_access_log(lines(spark, line))) == {
        "ip": "83.149.9.216", "user_id": "-", "method": "GET", "url": "/presentations/a.png", "ts": 60}


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", [f"x,17,3,pv,{T}", "5,17,3,pv,later", "5,17,3,pv", ""])
def test_a_bad_field_stops_the_job(spark, bad, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="bad "):
            logs.parse_behavior_log(lines(spark, bad)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_bad_time_stops_the_job(spark):
    with pytest.raises(Exception, match="bad time"):
        logs.parse_access_log(lines(spark, "ip - - 2024-01-01 +0000 GET /a")).collect()


def test_read_from_a_file(spark, tmp_path):
    (tmp_path / "order.csv").write_text(f"1,create,,{T}\n1,pay,tx9,{T}")
    got = logs.read_log(spark, "order", str(tmp_path)).collect()
    assert [(r["order_id"], r["event_type"], r["tx_id"]) for r in got] == [(1, "create", ""), (1, "pay", "tx9")]


def test_milliseconds(spark):
    row = one(logs.parse_market_log(lines(spark, f"5,CLICK,wechat,{T}250")))
    assert row == {"user_id": 5, "behavior": "CLICK", "channel": "wechat", "ts": 60.25}


def test_ids_come_from_the_line_alone(spark):
    texts = [f"5,10.0.0.1,fail,{T}", f"5,10.0.0.1,fail,{T}", f"5,10.0.0.2,fail,{T}"]
    ids = [r["event_id"] for r in logs.parse_login_log(lines(spark, *texts), with_id=True).collect()]
    assert ids[0] == ids[1] != ids[2]
    again = logs.parse_login_log(lines(spark, *reversed(texts)).repartition(3), with_id=True)
    assert sorted(r["event_id"] for r in again.collect()) == sorted(ids)
    assert ids[0] == int(hashlib.md5(texts[0].encode()).hexdigest()[:15], 16)


def test_from_lines_to_every_pattern(spark):
    """The fixture shapes as log lines: parsed rows feed the operators as they are."""
    start = int(T)
    login = logs.parse_login_log(lines(spark, *[f"1035,83.149.24.26,fail,{start + s}" for s in range(5)],
                                       f"1036,83.149.9.216,success,{start}"), with_id=True)
    assert logins.fail_pairs(login).count() == 4
    assert logins.fail_runs(login).count() == 1
    assert [r["n"] for r in episodes.fail_episodes(login).orderBy("first_ts").collect()] == [3, 2]
    order = logs.parse_order_log(lines(spark, f"1,create,,{start}", f"1,pay,tx1,{start + 60}", f"2,create,,{start}",
                                       f"2,pay,tx2,{start + 2000}"), with_id=True)
    assert sorted(r["status"] for r in orders.order_status(order).collect()) == ["late_or_orphan", "no_pay", "paid"]
    receipt = logs.parse_receipt_log(lines(spark, f"tx1,wechat,{start + 62}", f"tx9,alipay,{start}"), with_id=True)
    sides = logs.payments(order), logs.receipts(receipt)
    pair = reconcile.interval_join(*sides).collect()
    assert [(r["tx_id"], r["order_id"], r["pay_channel"]) for r in pair] == [("tx1", 1, "wechat")]
    assert sorted(r["status"] for r in reconcile.reconcile(*sides).collect()) == ["matched", "pay_only", "receipt_only"]
    access = logs.parse_access_log(lines(spark, "ip - - 01/01/2024:00:01:00 +0000 GET /a"), with_id=True)
    assert topn.top_n_hop(filters.get_requests(access), "url", td(minutes=10), td(minutes=1)).count() == 10
    views = logs.parse_behavior_log(lines(spark, f"5,17,3,pv,{T}", f"6,17,3,pv,{T}"), with_id=True)
    assert [r["uv"] for r in uniques.uv(filters.page_views(views)).collect()] == [2]
    clicks = logs.parse_ad_log(lines(spark, *[f"5,17,beijing,beijing,{start + i}" for i in range(4)]), with_id=True)
    assert fraud.capped_clicks(clicks, 3).count() == 2 and fraud.blacklist(clicks, 3).count() == 1


def test_both_records_whole_and_shared_names(spark):
    p = spark.sql("SELECT 'a' AS tx_id, 1 AS pay_id, TIMESTAMP '2024-01-01 00:00:00' AS pay_ts, 'x' AS note, 5 AS amount")
    r = spark.sql("SELECT 'a' AS tx_id, 2 AS receipt_id, TIMESTAMP '2024-01-01 00:00:03' AS receipt_ts, 'y' AS note, 'z' AS _slice2")
    row = reconcile.interval_join(p, r).collect()[0].asDict()
    assert (row["pay_note"], row["receipt_note"], row["amount"], row["_slice2"]) == ("x", "y", 5, "z")
