"""Rules that run per (key, block) give what a look at the key's whole history gives, and a busy key is spread."""

import random
from datetime import timedelta as td

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import frame, random_events
from eventide.functions import blocks
from eventide.functions.blocks import in_blocks, nearest_outside, with_neighbours
from eventide.operators import reconcile
from eventide.plans import catalog

SCHEMA = "event_id bigint, user_id bigint, event_type string, s double"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    """Few rows to a block, so that every key of a test has many."""
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 4)


@pytest.mark.parametrize("reach", [1, 2, 5])
def test_neighbours_are_those_of_the_whole_history(spark, reach):
    df = frame(spark, random_events(21, 900, 5, 5 * 3600, ["a", "b"], step=7.0), SCHEMA)
    df = df.unionByName(df.filter("event_id % 100 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 DAYS")))

    def back(w):
        return {"b": F.lag("event_id", reach).over(w), "s": F.sum("event_id").over(w.rowsBetween(-reach, 0))}

    def ahead(w):
        return {"a": F.lead("event_id", reach).over(w)}

    whole = Window.partitionBy("user_id").orderBy("ts", "event_id")
    names = ["event_id", "ts", "b", "s", "a"]
    want = df.select("event_id", "ts", *[c.alias(n) for n, c in (back(whole) | ahead(whole)).items()]).select(names)
    got = with_neighbours(in_blocks(df, "user_id", "ts"), "user_id", ["ts", "event_id"], back, ahead, reach)
    assert rows_of(got.select(names)) == rows_of(want)


def test_nearest_outside_the_block(spark):
    blocked = in_blocks(frame(spark, random_events(22, 400, 3, 3 * 3600, ["a", "b"], step=7.0), SCHEMA), "user_id", "ts")
    got = nearest_outside(blocked, "user_id", {"a": F.when(F.col("event_type") == "a", F.col("ts"))}).collect()
    all_rows = blocked.rows.collect()
    for r in got:
        same = [x for x in all_rows if x["user_id"] == r["user_id"] and x["event_type"] == "a"]
        assert r["before_a"] == max((x["ts"] for x in same if x["block"] < r["block"]), default=None)
        assert r["after_a"] == min((x["ts"] for x in same if x["block"] > r["block"]), default=None)


@pytest.mark.parametrize("own", [1000, 2])
def test_a_busy_key_is_spread_over_many_tasks(spark, monkeypatch, own):
    """One user with a third of all rows over 30 days: whatever a rule looks over, its rows lie in very many tasks."""
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 20)
    monkeypatch.setattr(blocks, "OWN_WIDTHS", own)
    rows = random_events(23, 9000, 50, 30 * 86400, ["fail"], hot_share=0.33, step=1.0)
    blocked = in_blocks(frame(spark, rows, SCHEMA), "user_id", "ts")
    assert blocked.several and blocked.rows.count() == 9000
    dealt = blocked.rows.repartition(400, "user_id", "block")
    per_task = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum((F.col("user_id") == 0).cast("int")).alias("n")).collect()]
    busy = [n for n in per_task if n]
    assert own == 2 or len(busy) >= 100 and max(busy) < sum(busy) / 30
    per_block = blocked.rows.filter("user_id = 0").groupBy("block").count().collect()
    assert own == 2 or len(per_block) >= 120


def test_no_blocks_where_no_key_is_busy(spark, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 1000)
    df = frame(spark, random_events(24, 900, 50, 86400, ["fail"], step=1.0), SCHEMA)
    blocked = in_blocks(df, "user_id", "ts")
    assert not blocked.several and blocked.rows.select("block").distinct().count() == 1


RULES = ["login_fail_pair", "login_fail_run", "login_fail_two_step", "login_fail_episode", "order_pay_match", "order_pay_timeout",
         "order_status", "order_late_payment", "pay_receipt_reconcile", "pay_receipt_one_to_one", "pay_without_receipt", "receipt_without_pay"]


@pytest.mark.parametrize("name", RULES)
def test_rules_give_the_same_in_one_block_and_in_many(spark, monkeypatch, name, tmp_path):
    sparse = name == "login_fail_episode"  # with many rows a success is never far
    kinds = ["view", "error", "click", "signup", "purchase"] + ["error"] * 15 * sparse
    rows = random_events(25, 1500, 6, (120 if sparse else 6) * 86400, kinds, step=60.0)
    rows += [(5000 + i, None, kind, i * 600.0) for i, kind in enumerate(["signup", "purchase", "click", "error"] * 5)]
    (frame(spark, rows, SCHEMA).withColumn("props", F.lit('{"k": 1}')).withColumn("value", F.lit(0.0)).coalesce(1)
     .write.parquet(str(tmp_path / "events.parquet")))
    query = catalog.batch_queries()[name]
    many = rows_of(query(spark, str(tmp_path)))
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 10**6)
    assert many and many == rows_of(query(spark, str(tmp_path)))


def brute_one_to_one(pays, receipts, early, late):
    rows = sorted([(s, i, "pay", k) for k, i, s in pays] + [(s, i, "receipt", k) for k, i, s in receipts])
    out, waiting = [], {}

    def alone(key):
        s, i, side, _ = waiting.pop(key)
        out.append((key, i, None, "pay_only") if side == "pay" else (key, None, i, "receipt_only"))

    for row in rows:
        s, i, side, key = row
        if key is None:
            out.append((key, i, None, "pay_only") if side == "pay" else (key, None, i, "receipt_only"))
            continue
        other = waiting.get(key)
        if other and (other[2] == side or s - other[0] > (late if other[2] == "pay" else early)):
            alone(key)
            other = None
        if other:
            del waiting[key]
            out.append((key, *((i, other[1]) if side == "pay" else (other[1], i)), "matched"))
        else:
            waiting[key] = row
    for key in list(waiting):
        alone(key)
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,early,late,step", [(1, 3, 5, 0.5), (2, 600, 900, 5.0), (3, 0, 4, 1.0), (4, 40, 20, 1.0), (5, 90, 90, 7.0)])
def test_one_to_one_with_repeating_ids(spark, seed, early, late, step):
    rng = random.Random(seed)

    def side():
        return [(rng.choice([None, "hot", "hot", "hot", "a", "b"]), i, rng.randrange(int(3000 / step)) * step) for i in range(400)]

    pays, receipts = side(), side()
    p = frame(spark, pays, "tx_id string, pay_id bigint, s double").withColumnRenamed("ts", "pay_ts")
    r = frame(spark, receipts, "tx_id string, receipt_id bigint, s double").withColumnRenamed("ts", "receipt_ts")
    got = reconcile.reconcile_one_to_one(p, r, td(seconds=early), td(seconds=late))
    assert rows_of(got.select("tx_id", "pay_id", "receipt_id", "status")) == brute_one_to_one(pays, receipts, early, late)


def test_one_to_one_in_one_unbroken_chain(spark):
    """A thousand rows of one id, each in reach of the next: the pairing is carried over many blocks."""
    pays = [("x", i, i * 20.0) for i in range(500)]
    receipts = [("x", i, i * 20.0 + 10) for i in range(500)]
    p = frame(spark, pays, "tx_id string, pay_id bigint, s double").withColumnRenamed("ts", "pay_ts")
    r = frame(spark, receipts, "tx_id string, receipt_id bigint, s double").withColumnRenamed("ts", "receipt_ts")
    for extra in (0, 1):  # with a receipt put in front all pairs shift by one
        more = r.unionByName(frame(spark, [("x", -1, -10.0)], "tx_id string, receipt_id bigint, s double")
                             .withColumnRenamed("ts", "receipt_ts")) if extra else r
        bounds = td(seconds=10), td(seconds=10)
        got = rows_of(reconcile.reconcile_one_to_one(p, more, *bounds).select("tx_id", "pay_id", "receipt_id", "status"))
        assert got == brute_one_to_one(pays, receipts + [("x", -1, -10.0)] * extra, 10, 10)


def test_one_to_one_of_empty_sides(spark):
    p = frame(spark, [("x", 1, 0.0)], "tx_id string, pay_id bigint, s double").withColumnRenamed("ts", "pay_ts")
    r = frame(spark, [("x", 1, 0.0)], "tx_id string, receipt_id bigint, s double").withColumnRenamed("ts", "receipt_ts")
    assert [x["status"] for x in reconcile.reconcile_one_to_one(p, r.filter("false")).collect()] == ["pay_only"]
    assert [x["status"] for x in reconcile.reconcile_one_to_one(p.filter("false"), r).collect()] == ["receipt_only"]
    assert reconcile.reconcile_one_to_one(p.filter("false"), r.filter("false")).count() == 0
