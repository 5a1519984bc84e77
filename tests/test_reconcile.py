import random
from datetime import timedelta as td

import pytest

from conftest import frame, secs
from eventide.operators import reconcile


def pays(spark, rows):
    return frame(spark, rows, "tx_id string, pay_id bigint, s double").withColumnRenamed("ts", "pay_ts")


def receipts(spark, rows):
    return frame(spark, rows, "tx_id string, receipt_id bigint, s double").withColumnRenamed("ts", "receipt_ts")


# Shapes of the payment sample: +3 s, exactly -3 s, 0 s, too early, too late, one-sided
PAYS = [("a", 1, 0.0), ("b", 2, 10.0), ("c", 3, 20.0), ("d", 4, 30.0), ("e", 5, 40.0), ("f", 6, 50.0)]
RECEIPTS = [("a", 1, 3.0), ("b", 2, 7.0), ("c", 3, 20.0), ("d", 4, 26.999999), ("e", 5, 45.000001), ("g", 7, 60.0)]


def test_bounds_and_three_outcomes(spark):
    p, r = pays(spark, PAYS), receipts(spark, RECEIPTS)
    assert sorted(x["tx_id"] for x in reconcile.interval_join(p, r).collect()) == ["a", "b", "c"]
    assert sorted((x["tx_id"], x["status"]) for x in reconcile.reconcile(p, r).collect()) == [
        ("a", "matched"), ("b", "matched"), ("c", "matched"), ("d", "pay_only"), ("d", "receipt_only"),
        ("e", "pay_only"), ("e", "receipt_only"), ("f", "pay_only"), ("g", "receipt_only")]
    assert sorted(x["tx_id"] for x in reconcile.pay_without_receipt(p, r).collect()) == ["d", "e", "f"]
    assert sorted(x["tx_id"] for x in reconcile.receipt_without_pay(p, r).collect()) == ["d", "e", "g"]


def test_upper_bound_is_inclusive(spark):
    p = pays(spark, [("a", 1, 0.0)])
    assert reconcile.interval_join(p, receipts(spark, [("a", 1, 5.0)])).count() == 1
    assert reconcile.interval_join(p, receipts(spark, [("b", 1, 5.0)])).count() == 0


@pytest.mark.parametrize("seed,early,late", [(1, 3, 5), (2, 0, 4), (3, 6, 1)])
def test_random_sides_with_duplicate_keys(spark, seed, early, late):
    rng = random.Random(seed)

    def side():
        return [("hot" if rng.random() < 0.4 else f"t{rng.randrange(9)}", i, rng.randrange(400) * 0.5)
                for i in range(250)]

    left, right = side(), side()
    want = sorted((p[1], r[1]) for p in left for r in right
                  if p[0] == r[0] and p[2] - early <= r[2] <= p[2] + late)
    p, r = pays(spark, left), receipts(spark, right)
    bounds = td(seconds=early), td(seconds=late)
    got = sorted((x["pay_id"], x["receipt_id"]) for x in reconcile.interval_join(p, r, *bounds).collect())
    assert got == want
    only = sorted(x["pay_id"] for x in reconcile.pay_without_receipt(p, r, *bounds).collect())
    assert only == sorted({x[1] for x in left} - {a for a, _ in want})
    only = sorted(x["receipt_id"] for x in reconcile.receipt_without_pay(p, r, *bounds).collect())
    assert only == sorted({x[1] for x in right} - {b for _, b in want})
    whole = reconcile.reconcile(p, r, *bounds).collect()
    assert {x["pay_id"] for x in whole if x["pay_id"] is not None} == {x[1] for x in left}
    assert {x["receipt_id"] for x in whole if x["receipt_id"] is not None} == {x[1] for x in right}


def test_joined_on_key_and_slice(spark):
    plan = reconcile.interval_join(pays(spark, PAYS), receipts(spark, RECEIPTS))
    condition = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "slice" in condition and "Join Inner" in condition


def test_one_side_empty(spark):
    p, none = pays(spark, PAYS), receipts(spark, RECEIPTS).filter("false")
    assert reconcile.interval_join(p, none).count() == 0
    assert {x["status"] for x in reconcile.reconcile(p, none).collect()} == {"pay_only"}
    assert secs(reconcile.pay_without_receipt(p, none).orderBy("pay_ts").collect()[0]["pay_ts"]) == 0
