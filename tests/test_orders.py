from datetime import timedelta as td

import pytest

from conftest import frame, random_events, secs
from eventide.operators import orders

SCHEMA = "event_id bigint, order_id bigint, event_type string, s double"
C, P = "create", "pay"


def log(spark, events):
    return frame(spark, [(i, o, kind, float(s)) for i, (o, kind, s) in enumerate(events)], SCHEMA)


def times(df, *names):
    return sorted(((r["order_id"], *(None if r[n] is None else secs(r[n]) for n in names))
                   for r in df.collect()), key=str)


def histories(rows):
    found = {}
    for event_id, order, kind, s in sorted(rows, key=lambda r: (r[3], r[0])):
        found.setdefault(order, []).append((kind, s))
    return found


def brute_matches(rows, within):
    out = []
    for order, h in histories(rows).items():
        for i, (kind, s) in enumerate(h):
            if kind == C:
                pay = next((t for k, t in h[i + 1:] if k == P), None)
                out.append((order, s, pay if pay is not None and pay - s < within else None))
    return sorted(out, key=str)


def brute_status(rows, limit):
    """The rule as a state machine over one order at a time."""
    out = []
    for order, h in histories(rows).items():
        opened = None
        for kind, s in [*h, (None, float("inf"))]:
            if opened is not None and (kind == C or s > opened + limit):
                out.append((order, opened, None, "no_pay"))
                opened = None
            if kind == C:
                opened = s
            elif kind == P:
                out.append((order, opened, s, "paid" if opened is not None else "late_or_orphan"))
                opened = None
    return sorted(out, key=str)


def status(df):
    return sorted(((r["order_id"], *(None if r[n] is None else secs(r[n]) for n in ("create_ts", "pay_ts")),
                    r["status"]) for r in df.collect()), key=str)


# The order sample's odd ones: two paid too late, one paid without a create; one in time
SAMPLE = [(34756, C, 0), (34756, P, 1038), (34767, C, 10), (34767, P, 1082), (34768, P, 50), (34729, C, 5), (34729, P, 20)]


def test_sample_answers(spark):
    rows = log(spark, SAMPLE)
    assert times(orders.pay_matches(rows), "create_ts", "pay_ts") == [(34729, 5, 20)]
    assert times(orders.pay_timeouts(rows), "create_ts") == [(34756, 0), (34767, 10)]
    assert times(orders.late_payments(rows), "pay_ts") == [(34756, 1038), (34767, 1082), (34768, 50)]
    assert times(orders.pay_matches(rows, td(seconds=15)), "create_ts", "pay_ts") == []
    assert times(orders.pay_matches(rows, td(seconds=16)), "create_ts", "pay_ts") == [(34729, 5, 20)]


def test_match_is_strict_and_status_inclusive_at_the_bound(spark):
    rows = log(spark, [(1, C, 0), (1, P, 900)])
    assert times(orders.pay_timeouts(rows), "create_ts") == [(1, 0)]
    assert status(orders.order_status(rows)) == [(1, 0, 900, "paid")]


def test_repeated_create_and_second_pay(spark):
    rows = log(spark, [(1, C, 0), (1, C, 10), (1, P, 20), (1, P, 30)])
    assert times(orders.pay_matches(rows), "create_ts", "pay_ts") == [(1, 0, 20), (1, 10, 20)]
    assert status(orders.order_status(rows)) == [
        (1, 0, None, "no_pay"), (1, 10, 20, "paid"), (1, None, 30, "late_or_orphan")]


def test_pay_before_create_and_equal_times(spark):
    assert status(orders.order_status(log(spark, [(1, P, 1), (1, C, 2)]))) == [
        (1, 2, None, "no_pay"), (1, None, 1, "late_or_orphan")]
    same = log(spark, [(1, C, 5), (1, P, 5)])
    assert times(orders.pay_matches(same), "create_ts", "pay_ts") == [(1, 5, 5)]
    assert status(orders.order_status(same)) == [(1, 5, 5, "paid")]
    turned = log(spark, [(1, P, 5), (1, C, 5)])
    assert orders.pay_matches(turned).count() == 0


@pytest.mark.parametrize("seed,step", [(1, 1.0), (2, 20.0), (3, 100.0)])
def test_random_logs_equal_brute_force(spark, seed, step):
    rows = random_events(seed, 500, 10, 40_000, [C, P], step=step)
    df, within = frame(spark, rows, SCHEMA), td(seconds=300)
    creates = [r for r in brute_matches(rows, 300)]
    assert times(orders.pay_matches(df, within), "create_ts", "pay_ts") == [r for r in creates if r[2] is not None]
    assert times(orders.pay_timeouts(df, within), "create_ts") == [r[:2] for r in creates if r[2] is None]
    assert status(orders.order_status(df, within)) == brute_status(rows, 300)


def test_no_task_per_order(spark):
    for df in (orders.pay_matches(log(spark, SAMPLE)), orders.order_status(log(spark, SAMPLE))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "block" in plan.split("hashpartitioning(order_id")[1][:40]


def test_empty(spark):
    none = log(spark, SAMPLE).filter("false")
    for op in (orders.pay_matches, orders.pay_timeouts, orders.order_status, orders.late_payments):
        assert op(none).count() == 0
