"""Keys in groups: the rows of each key's own processor, from far fewer calls to the state store."""

import random

import pandas as pd
import pytest

from conftest import frame
from eventide.streaming import keyed, runner
from test_streaming import Clock, Held

HOUR = 3_600_000_000


class Counted(Held):
    def __init__(self):
        self.calls = 0

    def getMapState(self, name, key_schema, schema):
        class Map(Held.Map):
            def getValue(own, key):
                self.calls += 1
                return dict.__getitem__(own, key)

            def updateValue(own, key, value):
                self.calls += 1
                own[key] = value

            def removeKey(own, key):
                self.calls += 1
                del own[key]
        return Map()


def batches(seed, kinds, users=40, n=900):
    rng = random.Random(seed)
    rows = [(rng.randrange(24 * 60) * 60_000_000, i, rng.choice(kinds), rng.choice([0, rng.randrange(users)])) for i in range(n)]
    return [sorted(rows[i::3], key=lambda r: r[1]) for i in range(3)]


def shown(tables):
    return sorted((tuple(None if pd.isna(v) else v for v in r) for t in tables for r in t.astype(object).itertuples(index=False)), key=str)


RULES = [(lambda: keyed.FailEpisodes(HOUR), ["fail", "fail", "success"]), (lambda: keyed.FailRuns(3, 2 * HOUR), ["fail", "fail", "success"]),
         (lambda: keyed.FirstPay(HOUR), ["create", "pay"]), (lambda: keyed.OrderStatus(HOUR), ["create", "pay"]),
         (lambda: keyed.OneToOne(HOUR, 2 * HOUR), ["pay", "receipt"])]


@pytest.mark.parametrize("make, kinds", RULES)
@pytest.mark.parametrize("stretch", [7, keyed.STRETCH_ROWS])
def test_same_rows_as_one_key_at_a_time(monkeypatch, make, kinds, stretch):
    monkeypatch.setattr(keyed, "STRETCH_ROWS", stretch)
    monkeypatch.setattr(keyed, "OUT_ROWS", 10)
    parts = batches(5, kinds)
    grouped, want, got = keyed.InGroups(make()), [], []
    grouped.init(Counted())
    alone = {u: make() for u in range(40)}
    for one in alone.values():
        one.init(Held())
    for until, part in zip((6, 15, 99), parts):
        clock = Clock(until * 3_600_000)
        late = [r for r in part if r[0] > grouped_at(until)]
        pdf = pd.DataFrame(late, columns=["t", "event_id", "what", grouped.rule.keys[0]])
        list(grouped.handleInputRows((0,), iter([pdf.iloc[:50], pdf.iloc[50:]]), Clock(0)))
        got += grouped.handleExpiredTimer((0,), clock, None)
        for user, one in alone.items():
            own = pdf[pdf[one.keys[0]] == user]
            if len(own):
                list(one.handleInputRows((user,), iter([own]), Clock(0)))
            want += one.handleExpiredTimer((user,), clock, None)
    assert len(want) > 0 and shown(got) == shown(want)
    assert not grouped.pending and not grouped.memory.exists()


def grouped_at(until):
    return {6: -1, 15: 6 * HOUR, 99: 15 * HOUR}[until]


def test_few_calls_and_a_stretch_at_a_time():
    state = Counted()
    processor = keyed.InGroups(keyed.FailEpisodes(HOUR))
    processor.init(state)
    n = 20 * keyed.STRETCH_ROWS
    pdf = pd.DataFrame({"t": [(i * 7919) % n * 1_000_000 for i in range(n)], "event_id": range(n), "what": "fail", "user_id": range(n)})
    list(processor.handleInputRows((0,), iter(pdf.iloc[i:i + 10_000] for i in range(0, n, 10_000)), Clock(0)))
    assert state.calls == 20
    list(processor.handleExpiredTimer((0,), Clock(1_000 * keyed.STRETCH_ROWS // 2), None))
    assert state.calls == 23  # one stretch read, removed and its rest put back
    list(processor.handleExpiredTimer((0,), Clock(1_000 * n + 4_000_000), None))
    assert state.calls == 23 + 40 and not processor.pending and not processor.memory.exists()


class Looks(int):
    """A limit that counts how often a create is held against it."""
    taken = 0

    def __rsub__(self, t):
        Looks.taken += 1
        return t - int(self)

    def __le__(self, age):
        Looks.taken += 1
        return int(self) <= age

    def __radd__(self, t):
        Looks.taken += 1
        return t + int(self)


def test_creates_of_one_order_are_not_all_looked_at_for_each_row():
    limit, n = 1_000, 3_000  # a create each microsecond, a thousand of them open
    Looks.taken = 0
    processor = keyed.InGroups(keyed.FirstPay(Looks(limit)))
    processor.init(Counted())
    pdf = pd.DataFrame({"t": range(n), "event_id": range(n), "what": "create", "order_id": 7})
    pdf.loc[2_500, "what"] = "pay"
    list(processor.handleInputRows((0,), iter([pdf]), Clock(0)))
    out = pd.concat(processor.handleExpiredTimer((0,), Clock(100), None))
    paid = out[out["status"] == "paid"]
    assert sorted(paid["create_id"]) == list(range(1_501, 2_500)) and set(paid["pay_t"]) == {2_500}
    assert sorted(out[out["status"] == "no_pay"]["create_id"]) == [*range(1_501), *range(2_501, n)]
    assert Looks.taken < n and not processor.memory.exists()


def test_small_stretches_are_put_together():
    processor = keyed.InGroups(keyed.EqualWindows(["k"], HOUR))
    processor.init(Counted())
    for i in range(300):
        pdf = pd.DataFrame({"t": [HOUR + i, 2 * HOUR + i], "event_id": [1, -1], "what": "", "k": "a"})
        list(processor.handleInputRows((0,), iter([pdf]), Clock(0)))
        assert len(processor.pending) <= keyed.MANY
    out = pd.concat(processor.handleExpiredTimer((0,), Clock(10 * HOUR // 1000), None))
    assert list(out["cnt"]) == [*range(1, 301), *range(299, 0, -1)]


def test_a_cap_holds_no_more_than_is_missing_of_each_key():
    processor = keyed.InGroups(keyed.ClickCap(5))
    processor.init(Counted())
    pdf = pd.DataFrame({"t": range(2000, 0, -1), "event_id": range(2000), "what": "86400000000", "user_id": [1, 2] * 1000, "ad_id": 1, "day": None})
    list(processor.handleInputRows((0,), iter([pdf]), Clock(0)))
    assert sum(processor.index.get()[2]) == 10
    out = pd.concat(processor.handleExpiredTimer((0,), Clock(2), None))
    assert sorted(out["status"]) == [keyed.BLACKLISTED] * 2 + [keyed.KEPT] * 8
    list(processor.handleInputRows((0,), iter([pdf.assign(t=pdf["t"] + 10_000)]), Clock(0)))
    assert not processor.pending and not processor.index.exists()


def test_nulls_and_large_ids(spark, tmp_path):
    big = (1 << 60) + 1
    rows = [(big, 5, "signup", 0.0), (None, 6, "signup", 1.0), (big + 2, 5, "purchase", 2.0), (7, None, "signup", 3.0), (8, 5, "signup", None)]
    df = frame(spark, rows, "event_id bigint, user_id bigint, event_type string, s double").selectExpr("*", "'{}' as props")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    from eventide.sources import tables
    play = runner.Replay(runner.stream_session(spark), str(tmp_path / "in"), ["signup", "purchase"], pattern="*.parquet")
    got = runner.collect_appended(play, keyed.order_status(tables.orders(play.events)), "nulls").filter("order_id is null or order_id > 0")
    assert sorted(map(tuple, got.select("order_id", "create_id", "pay_id", "status").collect()), key=str) == sorted(
        [(5, big, big + 2, "paid"), (6, None, None, "no_pay"), (None, 7, None, "no_pay")], key=str)
