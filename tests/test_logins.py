from datetime import timedelta as td

import pytest

from conftest import frame, random_events, secs
from eventide.operators import episodes, logins

SCHEMA = "event_id bigint, user_id bigint, event_type string, s double"
F, S = "fail", "success"


def log(spark, events):
    return frame(spark, [(i, u, kind, float(s)) for i, (u, kind, s) in enumerate(events)], SCHEMA)


def spans(df):
    names = [c for c in df.columns if c not in ("first_ts", "last_ts")]
    return sorted((*[r[c] for c in names], secs(r["first_ts"]), secs(r["last_ts"])) for r in df.collect())


def histories(rows):
    users = {}
    for event_id, user, kind, s in sorted(rows, key=lambda r: (r[3], r[0])):
        users.setdefault(user, []).append((kind, s))
    return users


def brute_pairs(rows, within):
    return sorted((u, a[1], b[1]) for u, h in histories(rows).items() for a, b in zip(h, h[1:])
                  if a[0] == b[0] == F and b[1] - a[1] <= within)


def brute_runs(rows, n, within):
    return sorted((u, n, part[0][1], part[-1][1]) for u, h in histories(rows).items()
                  for part in (h[i:i + n] for i in range(len(h) - n + 1))
                  if all(k == F for k, _ in part) and part[-1][1] - part[0][1] < within)


def brute_episodes(rows, within):
    found = []
    for user, history in histories(rows).items():
        fails = []
        for kind, s in [*history, (S, float("inf"))]:
            if fails and s > fails[0] + within:
                if len(fails) >= 2:
                    found.append((user, len(fails), fails[0], fails[-1]))
                fails = []
            fails = [*fails, s] if kind == F else []
    return sorted(found)


# The login sample's shape: five fails of one user within four seconds
SAMPLE = [(1035, F, 842), (1035, F, 843), (1035, F, 844), (1035, F, 845), (1035, F, 846), (7, S, 842), (7, F, 850)]


def test_sample_answers(spark):
    rows = log(spark, SAMPLE)
    assert spans(logins.fail_pairs(rows)) == [(1035, a, a + 1) for a in (842, 843, 844, 845)]
    assert spans(episodes.fail_episodes(rows)) == [(1035, 2, 845, 846), (1035, 3, 842, 844)]
    assert spans(logins.fail_runs(rows)) == [(1035, 5, 842, 846)]
    assert spans(logins.fail_two_step(rows)) == [(1035, 2, a, a + 1) for a in (842, 843, 844, 845)]


def test_bounds(spark):
    two_apart = log(spark, [(1, F, 0), (1, F, 2)])
    assert spans(logins.fail_pairs(two_apart)) == [(1, 0, 2)]  # inclusive
    assert spans(logins.fail_two_step(two_apart)) == []  # strict
    assert spans(episodes.fail_episodes(two_apart)) == [(1, 2, 0, 2)]
    assert spans(logins.fail_pairs(log(spark, [(1, F, 0), (1, F, 2.000001)]))) == []


def test_success_breaks_and_cancels(spark):
    assert spans(logins.fail_pairs(log(spark, [(1, F, 0), (1, S, 1), (1, F, 2)]))) == []
    # at the episode's last instant it still cancels, after it no more
    assert spans(episodes.fail_episodes(log(spark, [(1, F, 0), (1, F, 1), (1, S, 2)]))) == []
    assert spans(episodes.fail_episodes(log(spark, [(1, F, 0), (1, F, 1), (1, S, 2.5)]))) == [(1, 2, 0, 1)]


def test_equal_times_are_ordered_by_id(spark):
    assert spans(logins.fail_pairs(log(spark, [(1, F, 5), (1, S, 5), (1, F, 5)]))) == []
    assert spans(logins.fail_pairs(log(spark, [(1, F, 5), (1, F, 5), (1, S, 5)]))) == [(1, 5, 5)]


@pytest.mark.parametrize("seed,step", [(1, 1.0), (2, 0.25), (3, 5.0)])
def test_random_logs_equal_brute_force(spark, seed, step):
    rows = random_events(seed, 600, 8, 900, [F, F, F, S], step=step)
    df = frame(spark, rows, SCHEMA)
    assert spans(logins.fail_pairs(df)) == brute_pairs(rows, 2)
    assert spans(logins.fail_runs(df, 3, td(seconds=5))) == brute_runs(rows, 3, 5)
    assert spans(episodes.fail_episodes(df)) == brute_episodes(rows, 2)


def test_long_sessions_cross_chunks(spark):
    # One user fails without end: a single session over many chunks and time blocks.
    rows = random_events(9, 1500, 3, 900, [F], hot_share=0.8, step=0.5)
    rows += [(10_000 + i, 1, S, float(s)) for i, s in enumerate((100.25, 333.25, 700.25))]
    df = frame(spark, rows, SCHEMA)
    want = brute_episodes(rows, 2)
    assert len(want) > 300
    assert spans(episodes.fail_episodes(df)) == want


def test_long_sparse_sessions(spark):
    rows = [(i, 5, F, i * 1.5) for i in range(400)] + [(1000 + i, 6, F, i * 2.0) for i in range(300)]
    assert spans(episodes.fail_episodes(frame(spark, rows, SCHEMA))) == brute_episodes(rows, 2)


def test_no_task_per_user(spark):
    rows = log(spark, SAMPLE)
    for df in (logins.fail_pairs(rows), logins.fail_runs(rows)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(user_id" in plan and "block" in plan.split("hashpartitioning(user_id")[1][:40]


def test_empty(spark):
    none = log(spark, SAMPLE).filter("false")
    assert logins.fail_pairs(none).count() == 0
    assert logins.fail_runs(none).count() == 0
    assert episodes.fail_episodes(none).count() == 0


def test_a_run_needs_two_fails(spark):
    with pytest.raises(ValueError):
        logins.fail_runs(log(spark, SAMPLE), 1)
