"""Keyed processors for rules that depend on the order of a key's events.

A micro-batch has no order, and rows may arrive late. Each processor therefore holds a key's rows until
the watermark has passed them and then applies its rule in (time, id) order, so the result does not
depend on how the input was cut into batches. One timer is kept, at the next time something can happen.

`InOrder` does so for one key. The streams below run its rules with `InGroups`, which keeps the rows of many keys in
common entries: a call to the state store costs far more than a row, and most keys have few rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from datetime import timedelta
from functools import reduce
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.eventtime import epoch_micros, local_day, local_day_end, micros
from eventide.operators import reconcile
from eventide.operators.episodes import MIN_FAILS
from eventide.operators.fraud import DAY_ZONE, DEFAULT_CAP
from eventide.operators.logins import known_users
from eventide.operators.orders import LATE, NO_PAY, PAID, PAY_WITHIN, creates_and_pays
from eventide.operators.reconcile import MATCHED, PAY_ONLY, RECEIPT_ONLY
from eventide.operators.windows import panes_per_window
from eventide.streaming.joins import nameless

KEPT, BLACKLISTED = "kept", "blacklisted"


class InOrder(StatefulProcessor):
    """Holds rows (t, event_id, what) back until the watermark and hands them to `step` in order.

    Rows wait in slices of time, one map entry each. A small index tells each slice's first time and size, so that a
    timer reads the due slices alone, however many rows wait behind them.

    Subclasses name their memory's schema and give `step`, `due` and `settle`; memory is None or a
    tuple, `due` the time its key must be looked at again even without a new row. `room` may tell how
    many waiting rows can still matter, given the memory: only the earliest so many are held.
    """

    memory_schema: str
    keys: list[str]
    columns: list[str]
    #: Microseconds of a slice.
    slice_width: int = 60_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", "slice bigint", "t array<bigint>, event_id array<bigint>, what array<string>")
        self.index = handle.getValueState("index", "slices array<bigint>, firsts array<bigint>, sizes array<bigint>")
        self.memory = handle.getValueState("memory", self.memory_schema)
        self.alarm = handle.getValueState("alarm", "at bigint")

    def step(self, memory, t: int, event_id: int, what: str, out: list):
        raise NotImplementedError

    def due(self, memory) -> int | None:
        raise NotImplementedError

    def settle(self, memory, out: list):
        """Called when the watermark has reached `due`, again and again until it has not."""
        raise NotImplementedError

    def settled(self, memory, upto: int, out: list):
        """The memory when all that is due by `upto` has been settled."""
        while (due := self.due(memory)) is not None and due <= upto:
            memory = self.settle(memory, out)
        return memory

    def room(self, memory) -> int | None:
        return None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        room = self.room(self._remembered())
        slices = self._index()
        for pdf in rows:
            if room == 0:
                continue
            new: dict[int, list[tuple]] = {}
            for item in zip(pdf["t"].tolist(), pdf["event_id"].tolist(), pdf["what"].tolist()):
                new.setdefault(item[0] // self.slice_width, []).append(item)
            for part, items in new.items():
                self._put(slices, part, self._rows(slices, part) + items)
            if room is not None:
                self._trim(slices, room)
        self._keep_index(slices)
        if slices:
            self._wake(min(first for first, _ in slices.values()))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.clear()
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        memory, slices = self._remembered(), self._index()
        out: list = []
        for part in sorted(part for part, (first, _) in slices.items() if first <= upto):
            waiting = sorted(self._rows(slices, part))
            done = 0
            for t, event_id, what in waiting:
                if t > upto:
                    break
                done += 1
                memory = self.step(memory, t, event_id, what, out)
            self._put(slices, part, waiting[done:])
        memory = self.settled(memory, upto, out)
        due = self.due(memory)
        room = self.room(memory)
        if room is not None:
            self._trim(slices, room)
        self._keep_index(slices)
        if memory is None:
            self.memory.clear()
        else:
            self.memory.update(memory)
        times = [first for first, _ in slices.values()] + ([] if due is None else [due])
        if times:
            self._wake(min(times))
        if out:
            table = pd.DataFrame(out, columns=self.columns).astype(dict.fromkeys(self._longs(), "Int64"))
            for i, (name, value) in enumerate(zip(self.keys, key)):
                table.insert(i, name, value)
            yield self.shown(table)

    def close(self) -> None:
        pass

    def shown(self, table: pd.DataFrame) -> pd.DataFrame:
        return table

    def _longs(self) -> list[str]:
        return [c for c in self.columns if c != "status"]

    def _remembered(self):
        return tuple(self.memory.get()) if self.memory.exists() else None

    def _index(self) -> dict[int, tuple[int, int]]:
        """First time and size of each slice."""
        if not self.index.exists():
            return {}
        slices, firsts, sizes = self.index.get()
        return dict(zip(slices, zip(firsts, sizes)))

    def _keep_index(self, slices: dict[int, tuple[int, int]]) -> None:
        if slices:
            self.index.update((list(slices), [f for f, _ in slices.values()], [n for _, n in slices.values()]))
        elif self.index.exists():
            self.index.clear()

    def _rows(self, slices: dict, part: int) -> list[tuple]:
        return list(zip(*self.pending.getValue((part,)))) if part in slices else []

    def _put(self, slices: dict, part: int, rows: list[tuple]) -> None:
        if rows:
            self.pending.updateValue((part,), tuple(map(list, zip(*rows))))
            slices[part] = (min(row[0] for row in rows), len(rows))
        elif slices.pop(part, None):
            self.pending.removeKey((part,))

    def _trim(self, slices: dict, room: int) -> None:
        """Lets go of the last rows beyond `room`: rows yet to come can only push them further back."""
        extra = sum(size for _, size in slices.values()) - room
        for part in sorted(slices, reverse=True):
            if extra <= 0:
                return
            size = slices[part][1]
            self._put(slices, part, sorted(self._rows(slices, part))[:size - extra] if size > extra else [])
            extra -= size

    def _wake(self, t: int) -> None:
        at = -(-t // 1000)  # timers are in milliseconds
        if self.alarm.exists():
            planned = self.alarm.get()[0]
            if planned <= at:
                return
            self.handle.deleteTimer(planned)
        self.handle.registerTimer(at)
        self.alarm.update((at,))


#: Slices in the length of a rule.
_SLICES = 16


class FailEpisodes(InOrder):
    memory_schema = "first bigint, last bigint, n bigint"
    keys = ["user_id"]
    columns = ["first_t", "last_t", "n"]

    def __init__(self, length: int):
        self.length = length
        self.slice_width = max(1, length // _SLICES)

    def step(self, memory, t, event_id, what, out):
        if memory and t > memory[0] + self.length:
            memory = self.settle(memory, out)
        if what != "fail":
            return None
        return (memory[0], t, memory[2] + 1) if memory else (t, t, 1)

    def due(self, memory):
        return memory[0] + self.length if memory else None

    def settle(self, memory, out):
        if memory[2] >= MIN_FAILS:
            out.append(memory)
        return None


class FailRuns(InOrder):
    """`n` fails in a row whose first and last are at most `length` apart; memory holds the times of the last fails."""

    memory_schema = "times array<bigint>"
    keys = ["user_id"]
    columns = ["first_t", "last_t", "n"]

    def __init__(self, n: int, length: int):
        self.n, self.length = n, length
        self.slice_width = max(1, length // _SLICES)

    def step(self, memory, t, event_id, what, out):
        if what != "fail":
            return None
        times = [*(memory[0] if memory else []), t][-self.n:]
        if len(times) == self.n and t - times[0] <= self.length:
            out.append((times[0], t, self.n))
        # Only the last n - 1 fails matter to the next, and of those none that lies too far back.
        return ([x for x in times if x >= t - self.length],)

    def due(self, memory):
        # One microsecond on, no later fail can be in a run with the newest.
        return memory[0][-1] + self.length + 1 if memory else None

    def settle(self, memory, out):
        return None


class FirstPay(InOrder):
    """The first pay after each create, if less than `limit` after it; memory holds the creates still open, in order of
    time. It is changed in place, and looked through at a pay or a timer only: an order may have many creates open."""

    memory_schema = "ids array<bigint>, times array<bigint>"
    keys = ["order_id"]
    columns = ["create_id", "create_t", "pay_t", "status"]

    def __init__(self, limit: int):
        self.limit = limit
        self.slice_width = max(1, limit // _SLICES)

    def step(self, memory, t, event_id, what, out):
        if what == "create":
            ids, times = memory or ([], [])
            ids.append(event_id)
            times.append(t)
            return (ids, times)
        memory = self.settled(memory, t, out)
        for create_id, create_t in zip(*memory) if memory else ():
            out.append((create_id, create_t, t, PAID))
        return None

    def due(self, memory):
        return memory[1][0] + self.limit if memory else None

    def settle(self, memory, out):
        return self.settled(memory, memory[1][0] + self.limit, out)

    def settled(self, memory, upto, out):
        """Creates that a pay at `upto` comes too late for are timed out."""
        if not memory:
            return None
        ids, times = memory
        gone = bisect_right(times, upto - self.limit)
        for create_id, create_t in zip(ids[:gone], times[:gone]):
            out.append((create_id, create_t, None, NO_PAY))
        return (ids[gone:], times[gone:]) if gone < len(ids) else None


class OrderStatus(InOrder):
    memory_schema = "create_id bigint, create_t bigint"
    keys = ["order_id"]
    columns = ["create_id", "create_t", "pay_id", "pay_t", "status"]

    def __init__(self, limit: int):
        self.limit = limit
        self.slice_width = max(1, limit // _SLICES)

    def step(self, memory, t, event_id, what, out):
        if memory and (what == "create" or t > memory[1] + self.limit):
            memory = self.settle(memory, out)
        if what == "create":
            return (event_id, t)
        out.append((*memory, event_id, t, PAID) if memory else (None, None, event_id, t, LATE))
        return None

    def due(self, memory):
        return memory[1] + self.limit if memory else None

    def settle(self, memory, out):
        out.append((*memory, None, None, NO_PAY))
        return None


class OneToOne(InOrder):
    """Each pay is used by one receipt at most. One row waits at a time: two rows of different sides
    within reach match, and a second row of the waiting side takes the first one's place."""

    memory_schema = "side string, id bigint, t bigint"
    keys = ["tx_id"]
    columns = ["pay_id", "pay_t", "receipt_id", "receipt_t", "status"]

    def __init__(self, early: int, late: int):
        # how long a row of each side waits for the other side
        self.wait = {"pay": late, "receipt": early}
        self.slice_width = max(1, max(early, late) // _SLICES)

    def step(self, memory, t, event_id, what, out):
        if memory and (memory[0] == what or t > memory[2] + self.wait[memory[0]]):
            memory = self.settle(memory, out)
        if memory is None:
            return (what, event_id, t)
        pay, receipt = ((event_id, t), memory[1:]) if what == "pay" else (memory[1:], (event_id, t))
        out.append((*pay, *receipt, MATCHED))
        return None

    def due(self, memory):
        return memory[2] + self.wait[memory[0]] if memory else None

    def settle(self, memory, out):
        side, row, none = memory[0], memory[1:], (None, None)
        out.append((*row, *none, PAY_ONLY) if side == "pay" else (*none, *row, RECEIPT_ONLY))
        return None


class ClickCap(InOrder):
    """Key (user, ad, local day), so a count ends with its day and needs no reset. Once the cap is reached no click of
    the key is held any more, and before that no more clicks than are missing."""

    memory_schema = "clicks bigint, day_end bigint"
    keys = ["user_id", "ad_id", "day"]
    columns = ["event_id", "t", "status"]
    slice_width = 3_600_000_000

    def __init__(self, cap: int):
        self.cap = cap

    def step(self, memory, t, event_id, what, out):
        clicks, day_end = (memory[0] + 1, memory[1]) if memory else (1, int(what))
        if clicks < self.cap:
            out.append((event_id, t, KEPT))
        elif clicks == self.cap:
            out.append((event_id, t, BLACKLISTED))
        return (clicks, day_end)

    def room(self, memory):
        return self.cap - memory[0] if memory and memory[0] < self.cap else 0 if memory else self.cap

    def due(self, memory):
        return memory[1] if memory else None

    def settle(self, memory, out):
        return None

    def shown(self, table):
        # A watermark can be carried on from here only by a timestamp.
        table["ts"] = pd.to_datetime(table.pop("t"), unit="us")
        return table[[*self.keys, "event_id", "ts", "status"]]


class EqualWindows(InOrder):
    """Runs of windows with one count, from the changes of the count: t is where a run may begin, event_id the change.

    A run is let out when the count has changed, so no run is cut by a micro-batch."""

    memory_schema = "since bigint, cnt bigint, at bigint, next_cnt bigint"
    columns = ["since", "until", "cnt"]

    def __init__(self, keys: list[str], size: int):
        self.keys = keys
        self.slice_width = max(1, size // _SLICES)

    def step(self, memory, t, event_id, what, out):
        since, cnt, at, after = memory or (t, 0, t, 0)
        if t > at:
            since, cnt, at, after = self._changed((since, cnt, at, after), out) or (t, 0, t, 0)
        return (since, cnt, t, after + event_id)

    def _changed(self, memory, out):
        since, cnt, at, after = memory
        if cnt == after:
            return memory if cnt else None
        if cnt:
            out.append((since, at, cnt))
        return (at, after, at, after) if after else None

    def due(self, memory):
        return memory[2] if memory and memory[1] != memory[3] else None

    def settle(self, memory, out):
        return self._changed(memory, out)


#: Groups of keys. A group is served by one task at a time, and a micro-batch touches the state of those it has rows for.
GROUPS = 256
#: Rows sorted at once before they are stored, and rows of a stored stretch.
RUN_ROWS, STRETCH_ROWS = 1 << 18, 1 << 12
#: Stretches from which on a group's small ones are put together.
MANY = 64
#: Rows let out at once.
OUT_ROWS = 1 << 16
#: An id that is null, as a number.
NO_ID = -(1 << 63)


class InGroups(StatefulProcessor):
    """Runs a rule of `InOrder` for the keys of a group: rows (t, event_id, what, keys) wait in stretches of consecutive
    times, one map entry each, and are stepped through in order, a stretch at a time.

    A timer reads the stretches that begin by then. Rows held in memory are those of a run (at input) or of the stretches
    that overlap (at a timer), however many wait, and one memory for each key that is open.
    """

    def __init__(self, rule: InOrder):
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", "stretch bigint", "held binary")
        self.index = handle.getValueState("index", "stretches array<bigint>, firsts array<bigint>, sizes array<bigint>")
        self.memory = handle.getValueState("memory", "held binary")
        self.alarm = handle.getValueState("alarm", "at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stretches = InOrder._index(self)
        limited = self.rule.room(None) is not None
        memories = self._memories() if limited else {}
        run: list[tuple] = []
        for pdf in rows:
            keys = zip(*(_plain(pdf[k]) for k in self.rule.keys))
            run += zip(pdf["t"].tolist(), pdf["event_id"].tolist(), pdf["what"].tolist(), keys)
            if len(run) >= RUN_ROWS:
                self._hold(stretches, run, memories if limited else None)
                run = []
        if len(stretches) >= MANY:
            for small in [n for n, (_, size) in stretches.items() if 2 * size <= STRETCH_ROWS]:
                run += self._taken(stretches, small)
        self._hold(stretches, run, memories if limited else None)
        InOrder._keep_index(self, stretches)
        if stretches:
            InOrder._wake(self, min(first for first, _ in stretches.values()))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.clear()
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        memories, stretches = self._memories(), InOrder._index(self)
        step, out, since = self.rule.step, [], 0
        waiting: list[tuple] = []
        due = sorted((first, n) for n, (first, _) in stretches.items() if first <= upto)
        for (_, n), (after, _) in zip(due, [*due[1:], (upto + 1, None)]):
            waiting += self._taken(stretches, n)
            waiting.sort()
            done = bisect_right(waiting, after - 1, key=itemgetter(0))  # the later stretches have no row before these
            for t, event_id, what, own in waiting[:done]:
                found: list = []
                memory = step(memories.get(own), t, event_id, what, found)
                if memory is None:
                    memories.pop(own, None)
                else:
                    memories[own] = memory
                out += [(own, row) for row in found]
            del waiting[:done]
            since += done
            if since >= OUT_ROWS:
                self._settle(memories, after - 1, out)
                since = 0
            if len(out) >= OUT_ROWS:
                yield self._table(out)
                out = []
        self._hold(stretches, waiting)
        next_due = self._settle(memories, upto, out)
        InOrder._keep_index(self, stretches)
        self._remember(memories)
        times = [first for first, _ in stretches.values()] + ([] if next_due is None else [next_due])
        if times:
            InOrder._wake(self, min(times))
        for at in range(0, len(out), OUT_ROWS):
            yield self._table(out[at:at + OUT_ROWS])

    def close(self) -> None:
        pass

    def _settle(self, memories: dict, upto: int, out: list) -> int | None:
        """Settles what is due, all rows up to then being stepped through; the next time that something is."""
        soonest = None
        for own, memory in list(memories.items()):
            due = self.rule.due(memory)
            if due is not None and due <= upto:
                found: list = []
                memory = self.rule.settled(memory, upto, found)
                out += [(own, row) for row in found]
                due = self.rule.due(memory)
            if memory is None:
                del memories[own]
            else:
                memories[own] = memory
            if due is not None and (soonest is None or due < soonest):
                soonest = due
        return soonest

    def _hold(self, stretches: dict, run: list[tuple], memories: dict | None = None) -> None:
        """Stores rows in stretches; with the keys' memories only as many rows of a key as can still matter."""
        run.sort()
        if memories is not None:
            rooms: dict = {}
            kept = []
            for row in run:
                room = rooms[row[3]] if row[3] in rooms else self.rule.room(memories.get(row[3]))
                rooms[row[3]] = room - 1
                if room > 0:
                    kept.append(row)
            run = kept
        free = max(stretches, default=-1) + 1
        for n, at in enumerate(range(0, len(run), STRETCH_ROWS), free):
            part = run[at:at + STRETCH_ROWS]
            t, event_id, what, keys = zip(*part)
            self.pending.updateValue((n,), (_packed([t, event_id, what, *zip(*keys)]),))
            stretches[n] = (part[0][0], len(part))

    def _taken(self, stretches: dict, n: int) -> list[tuple]:
        t, event_id, what, *keys = _unpacked(self.pending.getValue((n,))[0])
        self.pending.removeKey((n,))
        del stretches[n]
        return list(zip(t, event_id, what, zip(*keys)))

    def _memories(self) -> dict[tuple, tuple]:
        if not self.memory.exists():
            return {}
        columns, n = _unpacked(self.memory.get()[0]), len(self.rule.keys)
        return dict(zip(zip(*columns[:n]), zip(*columns[n:])))

    def _remember(self, memories: dict[tuple, tuple]) -> None:
        if memories:
            self.memory.update((_packed([*zip(*memories), *zip(*memories.values())]),))
        elif self.memory.exists():
            self.memory.clear()

    def _table(self, out: list[tuple]) -> pd.DataFrame:
        table = pd.DataFrame(dict(zip(self.rule.keys, (pd.Series(c, dtype=object) for c in zip(*(own for own, _ in out))))))
        longs = self.rule._longs()
        for name, column in zip(self.rule.columns, zip(*(row for _, row in out))):
            table[name] = pd.array([None if x == NO_ID else x for x in column], dtype="Int64") if name in longs else list(column)
        return self.rule.shown(table)


def _plain(column: pd.Series) -> list:
    """A key column's values. A group's keys agree in what is null, so a column with a null holds nothing else."""
    return [None] * len(column) if column.isna().any() else column.tolist()


def _packed(columns: list) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table([pa.array(list(c)) for c in columns], [str(i) for i in range(len(columns))])
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(held: bytes) -> list[list]:
    return [c.to_pylist() for c in pa.ipc.open_stream(bytes(held)).read_all().columns]


def _in_groups(rows: DataFrame, rule: InOrder, schema: str, **options) -> DataFrame:
    """The rule's rows of the columns (its keys, t, event_id, what), which carry a watermark on `ts`. Keys with distinct
    nulls are of distinct groups. A row without a time has no place in an order, and belongs to none."""
    nulls = reduce(lambda a, b: a * 2 + b, (F.col(k).isNull().cast("long") for k in rule.keys))
    group = F.pmod(F.xxhash64(*rule.keys), F.lit(GROUPS)) + nulls * GROUPS
    ready = (rows.filter(F.col("t").isNotNull()).withColumn("event_id", F.coalesce("event_id", F.lit(NO_ID)))
             .withColumn("what", F.coalesce("what", F.lit(""))).withColumn("key_group", group))
    return ready.groupBy("key_group").transformWithStateInPandas(
        InGroups(rule), schema, outputMode="Append", timeMode="EventTime", **options)


def _run(rows: DataFrame, rule: InOrder, key_types: str, values: str, delay: str) -> DataFrame:
    ready = rows.withWatermark("ts", delay).withColumn("t", epoch_micros("ts"))
    return _in_groups(ready, rule, f"{key_types}, {values}")


def fail_episodes(logins: DataFrame, within: timedelta = timedelta(seconds=2),
                  delay: str = "5 seconds") -> DataFrame:
    rows = known_users(logins).select("ts", "user_id", "event_id", F.col("event_type").alias("what"))
    return (_run(rows, FailEpisodes(micros(within)), "user_id bigint",
                 "first_t bigint, last_t bigint, n bigint", delay)
            .select("user_id", F.timestamp_micros("first_t").alias("first_ts"),
                    F.timestamp_micros("last_t").alias("last_ts"), "n"))


def _fail_runs(logins: DataFrame, n: int, length: int, delay: str) -> DataFrame:
    rows = known_users(logins).select("ts", "user_id", "event_id", F.col("event_type").alias("what"))
    return (_run(rows, FailRuns(n, length), "user_id bigint", "first_t bigint, last_t bigint, n bigint", delay)
            .select("user_id", F.timestamp_micros("first_t").alias("first_ts"), F.timestamp_micros("last_t").alias("last_ts"), "n"))


def fail_pairs(logins: DataFrame, within: timedelta = timedelta(seconds=2), delay: str = "5 seconds") -> DataFrame:
    return _fail_runs(logins, 2, micros(within), delay).drop("n")


def fail_runs(logins: DataFrame, n: int = 5, within: timedelta = timedelta(seconds=5), delay: str = "5 seconds") -> DataFrame:
    if n < 2:
        raise ValueError("a run has at least two fails")
    return _fail_runs(logins, n, micros(within) - 1, delay)


def first_pays(orders: DataFrame, within: timedelta = PAY_WITHIN, delay: str = "0 seconds") -> DataFrame:
    """Matches and timeouts in one stream, told apart by `status`."""
    rows = creates_and_pays(orders).select("ts", "order_id", "event_id", F.col("event_type").alias("what"))
    return (_run(rows, FirstPay(micros(within)), "order_id bigint", "create_id bigint, create_t bigint, pay_t bigint, status string", delay)
            .select("order_id", "create_id", F.timestamp_micros("create_t").alias("create_ts"),
                    F.timestamp_micros("pay_t").alias("pay_ts"), "status"))


def order_status(orders: DataFrame, within: timedelta = PAY_WITHIN, delay: str = "0 seconds") -> DataFrame:
    rows = creates_and_pays(orders).select("ts", "order_id", "event_id", F.col("event_type").alias("what"))
    return (_run(rows, OrderStatus(micros(within)), "order_id bigint",
                 "create_id bigint, create_t bigint, pay_id bigint, pay_t bigint, status string", delay)
            .select("order_id", "create_id", F.timestamp_micros("create_t").alias("create_ts"), "pay_id",
                    F.timestamp_micros("pay_t").alias("pay_ts"), "status"))


def reconcile_one_to_one(pays: DataFrame, receipts: DataFrame, early: timedelta = reconcile.EARLY,
                         late: timedelta = reconcile.LATE, delay: str = "0 seconds") -> DataFrame:
    """Reconciliation for transaction ids that repeat: every row is used once. A row without an id has
    no partner."""
    rows = (pays.select(F.col("pay_ts").alias("ts"), "tx_id", F.col("pay_id").alias("event_id"),
                        F.lit("pay").alias("what"))
            .unionByName(receipts.select(F.col("receipt_ts").alias("ts"), "tx_id",
                                         F.col("receipt_id").alias("event_id"), F.lit("receipt").alias("what"))))
    tx_type = rows.schema["tx_id"].dataType.simpleString()
    settled = (_run(rows.filter(F.col("tx_id").isNotNull()), OneToOne(micros(early), micros(late)), f"tx_id {tx_type}",
                 "pay_id bigint, pay_t bigint, receipt_id bigint, receipt_t bigint, status string", delay)
            .select("tx_id", "pay_id", F.timestamp_micros("pay_t").alias("pay_ts"), "receipt_id",
                    F.timestamp_micros("receipt_t").alias("receipt_ts"), "status"))
    return settled.unionByName(nameless(pays, receipts))


def capped_clicks(clicks: DataFrame, cap: int = DEFAULT_CAP, zone: str = DAY_ZONE,
                  delay: str = "0 seconds") -> DataFrame:
    """Kept clicks and blacklist alerts in one stream, told apart by `status`."""
    if cap < 2:
        raise ValueError("cap must be at least 2")
    day = local_day("ts", zone)
    day_end = epoch_micros(local_day_end(day, zone))
    rows = clicks.select("ts", "user_id", "ad_id", "event_id", day.alias("day"),
                         day_end.cast("string").alias("what"))
    ready = rows.withWatermark("ts", delay).withColumn("t", epoch_micros("ts"))
    capped = _in_groups(ready, ClickCap(cap), "user_id bigint, ad_id bigint, day date, event_id bigint, ts timestamp, status string",
                        eventTimeColumnName="ts")
    return capped.select("user_id", "ad_id", "day", "event_id", "ts", "status")


def hop_runs(events: DataFrame, keys: list[str], size: timedelta, slide: timedelta, delay: str | None = None) -> DataFrame:
    """Sliding counts as runs of equal windows, the streaming form of `windows.hop_runs`.

    Rows are counted per (key, pane) first; a closed pane sends two changes of the count, whatever size / slide is. Give
    no delay if the events carry a watermark already, as those of `capped_clicks` do.
    """
    per_window, step = panes_per_window(size, slide), F.lit(micros(slide)).cast("long")
    timed = events if delay is None else events.withWatermark("ts", delay)
    panes = (timed.groupBy(F.window("ts", f"{micros(slide)} microseconds").alias("pane"), *keys)
             .agg(F.count(F.lit(1)).alias("n")))
    at = epoch_micros("pane.end")
    changes = F.array(F.struct(at.alias("t"), F.col("n").alias("event_id")),
                      F.struct((at + per_window * step).alias("t"), (-F.col("n")).alias("event_id")))
    moves = (panes.select(F.window_time("pane").alias("ts"), *keys, F.explode(changes).alias("c"))
             .select("ts", *keys, "c.t", "c.event_id", F.lit("").alias("what")))
    kinds = dict(moves.dtypes)
    runs = _in_groups(moves, EqualWindows(keys, micros(size)),
                      ", ".join([f"{k} {kinds[k]}" for k in keys] + ["since bigint", "until bigint", "cnt bigint"]))
    return runs.select(*keys, F.timestamp_micros("since").alias("first_window_end"),
                       F.timestamp_micros(F.col("until") - step).alias("last_window_end"),
                       F.call_function("div", F.col("until") - F.col("since"), step).alias("windows"), "cnt")
