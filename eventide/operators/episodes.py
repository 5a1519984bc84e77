"""Login-fail episodes: a fail opens an episode that lasts `within`; later fails inside it belong to
it; a success inside cancels it; the next fail after its end opens a new one.

Where an episode starts depends on where the one before it started, so the rule is sequential. It
still does not need a user's whole history in one task:

1. A success, or more than `within` without a fail, always clears the state. Between two such points
   lies a *session* of fails, found per (user, time block) from neighbouring rows.
2. A session no longer than `within` is a single episode: a plain aggregate. Nearly all are. The
   success that ends a session cancels its last episode if it falls inside it.
3. A longer session is cut into chunks of time. From any row the next episode starts within twice
   `within`, so a chunk that also sees that much of the following chunk can tell, for each place an
   episode may start near its head, where the chain leaves it. These small tables are followed from
   chunk to chunk, and every chunk then lists its own episodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.blocks import in_blocks, with_neighbours
from eventide.functions.eventtime import bucket, epoch_micros, micros
from eventide.operators.logins import FAIL, known_users

MIN_FAILS = 2
# Chunk length of a long session, in episode lengths; at least 2 for the rule in step 3.
CHUNK_EPISODES = 64
# Later than any event: the cancel time of a row no success follows.
NEVER = 1 << 62

_SESSION = ["user_id", "session_t", "session_id"]


def fail_episodes(logins: DataFrame, within: timedelta = timedelta(seconds=2)) -> DataFrame:
    length = micros(within)
    fails = _session_rows(known_users(logins), within)
    sessions = fails.groupBy(*_SESSION).agg(F.max("t").alias("last_t"), F.sum("n").alias("n"),
                                            F.min("cancel_t").alias("cancel_t"))
    end = F.col("session_t") + length
    is_long = F.col("last_t") > end
    single = (sessions.filter(~is_long & (F.col("n") >= MIN_FAILS) & (F.col("cancel_t") > end))
              .select("user_id", F.col("session_t").alias("first_t"), "last_t", "n"))
    long_rows = fails.join(sessions.filter(is_long).select(*_SESSION, "last_t"), _SESSION)
    return (single.unionByName(_long_sessions(long_rows, length))
            .select("user_id", F.timestamp_micros("first_t").alias("first_ts"),
                    F.timestamp_micros("last_t").alias("last_ts"), "n"))


def _session_rows(logins: DataFrame, within: timedelta) -> DataFrame:
    """Fails of sessions with two or more fails: (user, session, t, n, cancel_t), n fails at instant t
    and cancel_t the time of a success right after them."""
    length = micros(within)
    blocked = in_blocks(logins.select("user_id", "event_id", "event_type", "ts", epoch_micros("ts").alias("t")), "user_id", "ts")
    w = Window.partitionBy("user_id", "block").orderBy("t", "event_id")
    seen = with_neighbours(blocked, "user_id", ["t", "event_id"],
                           lambda w: {"prev_type": F.lag("event_type").over(w), "prev_t": F.lag("t").over(w)},
                           lambda w: {"next_type": F.lead("event_type").over(w), "next_t": F.lead("t").over(w)})

    def near(other: str, gap: Column) -> Column:
        return F.coalesce((F.col(f"{other}_type") == FAIL) & (gap <= length), F.lit(False))

    flagged = (seen.select("user_id", "block", "t", "event_id", "event_type",
                           F.when(F.col("next_type") != FAIL, F.col("next_t")).otherwise(NEVER).alias("cancel_t"),
                           near("prev", F.col("t") - F.col("prev_t")).alias("joins"),
                           near("next", F.col("next_t") - F.col("t")).alias("goes_on"))
               .filter((F.col("event_type") == FAIL) & (F.col("joins") | F.col("goes_on")))
               # Few rows are left. An exchange here is shared by both uses below, which spares the
               # second one sorting the whole log again. (In the order of the window's keys Spark
               # would leave it out as needless.)
               .repartition("block", "user_id"))
    start = F.when(~F.col("joins"), F.struct("t", "event_id"))
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = flagged.select("user_id", "block", "t", "cancel_t", start.alias("start"),
                            F.last(start, ignorenulls=True).over(so_far).alias("session"))
    # A session begun in an earlier block is the last one begun before this block. One row per user
    # and block, whatever the number of fails in it.
    earlier = (Window.partitionBy("user_id").orderBy("block")
               .rowsBetween(Window.unboundedPreceding, -1))
    # The whole row rides along with its start: were it pruned, the exchange could not be shared.
    latest = F.max(F.struct("start", "t", "cancel_t"))
    begun = (placed.groupBy("user_id", "block").agg(latest.alias("latest"))
             .select("user_id", "block", F.max("latest").over(earlier)["start"].alias("session")))
    known = (placed.join(begun.withColumnRenamed("session", "begun"), ["user_id", "block"])
             .withColumn("session", F.coalesce("session", "begun")))
    return (known
            .groupBy("user_id", F.col("session.t").alias("session_t"),
                     F.col("session.event_id").alias("session_id"), "t")
            .agg(F.count(F.lit(1)).alias("n"), F.min("cancel_t").alias("cancel_t")))


def _long_sessions(rows: DataFrame, length: int) -> DataFrame:
    size = length * CHUNK_EPISODES
    key = [*_SESSION, "chunk"]
    user = rows.schema["user_id"].dataType.simpleString()
    ids = f"user_id {user}, session_t bigint, session_id bigint"
    since = F.col("t") - F.col("session_t")
    home = bucket(since, size)
    also = F.greatest(bucket(since - 2 * length, size), F.lit(0))
    many = F.col("last_t") - F.col("session_t") >= size
    chunked = (rows.withColumn("many", many)
               .withColumn("chunk", F.explode(F.sequence(F.when(many, also).otherwise(home), home)))
               .withColumn("own", F.col("chunk") == home))
    exits = chunked.filter("many").groupBy(*key).applyInPandas(
        _chunk_exits(length, size), f"{ids}, chunk bigint, low bigint, high bigint, leaves bigint")
    entries = exits.groupBy(*_SESSION).applyInPandas(
        _follow(size), f"{ids}, chunk bigint, entry bigint")
    # A session of one chunk is entered at its start; a chunk the chain never reaches has no entry.
    parts = (chunked.join(entries, key, "left")
             .withColumn("entry", F.when(F.col("many"), F.col("entry")).otherwise(F.col("session_t")))
             .filter(F.col("entry").isNotNull()))
    return (parts.select(*key, "t", "n", "cancel_t", "own", "entry")
            .repartition(*key).sortWithinPartitions(*key, "t")
            .mapInPandas(_list_episodes(length), f"user_id {user}, first_t bigint, last_t bigint, n bigint"))


def _chunk_exits(length: int, size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """For starts near the chunk's head: where the chain of episodes first leaves the chunk."""
        pdf = pdf.sort_values("t")
        t, own = pdf["t"].to_numpy(), pdf["own"].to_numpy()
        following = np.searchsorted(t, t + length, side="right")
        owned = int(own.sum())  # own rows come first in time
        # Jumps of doubled length until every chain has left the own rows; rows beyond them lead to themselves.
        at = np.r_[following, len(t)]
        at[owned:] = np.arange(owned, len(t) + 1)
        while (at[:owned] < owned).any():
            at = at[at]
        leaves = np.r_[t, -1][at[:owned]]
        head = pdf.iloc[0]
        chunk_start = head["session_t"] + head["chunk"] * size
        near = int(np.searchsorted(t[:owned], chunk_start + 2 * length, side="left"))
        near = max(near, 1)
        starts, ends = t[:near], leaves[:near]
        cut = np.flatnonzero(np.diff(ends)) + 1
        lows, highs = np.r_[0, cut], np.r_[cut, near] - 1
        return pd.DataFrame({
            "user_id": head["user_id"], "session_t": head["session_t"], "session_id": head["session_id"],
            "chunk": head["chunk"], "low": starts[lows], "high": starts[highs], "leaves": ends[lows],
        })
    return run


def _follow(size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The episode start at which the chain enters each chunk of a session."""
        pdf = pdf.sort_values("low")
        low, high = pdf["low"].to_numpy(), pdf["high"].to_numpy()
        leaves = pdf["leaves"].to_numpy()
        head = pdf.iloc[0]
        at, chunks, entries = int(head["session_t"]), [], []
        while at >= 0:
            k = int(np.searchsorted(low, at, side="right")) - 1
            assert low[k] <= at <= high[k]
            chunks.append((at - int(head["session_t"])) // size)
            entries.append(at)
            at = int(leaves[k])
        return pd.DataFrame({"user_id": head["user_id"], "session_t": head["session_t"],
                             "session_id": head["session_id"], "chunk": chunks, "entry": entries})
    return run


def _list_episodes(length: int):
    """Follows the chains of many chunks at once; the rows come sorted by chunk and time, and a chunk
    cut by a batch boundary waits for its rest."""
    key = [*_SESSION, "chunk"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if pdf.empty:
                continue
            last = (pdf[key] == pdf[key].iloc[-1]).all(axis=1).to_numpy()
            cut = len(pdf) - int(last.sum())
            if cut == 0 and (not held or (held[-1][key].iloc[-1] == pdf[key].iloc[0]).all()):
                held.append(pdf)
                continue
            yield _episodes_of(pd.concat([*held, pdf.iloc[:cut]]), key, length)
            held = [pdf.iloc[cut:]]
        if held:
            yield _episodes_of(pd.concat(held), key, length)
    return run


def _episodes_of(pdf: pd.DataFrame, key: list[str], length: int) -> pd.DataFrame:
    new = (pdf[key] != pdf[key].shift()).any(axis=1).to_numpy()
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    stop = np.r_[first[1:], len(pdf)]
    t, own, cancel = (pdf[c].to_numpy() for c in ("t", "own", "cancel_t"))
    upto = np.r_[0, np.cumsum(pdf["n"].to_numpy())]
    # Lay the chunks end to end, too far apart for an episode to reach from one into the next.
    base = t[first]
    stride = int((t - base[group]).max()) + length + 1
    line = group * stride + (t - base[group])
    following = np.searchsorted(line, line + length, side="right")
    entry = pdf["entry"].to_numpy()[first]
    at = np.searchsorted(line, np.arange(len(first)) * stride + (entry - base))
    starts = []
    while len(at):
        at = at[own[at]]
        starts.append(at)
        after = following[at]
        at = after[after < stop[group[at]]]
    i = np.sort(np.concatenate(starts))
    j = following[i]
    n = upto[j] - upto[i]
    keep = (n >= MIN_FAILS) & (cancel[j - 1] > t[i] + length)
    i, j, n = i[keep], j[keep], n[keep]
    return pd.DataFrame({"user_id": pdf["user_id"].to_numpy()[i], "first_t": t[i], "last_t": t[j - 1], "n": n})
