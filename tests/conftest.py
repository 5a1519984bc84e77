import random
from datetime import datetime, timedelta, timezone

import pytest

from eventide.session import build_session

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores="4", shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def secs(value):
    """Seconds since BASE of a collected timestamp."""
    return round((value.astimezone(timezone.utc) - BASE).total_seconds(), 6)


def frame(spark, rows, schema):
    """Rows with a column `s` (seconds since BASE) turned into the timestamp column `ts`."""
    from pyspark.sql import functions as F

    start = int(BASE.timestamp() * 1_000_000)
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint") + start)).drop("s")


def random_events(seed, n, users, span, kinds, hot_share=0.4, step=1.0):
    """(event_id, user_id, kind, s): one user holds `hot_share` of the rows, times repeat often."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rng.random() < hot_share else rng.randrange(1, users)
        rows.append((i, user, rng.choice(kinds), rng.randrange(int(span / step)) * step))
    return rows
