"""Time blocks: split a key's timeline so that no key needs a task of its own.

A rule that looks at the rows next to a row can run per (key, block), but for rows near a block's border. Those are
looked at once more, by key, together with the border rows of the other blocks: a few rows a block, whatever it holds.
No row is copied into another block.

Blocks follow the density of the data. One count per key, combined in the map tasks, tells which keys hold more rows than
a block should; each of those gets blocks as narrow as its rows ask for, and the rest one block each.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from eventide.functions.eventtime import epoch_micros, micros

#: Rows that a block should hold, and the least width of one.
ROWS_PER_BLOCK = 100_000
LEAST_WIDTH = timedelta(seconds=1)
#: At most so many keys get a width of their own; beyond that, keys share the width of the smallest of them.
OWN_WIDTHS = 1000

Looks = Callable[[WindowSpec], dict[str, Column]]


@dataclass
class Blocked:
    """Rows with their `block`, and whether any key has several."""

    rows: DataFrame
    several: bool


def in_blocks(df: DataFrame, key: str, ts: str) -> Blocked:
    """Adds `block`; rows without a time are in none and left out."""
    rows = df.filter(F.col(ts).isNotNull())
    t = epoch_micros(ts)
    total, low, high = rows.agg(F.count(F.lit(1)), F.min(t), F.max(t)).first()
    span = (high - low if total else 0) + 1
    start = F.lit(low or 0).cast("long")
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))

    def width(n: int) -> int:
        return max(span * ROWS_PER_BLOCK // n, micros(LEAST_WIDTH)) if n > ROWS_PER_BLOCK else span

    # Fewer rows than a block's in all need no look at the keys.
    if total <= ROWS_PER_BLOCK or counts.filter(F.col("n") > ROWS_PER_BLOCK).isEmpty():
        return Blocked(rows.withColumn("block", _div(t - start, F.lit(span))), False)
    # At most OWN_WIDTHS keys hold more than this share of the rows.
    share = max(ROWS_PER_BLOCK, total // OWN_WIDTHS)
    busy = counts.filter(F.col("n") > share).select(key, "n").collect()
    own = df.sparkSession.createDataFrame([(r[0], width(r["n"])) for r in busy], f"{key} {dict(df.dtypes)[key]}, _width bigint")
    wide = F.coalesce("_width", F.lit(width(share)).cast("long"))
    dealt = rows.join(F.broadcast(own), key, "left").withColumn("block", _div(t - start, wide)).drop("_width")
    return Blocked(dealt.select(*df.columns, "block"), True)


def _div(value: Column, width: Column) -> Column:
    return F.call_function("div", value, width.cast("long"))


def with_neighbours(blocked: Blocked, key: str, order: list[str], back: Looks, ahead: Looks | None = None, reach: int = 1) -> DataFrame:
    """Adds columns that look at up to `reach` rows before (`back`) or after (`ahead`) a row in its key's history.

    Each of the two gives window expressions over a window of (key, block) first. The first rows of a block get what
    `back` gives over the border rows of all the key's blocks, the last ones what `ahead` gives. Border rows are the
    first and last `reach` of each block, so all that such a row can see is among them, and in the same order.
    """
    rows, ahead = blocked.rows, ahead or (lambda w: {})
    local = Window.partitionBy(key, "block").orderBy(*order)
    whole = Window.partitionBy(key).orderBy(*order)
    names = [*back(local), *ahead(local)]
    if not blocked.several:
        return rows.select("*", *[c.alias(name) for name, c in (back(local) | ahead(local)).items()])
    seen = rows.select("*", F.lag(F.lit(1), reach).over(local).isNull().alias("_first"),
                       F.lead(F.lit(1), reach).over(local).isNull().alias("_last"),
                       *[c.alias(name) for name, c in (back(local) | ahead(local)).items()])
    border = F.col("_first") | F.col("_last")
    mended = seen.filter(border).select(
        *rows.columns, *[F.when(F.col("_first"), c).otherwise(F.col(name)).alias(name) for name, c in back(whole).items()],
        *[F.when(F.col("_last"), c).otherwise(F.col(name)).alias(name) for name, c in ahead(whole).items()])
    return seen.filter(~border).select(*rows.columns, *names).unionByName(mended)


def nearest_outside(blocked: Blocked, key: str, values: dict[str, Column]) -> DataFrame:
    """Adds, for each value, `before_<name>` and `after_<name>`: the largest in the key's earlier blocks and the smallest
    in its later ones. Values grow with time, nulls do not count."""
    rows = blocked.rows
    if not blocked.several:
        return rows.select("*", *[F.when(F.lit(False), v).alias(f"{side}_{name}") for name, v in values.items() for side in ("before", "after")])
    edges = [e for name, v in values.items() for e in (F.max(v).alias(f"last_{name}"), F.min(v).alias(f"first_{name}"))]
    blocks = rows.groupBy(key, "block").agg(*edges)
    earlier = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(key).orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    near = [c for name in values for c in (F.max(f"last_{name}").over(earlier).alias(f"before_{name}"),
                                           F.min(f"first_{name}").over(later).alias(f"after_{name}"))]
    return rows.join(blocks.select(key, "block", *near), [key, "block"])
