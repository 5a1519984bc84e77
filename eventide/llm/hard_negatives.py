"""Hard-negative mining: for every anchor and positive, the best rows of other labels a little below the positive.

An anchor's positives each ask for the best negatives with 80 % to 100 % of their own score. These windows overlap.
Their upper limits cut the scores into disjoint slots: slot j holds scores up to the j-th limit and above the next one.
Every tile of the work keeps the best k per (anchor, slot), and so does the merge of the tiles. As all scores of a slot
lie above those of the next, a window's best k are the first k of its slot and the slots after it in turn, and its lower
limit only cuts the end of that list. One selection so answers all windows.

The scores of anchors against all rows are found in tiles: a tile meets one group of anchors with one group of rows,
both bounded, in packed blocks. Neither the anchors nor the rows pass the driver, and no group is a label's or key's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.tables import stored

POSITIVES, NEGATIVES = 5, 5
#: A negative's score is 80 to 100 hundredths of its positive's.
LOW, HIGH, OF = 80, 100, 100
SCALE = 256.0
#: Rows of a packed block, and rows or anchors of one side of a tile.
BLOCK, TILE = 2048, 16384
#: Scores are held to this range, so that 100 times a score fits a long.
MOST = 1 << 56
#: Whole numbers up to these are exact in a float of 32 and 64 bits.
EXACT_32, EXACT_64 = 1 << 24, 1 << 53

_BLOCKS = "ids binary, labels binary, limits binary, size int, dims int, kind string, vectors binary"


def usable_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, label and vector (doubles) of the rows that take part; labels of ids divisible by 7 moved on by one."""
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"),
                           F.col("embedding").cast("array<double>").alias("vector"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
                   & F.coalesce(whole, F.lit(False))))


def quantised(vectors: list, dims: int) -> np.ndarray:
    """floor(256 x) of every component, as doubles; a short vector ends in zeros."""
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    with np.errstate(over="ignore"):
        return np.floor(np.nan_to_num(out * SCALE))


def packed(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (id, label, vector, limits) as blocks of raw arrays, `block` rows at most."""
    schema = pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("limits", pa.binary()), ("size", pa.int32()),
                        ("dims", pa.int32()), ("kind", pa.string()), ("vectors", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                if held and sum(b.num_rows for b in held) + part.num_rows > block:
                    yield one(held)
                    held = []
                held.append(part)
        if held:
            yield one(held)

    def one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        vectors = table["vector"].to_pylist()
        dims = max(map(len, vectors), default=0)
        values = quantised(vectors, dims)
        kind = "float32" if not values.size or np.abs(values).max() < EXACT_32 else "float64"
        limits = np.array(table["limits"].to_pylist(), np.int64)
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((
            np.array(table["id"], np.int64).tobytes(), np.array(table["label"], np.int64).tobytes(), limits.tobytes(),
            len(vectors), dims, kind, values.astype(kind).tobytes()), schema.types)], schema=schema)

    return rows.select("id", "label", "vector", "limits").mapInArrow(pack, _BLOCKS)


class Block:
    def __init__(self, row: dict):
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(row["size"], row["dims"])
        limits = np.frombuffer(row["limits"], np.int64)
        self.limits = limits.reshape(row["size"], -1) if len(limits) else None


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products; whole numbers too large for doubles are multiplied as such, and held to +-MOST."""
    dims = min(a.shape[1], b.shape[1])
    a, b = a[:, :dims].astype(np.float64), b[:, :dims].astype(np.float64)
    most = dims * (np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0)) if a.size and b.size else 0.0
    if most < EXACT_64:
        return a @ b.T
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(a).dot(whole(b).T)
    return np.clip(exact, -MOST, MOST).astype(np.int64)


class Best:
    """The best k entries per (anchor, slot): the largest score first, then the smallest id."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.slots, self.k = slots, k
        self.bar = np.full(anchors * slots, -np.inf)
        self.kept = [np.zeros(0, np.int64)] * 3
        self.new: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """`slot` numbers anchor and slot together."""
        self.new.append([slot, score.astype(np.int64), ids])
        self.waiting += len(slot)
        if self.waiting > max(1 << 18, len(self.kept[0])):
            self.settle()

    def settle(self) -> None:
        if not self.new:
            return
        slot, score, ids = (np.concatenate(c) for c in zip(self.kept, *self.new))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, slot)
        nth = np.arange(len(slot)) - first
        last = nth == self.k - 1
        self.bar[slot[last]] = score[last]
        keep = nth < self.k
        self.kept, self.new, self.waiting = [slot[keep], score[keep], ids[keep]], [], 0


_FOUND = "anchor long, slot int, score long, vec_id long"


def _tile(k: int, same_label: bool):
    """The best k rows per anchor and slot of one tile."""
    schema = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])

    def meet(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        for row in anchors.to_pylist() if rows.num_rows else ():
            block = Block(row)
            # the anchor's number, then its slots' upper limits
            keys, limits = block.limits[:, 0], block.limits[:, 1:]
            slots = 1 if same_label else limits.shape[1]
            best = Best(len(keys), slots, k)
            for batch in rows.to_batches(max_chunksize=1):
                one_block(best, block, limits, Block(batch.to_pylist()[0]), slots)
            best.settle()
            slot, score, ids = best.kept
            out.append(pa.table([keys[slot // slots], (slot % slots).astype(np.int32), score, ids], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    def one_block(best: Best, block: Block, limits: np.ndarray, other: Block, slots: int) -> None:
        found = scores(block.vectors, other.vectors)
        right = block.labels[:, None] == other.labels[None, :]
        if same_label:
            right &= block.ids[:, None] != other.ids[None, :]
        else:
            right = ~right
        for j in range(slots):
            fits = right & (found >= best.bar.reshape(-1, slots)[:, j, None])
            if not same_label:
                upper = limits[:, j]
                # A slot reaches down to the next limit, but never below what its own window asks for.
                lower = -((-LOW * upper) // OF)
                if j + 1 < slots:
                    lower = np.maximum(lower, limits[:, j + 1] + 1)
                fits &= (found >= lower[:, None]) & (found <= upper[:, None])
            a, b = np.nonzero(fits)
            a, b = _trimmed(found, a, b, best.k)
            best.add(a * slots + j, found[a, b], other.ids[b])

    return meet


def _trimmed(found: np.ndarray, a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of very many entries only those that reach their anchor's k-th best score in this block, ties included."""
    if len(a) <= 64 * k * max(1, len(found)):
        return a, b
    held = np.full(found.shape, -np.inf)
    held[a, b] = found[a, b]
    bar = np.partition(held, -min(k, held.shape[1]), axis=1)[:, -min(k, held.shape[1])]
    keep = found[a, b] >= bar[a]
    return a[keep], b[keep]


def _best_of_tiles(rows: DataFrame, anchors: DataFrame, sides: tuple[int, int], k: int, same_label: bool) -> DataFrame:
    over, across = sides
    place = F.xxhash64("ids", "labels", "vectors")

    def spread(blocks: DataFrame, own: str, own_count: int, other: str, other_count: int) -> DataFrame:
        return (blocks.withColumn(own, F.pmod(place, F.lit(own_count)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_count - 1).cast("long")))))

    left = spread(rows, "r", over, "a", across).groupBy("a", "r")
    right = spread(anchors, "a", across, "r", over).groupBy("a", "r")
    found = left.cogroup(right).applyInArrow(_tile(k, same_label), _FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds `anchor`, a number of its own for each row."""
    names = ["vec_id", "label", "vector"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            yield batch.append_column("anchor", pa.array(range(at, at + batch.num_rows), pa.int64()))
            at += batch.num_rows

    # Distinct rows come in hash partitions; sorted, a task that runs again gives the same numbers.
    return (rows.select(names).distinct().sortWithinPartitions(*names)
            .mapInArrow(number, "vec_id long, label long, vector array<double>, anchor long"))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         tile: int = TILE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows without an id, label or vector, or with a null or non-finite component, take no part. A vector shorter than
    another counts as if it ended in zeros; an empty one scores 0 with all. Scores are exact whole numbers, those beyond
    2^56 count as 2^56. Ties go to the smaller vec_id, for the positives too. Rows that repeat are found as often as they
    stand; a repeated anchor is one anchor, while rows of one id that differ are anchors each, and no row of the
    anchor's id is its positive. Negative and zero scores are allowed: no window of a negative one holds anything. An
    anchor without positives, a positive without negatives and an empty table give no rows. Other columns are ignored.
    """
    rows = usable_rows(vectors)
    none = F.array().cast("array<long>")
    blocks = stored(packed(rows.select(F.col("vec_id").alias("id"), "label", "vector", none.alias("limits"))), "row-blocks")
    anchors = stored(_numbered(rows.where(is_anchor)), "anchors")
    asked = anchors.select(F.col("vec_id").alias("id"), "label", "vector", F.array("anchor").alias("limits"))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    n_rows, n_anchors = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0], anchors.count()
    sides = max(math.ceil(n_rows / tile), cores), max(1, math.ceil(n_anchors / tile))

    best = stored(_best_of_tiles(blocks, packed(asked), sides, positives, True), "positives")
    # A limit that several positives share is one slot. An unused slot's limit is negative, so nothing fits it.
    limits = best.groupBy("anchor").agg(F.sort_array(F.collect_set("score"), asc=False).alias("tops"))
    padded = F.concat(F.array("anchor"), "tops", F.array_repeat(F.lit(-MOST), F.lit(positives) - F.size("tops")))
    bounded = anchors.join(limits, "anchor").select(F.col("vec_id").alias("id"), "label", "vector", padded.alias("limits"))
    found = _best_of_tiles(blocks, packed(bounded), sides, negatives, False)

    # One short list an anchor, best first: the slots follow one another downwards.
    entry = F.struct("slot", "nth", F.col("score").alias("negative_score"), F.col("vec_id").alias("negative_id"))
    lists = found.groupBy("anchor").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    wanted = (best.join(limits, "anchor").join(lists, "anchor").join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
              .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                      (F.array_position("tops", F.col("score")) - 1).alias("first"), "entries"))
    inside = F.filter("entries", lambda e: (e["slot"] >= F.col("first")) & (LOW * F.col("positive_score") <= OF * e["negative_score"])
                      & (OF * e["negative_score"] <= HIGH * F.col("positive_score")))
    return (wanted.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(inside, 1, negatives)).alias("nth", "e"))
            .select("anchor_id", "positive_id", (F.col("nth") + 1).alias("rank"), "e.negative_id", "positive_score", "e.negative_score"))
