"""Approximate nearest neighbours by collision counting over single projections.

Vectors are scaled to length one and projected on M random directions. In each block of rows every projection is a
sorted array. A query opens a window around its own value in each array; widening the windows by a factor is a virtual
rehash to a larger radius. A row that falls in at least THRESHOLD windows is verified with its true cosine. A query
stops once its k nearest verified rows all lie within the present radius; there is no cap on candidates, and if the
last radius leaves fewer than k the whole block is verified.

At radius R a window is 2.719 R wide, so a row at distance R falls into each with a chance of 0.826; of 64 it is in 45
or more with a chance of 0.995, the expected recall of every row nearer than the k-th.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

M, THRESHOLD, WIDTH = 64, 45, 2.719
RADII = 0.05 * 1.25 ** np.arange(17)
BLOCK_ROWS, QUERY_ROWS, SEED = 16_384, 8_192, 20_240


class SortedProjections:
    """One block of vectors: originals, and every projection as a sorted array with the rows it orders."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, directions: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        values = (vectors / self.norms[:, None]) @ directions
        self.order = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T)
        self.values = np.take_along_axis(values.T, self.order, axis=1)

    def cosine(self, rows: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
        """Row by row, so that equal vectors get equal scores wherever they stand."""
        return (self.vectors[rows] * query).sum(axis=1) / (self.norms[rows] * norm)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, directions: np.ndarray, k: int) -> Iterator[tuple]:
        """(query row, ids, scores) of the k best verified rows of each query in this block."""
        norms = np.sqrt((queries * queries).sum(axis=1))
        centres = (queries / norms[:, None]) @ directions
        half = WIDTH / 2 * RADII
        for at in range(0, len(queries), 512):
            part = slice(at, at + 512)
            low = np.stack([np.searchsorted(v, c[:, None] - half) for v, c in zip(self.values, centres[part].T)])
            high = np.stack([np.searchsorted(v, c[:, None] + half, side="right")
                             for v, c in zip(self.values, centres[part].T)])
            for i in range(low.shape[1]):
                yield at + i, *self._one(query_ids[at + i], queries[at + i], norms[at + i], low[:, i], high[:, i], k)

    def _one(self, own: int, query: np.ndarray, norm: float, low: np.ndarray, high: np.ndarray, k: int) -> tuple:
        n = len(self.ids)
        counts, open_ = np.zeros(n, np.int64), self.ids != own
        rows, scores = np.zeros(0, np.int64), np.zeros(0)
        left = right = None
        for level, radius in enumerate(RADII):
            a, b = low[:, level], high[:, level]
            if left is None:
                slices = [o[x:y] for o, x, y in zip(self.order, a, b)]
            else:
                slices = [o[x:y] for o, x, y in zip(self.order, a, left)]
                slices += [o[x:y] for o, x, y in zip(self.order, right, b)]
            left, right = a, b
            counts += np.bincount(np.concatenate(slices), minlength=n)
            new = np.flatnonzero((counts >= THRESHOLD) & open_)
            if len(new):
                open_[new] = False
                rows = np.concatenate([rows, new])
                scores = np.concatenate([scores, self.cosine(new, query, norm)])
            if len(rows) >= k and np.partition(scores, len(scores) - k)[len(scores) - k] >= 1 - radius * radius / 2:
                break
        else:
            if len(rows) < k:
                new = np.flatnonzero(open_)
                rows = np.concatenate([rows, new])
                scores = np.concatenate([scores, self.cosine(new, query, norm)])
        best = np.lexsort((self.ids[rows], -scores))
        _, first = np.unique(self.ids[rows][best], return_index=True)  # a repeated id counts once
        best = best[np.sort(first)][:k]
        return self.ids[rows[best]], scores[best]


def _scaled(vector: np.ndarray) -> np.ndarray:
    """The vector times a power of two: no digit of a cosine changes, and no square overflows or vanishes."""
    return np.ldexp(vector, -np.frexp(np.abs(vector).max())[1])


def _usable(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for key, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
        if key is None or not vector or any(x is None for x in vector):
            continue
        values = np.array(vector, np.float64)
        if np.isfinite(values).all() and values.any():
            yield key, _scaled(values)


def _directions(size: int) -> np.ndarray:
    return np.random.default_rng(SEED + size).standard_normal((size, M))


def _blocks(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of up to `rows` rows of one dimension."""
    held: dict[int, list] = {}
    for batch in batches:
        for key, vector in _usable(batch):
            own = held.setdefault(len(vector), [])
            own.append((key, vector))
            if len(own) >= rows:
                del held[len(vector)]
                yield np.array([k for k, _ in own]), np.stack([v for _, v in own])
    for own in held.values():
        yield np.array([k for k, _ in own]), np.stack([v for _, v in own])


def _query_blocks(queries: DataFrame, most: int) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The queries in blocks of at most `most`, by dimension; repeated ids once each."""
    block: dict[int, dict[int, list]] = {}
    count = 0
    ready = lambda: {d: (np.array(list(q)), np.array(list(q.values()))) for d, q in block.items()}
    for row in queries.toLocalIterator():
        vector = np.array(row.embedding, np.float64)
        block.setdefault(len(vector), {})[row.vec_id] = _scaled(vector)
        count += 1
        if count >= most:
            yield ready()
            block, count = {}, 0
    if block:
        yield ready()


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
           vector_col: str = "embedding", query_rows: int = QUERY_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per query and rank: query_id, rank, vec_id, score (cosine of the original vectors in double precision).

    Equal scores go to the smaller vec_id. Every row but the query's own id is searched. Rows whose id or vector is
    null, whose vector is zero or empty or holds a null or non-finite component take no part, on either side; vectors
    of another dimension are no candidates. Repeated ids count once, with their nearest vector; of repeated query ids
    one is used. Queries go out in blocks of at most `query_rows`.
    """
    spark = vectors.sparkSession
    named = lambda df: df.select(F.col(id_col).cast("long").alias("vec_id"),
                                 F.col(vector_col).cast("array<double>").alias("embedding"))
    usable = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("embedding", lambda x: x != 0))
    rows, found = named(vectors), None
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    sql_schema = "query_id long, vec_id long, score double"

    def scan(batches, shared):
        for ids, block in _blocks(batches, block_rows):
            size = block.shape[1]
            if size not in shared.value:
                continue
            query_ids, asked = shared.value[size]
            directions = _directions(size)
            index = SortedProjections(ids, block, directions)
            out: tuple[list, list, list] = ([], [], [])
            for row, near, scores in index.nearest(query_ids, asked, directions, k):
                out[0].append(np.full(len(near), query_ids[row]))
                out[1].append(near)
                out[2].append(scores)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=schema)

    for block in _query_blocks(named(queries).where(usable), query_rows):
        shared = spark.sparkContext.broadcast(block)
        part = rows.mapInArrow(lambda b, shared=shared: scan(b, shared), sql_schema)
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], sql_schema)
    nearest = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return nearest.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
