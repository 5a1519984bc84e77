"""Benchmark decontamination: an FM-index per shard of documents, searched for every window of the test items.

A shard is some MB of consecutive rows in a task. Its sequence holds only runs of words that the test items use and
that are long enough for a window: a window can occur nowhere else. Each window is searched backwards, its occurrences
are located from sampled suffix positions, and overlapping ones are merged into spans.

Test items are read in blocks of a bounded size. Each block is sent to the tasks and adds its spans to those found
before, so any number of items can be searched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.fm_index import FMIndex
from eventide.llm.tables import texts_of
from eventide.llm.words import words_of

WINDOW = 13
SHARD_BYTES = 16 << 20
ITEM_BLOCK_BYTES = 16 << 20
FOUND = "doc_id long, text string, n_words long, spans array<struct<start:long,stop:long>>, item_ids array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


class Phrases:
    """The windows of some test items: word numbers, and a matrix of windows with the item of each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.items = sorted({item for item, _ in items})
        number = {item: i for i, item in enumerate(self.items)}
        self.vocabulary: dict[bytes, int] = {}
        found: set[tuple] = set()
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            if size:
                found.update((tuple(ids[i:i + size]), number[item]) for i in range(len(ids) - size + 1))
        windows = sorted(found)
        distinct = sorted({w for w, _ in windows})
        self.sizes = np.array([len(w) for w in distinct], np.int64)
        self.matrix = np.zeros((len(distinct), window), np.int64)
        for row, w in enumerate(distinct):
            self.matrix[row, window - len(w):] = w
        at = {w: i for i, w in enumerate(distinct)}
        self.owner_of = np.array([at[w] for w, _ in windows], np.int64)
        self.owners = np.array([i for _, i in windows], np.int64)
        self.shortest = int(self.sizes.min()) if len(distinct) else 0


def _search(texts: list[bytes], phrases: Phrases) -> list[tuple]:
    """(number of words, spans, item ids) of each text of a shard."""
    get, counts, parts = phrases.vocabulary.get, [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        parts.append(np.fromiter((get(w, 0) for w in words), np.int32, len(words)))
    nothing = [(n, [], []) for n in counts]
    if not phrases.shortest or not sum(counts):
        return nothing
    # every document ends with a break, then only long enough runs of known words are kept, each with its break
    ids = np.concatenate([x for p in parts for x in (p, np.zeros(1, np.int32))]).astype(np.int64)
    doc_start = np.cumsum([0] + [n + 1 for n in counts])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]])))
    starts, stops = edges[::2], edges[1::2]
    long_enough = stops - starts >= phrases.shortest
    starts, stops = starts[long_enough], stops[long_enough]
    if not len(starts):
        return nothing
    sizes = stops - starts + 1
    places = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum()))
    index = FMIndex(ids[places], len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.matrix)
    n = high - low
    window = np.repeat(np.arange(len(n)), n)
    rows = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
    at = places[index.locate(rows)]
    delta = np.zeros(len(ids) + 1, np.int64)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + phrases.sizes[window], -1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(delta) > 0, [0]])))
    out = nothing
    doc = np.searchsorted(doc_start, edges[::2], side="right") - 1
    for d, a, b in zip(doc.tolist(), (edges[::2] - doc_start[doc]).tolist(), (edges[1::2] - doc_start[doc]).tolist()):
        out[d][1].append((a, b))
    # a document's windows, then the items they belong to
    pairs = np.unique((np.searchsorted(doc_start, at, side="right") - 1) * len(phrases.sizes) + window)
    doc, window = np.divmod(pairs, len(phrases.sizes))
    first = np.searchsorted(phrases.owner_of, window)
    last = np.searchsorted(phrases.owner_of, window, side="right")
    for d, a, b in zip(doc.tolist(), first.tolist(), last.tolist()):
        out[d][2].extend(phrases.owners[a:b].tolist())
    return [(n, spans, [phrases.items[i] for i in sorted(set(items))]) for n, spans, items in out]


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans united where they overlap."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[str, bytes]]]:
    block, size, any_ = [], 0, False
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    for row in rows.where("i is not null and t is not null").distinct().toLocalIterator():
        block.append((row.i, row.t.encode()))
        size += len(block[-1][1])
        if size >= most:
            yield block
            block, size, any_ = [], 0, True
    if block or not any_:
        yield block  # even of no items: the words are counted


def occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                shard_bytes: int = SHARD_BYTES, block_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, text, n_words, spans of words inside occurrences of windows, ids of the items they are from.

    A window is `window` consecutive words of an item; an item of fewer, but not none, is one window. Spans do not
    overlap and are ascending. Null texts have no words. Items with a null id or text are ignored. Repeated rows each
    give a row; repeated item ids count as one item.
    """
    spark = docs.sparkSession
    none = F.array().cast("array<struct<start:long,stop:long>>")
    found = texts_of(docs, id_col, text_col).select("doc_id", "text", F.lit(0).cast("long").alias("n_words"),
                                                    none.alias("spans"), F.array().cast("array<string>").alias("item_ids"))
    for items in _item_blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(Phrases(items, window))
        found = found.mapInArrow(lambda b, shared=shared: _scan(b, shared.value, shard_bytes), FOUND)
    return found


def _scan(batches: Iterable[pa.RecordBatch], phrases: Phrases, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            piece = batch.slice(at, 500)
            held.append(piece)
            size += piece.column("text").nbytes
            if size >= shard_bytes:
                yield from _searched(held, phrases)
                held, size = [], 0
    if held:
        yield from _searched(held, phrases)


def _searched(held: list[pa.RecordBatch], phrases: Phrases) -> Iterator[pa.RecordBatch]:
    texts = [t.as_py() or b"" for piece in held for t in piece.column("text").cast(pa.binary())]
    results, at = _search(texts, phrases), 0
    for piece in held:
        own = results[at:at + piece.num_rows]
        at += piece.num_rows
        spans = [_merged([(s["start"], s["stop"]) for s in old] + new) if old else new
                 for old, (_, new, _) in zip(piece.column("spans").to_pylist(), own)]
        items = [sorted({*old, *new}) for old, (_, _, new) in zip(piece.column("item_ids").to_pylist(), own)]
        yield pa.RecordBatch.from_arrays([
            piece.column("doc_id"), piece.column("text"), pa.array([n for n, _, _ in own], pa.int64()),
            pa.array([[{"start": a, "stop": b} for a, b in row] for row in spans], _SPANS),
            pa.array(items, pa.list_(pa.string()))], names=["doc_id", "text", "n_words", "spans", "item_ids"])


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = 20, **columns) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (at least one word in `share` is hit)."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return occurrences(docs, benchmark, **columns).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
