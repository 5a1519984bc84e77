"""Token-id files with keyed access through a minimal perfect hash index.

A dataset is a folder of Parquet tables:

- `blocks`: documents in ascending doc_id order, cut into blocks of some MB. A row holds shard and block number, the
  raw ids of its documents one after another (little-endian, 2 or 4 bytes each), and each document's id and length.
- `index`: one row per bucket of keys (by hash of the key). A row holds a minimal perfect hash of the bucket's keys
  and, at each key's number, a 32-bit fingerprint and the document's shard, block, offset and length. Keys are not
  stored; a key whose fingerprint differs is not in the dataset.

- `size`: one row, the number of buckets.

Both large tables are filed by folders whose names follow from a key's hash and from its slot, and a block is a row group
of its own. `fetch_key` so reads one index row and one block row, however large the dataset is. `lookup` and `fetch` are
for tables of keys: they read the index once, and the blocks once.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.perfect_hash import PerfectHash, fingerprints
from eventide.llm.tables import texts_of

BLOCK_BYTES = 4 << 20
KEYS_PER_BUCKET = 50_000
BUCKETS_PER_PART = 64
#: Bytes of known words a Python worker keeps.
CACHED_BYTES = 192 << 20
WORDS_PER_CALL = 500
#: Text that is encoded together.
PIECE_BYTES = 1 << 20
BLOCKS = "shard int, block int, width int, n_tokens long, doc_ids array<long>, lengths array<long>, payload binary"
SLOT = np.dtype([("check", "<u4"), ("shard", "<u4"), ("block", "<u4"), ("offset", "<u8"), ("length", "<u8")])
WORD_END = "</w>"
# Python splits at these four; the tokenizer's white space does not hold them.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
# Lower-casing a text first, as the tokenizer does by character, could change these.
PECULIAR = ("\u0130", "\u03a3", "<|")
SPACE = re.compile(r"[^\S\x1c-\x1f]+")


class WordEncoder:
    """Encodes whole texts with a tokenizers-library file whose pre-tokenizer drops white space.

    White space always ends a word there, so a text's ids are its words' ids in a row. Words have numbers; the ids of all
    known words lie in one array, and a text's are gathered from it. The library encodes the distinct words that are not
    known yet, many to a call. When the known words take more than CACHED_BYTES they are let go.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for name, i in vocabulary.items() if name.endswith(WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = self.used = 0
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, self.kind)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Raw little-endian ids of each text."""
        if self.held > CACHED_BYTES:
            self._forget()
        split = [_words(t) for t in texts]
        words = list(chain.from_iterable(split))
        number = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(number < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys(words[i] for i in missing)))
            number[missing] = np.fromiter((self.known[words[i]] for i in missing), np.int64, len(missing))
        size = self.size[number]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[number] - ends[:-1], size) + np.arange(ends[-1])
        raw = self.ids[at].tobytes()
        bounds = (ends[np.cumsum([0, *map(len, split)])] * self.width).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if w.isalpha()]
        rest = [w for w in new if not w.isalpha()]
        found = [*self._letters(plain), *self._any(rest)]
        new = plain + rest
        sizes, ids = (np.concatenate(c) for c in zip(*found))
        first, n = len(self.known), len(new)
        self.known.update(zip(new, range(first, first + n)))
        self.start, self.size = _room(self.start, first + n), _room(self.size, first + n)
        self.ids = _room(self.ids, self.used + len(ids))
        self.size[first:first + n] = sizes
        self.start[first:first + n] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        # a string and its place in the dictionary take some hundred bytes besides the characters
        self.held += sum(map(len, new)) * 2 + n * 150 + ids.nbytes

    def _letters(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Sizes and ids of words of letters alone. Each is one pre-token, whose last id says so; as every word has one
        such id at least, their number tells whether that holds for all."""
        groups, out = _groups(words), []
        codes = self.tokenizer.encode_batch_fast(list(map(" ".join, groups)), add_special_tokens=False)
        for group, code in zip(groups, codes):
            ids = np.array(code.ids, self.kind)
            ends = np.flatnonzero(self.ends[ids])
            out += [(np.diff(ends, prepend=-1), ids)] if len(ends) == len(group) else self._any(group)
        return out

    def _any(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        groups = _groups(words)
        codes = self.tokenizer.encode_batch(list(map(" ".join, groups)), add_special_tokens=False)
        return [(_sizes(g, c), np.array(c.ids, self.kind)) for g, c in zip(groups, codes)]


def _groups(words: list[str]) -> list[list[str]]:
    return [words[at:at + WORDS_PER_CALL] for at in range(0, len(words), WORDS_PER_CALL)]


def _words(text: str) -> list[str]:
    """Lower-cased where the tokenizer would do so alike; split where it sees white space."""
    if any(c in text for c in PECULIAR):
        return SPACE.split(text)
    return SPACE.split(text.lower()) if any(c in text for c in NOT_SPACE) else text.lower().split()


def _sizes(words: list[str], code) -> np.ndarray:
    """How many ids each of the words has that were encoded as one text: an id belongs to the word it starts in."""
    starts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
    at = np.fromiter(chain.from_iterable(code.offsets), np.int64, 2 * len(code))[::2]
    return np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(words))


def _room(array: np.ndarray, n: int) -> np.ndarray:
    return array if n <= len(array) else np.concatenate([array, np.zeros(max(n - len(array), len(array)), array.dtype)])


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One for all tasks of a Python worker."""
    return WordEncoder(path)


def _pieces(batches: Iterable[pa.RecordBatch]):
    """Ids and texts of some PIECE_BYTES at a time, however the batches are cut."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py() or ""
            keys.append(key)
            texts.append(text)
            size += len(text)
            if size >= PIECE_BYTES:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _blocks(batches: Iterable[pa.RecordBatch], path: str, end_id: int, block_bytes: int):
    coder = _encoder(path)
    end = int(end_id).to_bytes(coder.width, "little")
    shard, block, size = TaskContext.get().partitionId(), 0, 0
    ids: list = []
    parts: list[bytes] = []

    def row():
        lengths = [len(p) // coder.width for p in parts]
        columns = [[shard], [block], [coder.width], [sum(lengths)], [ids], [lengths], [b"".join(parts)]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
            pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()))],
            names=["shard", "block", "width", "n_tokens", "doc_ids", "lengths", "payload"])

    for keys, texts in _pieces(batches):
        for key, code in zip(keys, coder.encode(texts)):
            ids.append(key)
            parts.append(code + end)
            size += len(code) + len(end)
            if size >= block_bytes:
                yield row()
                block, size, ids, parts = block + 1, 0, [], []
    if ids:
        yield row()


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
              text_col: str = "text", block_bytes: int = BLOCK_BYTES, keys_per_bucket: int = KEYS_PER_BUCKET) -> None:
    """Encodes every row's whole text (null: empty), appends `end_id`, and writes the dataset to `folder`.

    Rows with a null id come first. Rows that share an id stand next to each other, in an order their texts fix; the
    index leads to the first of them. A null id is not indexed. An empty table gives an empty dataset.
    """
    spark = docs.sparkSession
    order = ["doc_id", "tie"]
    ranged = texts_of(docs, id_col, text_col).withColumn("tie", F.xxhash64("text")).repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).drop("tie").mapInArrow(
        lambda batches: _blocks(batches, tokenizer_path, end_id, block_bytes), BLOCKS,
    ).write.option("compression", "zstd").option("parquet.block.size", block_bytes).partitionBy("shard").parquet(f"{folder}/blocks")

    entries = _entries(_read_blocks(spark, folder).drop("payload")).where("doc_id is not null")
    first = entries.groupBy("doc_id").agg(
        F.min(F.struct("shard", "block", "offset", "length")).alias("at")).select("doc_id", "at.*")
    count = _read_blocks(spark, folder).agg(F.sum(F.size("doc_ids"))).first()[0] or 0
    buckets = 1 + count // keys_per_bucket
    spark.range(1).select(F.lit(buckets).cast("long").alias("buckets")).write.parquet(f"{folder}/size")
    index = first.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInPandas(_index_bucket, "bucket long, hash binary, slots binary")
    (index.withColumn("part", F.call_function("div", F.col("bucket"), F.lit(BUCKETS_PER_PART))).repartition("part")
     .sortWithinPartitions("part", "bucket").write.option("parquet.block.size", block_bytes).partitionBy("part").parquet(f"{folder}/index"))


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("long")


def _read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("bucket long, hash binary, slots binary, part long").parquet(f"{folder}/index")


def _buckets(spark: SparkSession, folder: str) -> int:
    return spark.read.schema("buckets long").parquet(f"{folder}/size").first()[0]


def _read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")


def _entries(blocks: DataFrame) -> DataFrame:
    """One row per document: doc_id, shard, block, offset in the block, length."""
    own = blocks.select("shard", "block", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("i", "doc"))
    place = Window.partitionBy("shard", "block").orderBy("i")
    before = F.sum("doc.lengths").over(place) - F.col("doc.lengths")
    return own.select(F.col("doc.doc_ids").alias("doc_id"), "shard", "block", before.alias("offset"),
                      F.col("doc.lengths").alias("length"))


def _index_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    keys = rows.doc_id.to_numpy(np.int64)
    index = PerfectHash.build(keys)
    slots = np.zeros(len(keys), SLOT)
    at = index.numbers(keys)
    slots["check"][at] = fingerprints(keys)
    for name in ("shard", "block", "offset", "length"):
        slots[name][at] = rows[name].to_numpy()
    return pd.DataFrame({"bucket": rows.bucket.iloc[:1], "hash": [index.dump()], "slots": [slots.tobytes()]})


def lookup(keys: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, shard, block, offset, length) of each distinct key that the dataset holds; other keys give no row."""
    spark = keys.sparkSession
    index = _read_index(spark, folder).drop("part")
    wanted = keys.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    wanted = wanted.withColumn("bucket", _bucket(_buckets(spark, folder)))

    def find(asked: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
        names = ["shard", "block", "offset", "length"]
        if not len(row) or not len(asked):
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in ["doc_id", *names]})
        asked = asked.doc_id.to_numpy(np.int64)
        slots = np.frombuffer(row.slots.iloc[0], SLOT)
        at = PerfectHash.load(row["hash"].iloc[0]).numbers(asked)
        held = (at >= 0) & (slots["check"][at] == fingerprints(asked))
        found = slots[at[held]]
        return pd.DataFrame({"doc_id": asked[held]} | {c: found[c].astype(np.int64) for c in names})

    return wanted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
        find, "doc_id long, shard long, block long, offset long, length long")


def key_rows(spark: SparkSession, folder: str, key: int) -> tuple[DataFrame, DataFrame | None]:
    """The index row of a key's bucket and, if the key is in the dataset, its ids' bytes; each read from one folder."""
    hashed = spark.range(1).select(F.lit(key).cast("long").alias("doc_id"))
    bucket = hashed.select(_bucket(_buckets(spark, folder))).first()[0]
    index = _read_index(spark, folder).where((F.col("part") == bucket // BUCKETS_PER_PART) & (F.col("bucket") == bucket))
    row = index.first()
    if row is None:
        return index, None
    wanted = np.array([key], np.int64)
    slots = np.frombuffer(row["slots"], SLOT)
    at = int(PerfectHash.load(row["hash"]).numbers(wanted)[0])
    if at < 0 or slots["check"][at] != fingerprints(wanted)[0]:
        return index, None
    shard, block, offset, length = (int(slots[name][at]) for name in ("shard", "block", "offset", "length"))
    block = _read_blocks(spark, folder).where((F.col("shard") == shard) & (F.col("block") == block))
    start, size = F.lit(offset) * F.col("width") + 1, F.lit(length) * F.col("width")
    return index, block.select("width", F.substring("payload", start, size).alias("ids"))


def fetch_key(spark: SparkSession, folder: str, key: int) -> list[int] | None:
    """The ids of one document, or None where the dataset does not hold the key (but for one in 2^32 others)."""
    block = key_rows(spark, folder, key)[1]
    if block is None:
        return None
    row = block.first()
    return np.frombuffer(row["ids"], f"<u{row['width']}").tolist()


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document in the blocks: doc_id, shard, block, offset, length, ids (array<long>)."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, at = np.frombuffer(row["payload"], f"<u{row['width']}").astype(np.int64), 0
                for key, n in zip(row["doc_ids"], row["lengths"]):
                    yield pa.RecordBatch.from_pylist([{
                        "doc_id": key, "shard": row["shard"], "block": row["block"], "offset": at, "length": n,
                        "ids": ids[at:at + n].tolist()}], schema=pa.schema([
                            ("doc_id", pa.int64()), ("shard", pa.int64()), ("block", pa.int64()),
                            ("offset", pa.int64()), ("length", pa.int64()), ("ids", pa.list_(pa.int64()))]))
                    at += n

    return _read_blocks(spark, folder).mapInArrow(
        run, "doc_id long, shard long, block long, offset long, length long, ids array<long>")


def fetch(keys: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids) of each distinct key in the dataset, reading only the blocks that hold one."""
    spans = lookup(keys, folder, id_col)
    blocks = _read_blocks(keys.sparkSession, folder).select("shard", "block", "width", "payload")

    def cut(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays([
                pa.array([r["doc_id"] for r in rows], pa.int64()),
                pa.array([np.frombuffer(r["part"], f"<u{r['width']}").astype(np.int64) for r in rows],
                         pa.list_(pa.int64()))], names=["doc_id", "ids"])

    part = F.expr("substring(payload, cast(offset * width + 1 as int), cast(length * width as int))")
    return spans.join(blocks, ["shard", "block"]).select("doc_id", "width", part.alias("part")).mapInArrow(
        cut, "doc_id long, ids array<long>")


def checked(spark: SparkSession, folder: str) -> DataFrame:
    """Reads the dataset back. Per document: doc_id, start (ids before it), n_tokens, ids_crc32, keyed.

    `keyed` says that the index leads from the document's id to just this place; of rows that share an id, only to the
    first. Starts come from running sums in two levels: over blocks within each shard, and over the shards' totals.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int64()), ("block", pa.int64()), ("offset", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["payload"], f"<u{row['width']}").astype("<u4")
                ends = np.cumsum([0, *row["lengths"]])
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends, ends[1:])]
                n = len(crc)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array([row["shard"]] * n, pa.int64()),
                    pa.array([row["block"]] * n, pa.int64()), pa.array(ends[:-1], pa.int64()),
                    pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())], schema=schema)

    blocks = _read_blocks(spark, folder)
    docs = blocks.mapInArrow(run, "doc_id long, shard long, block long, offset long, n_tokens long, ids_crc32 long")
    sizes = blocks.groupBy("shard", "block").agg(F.sum("n_tokens").alias("n"))
    within = Window.partitionBy("shard").orderBy("block")
    totals = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    shards = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    starts = sizes.withColumn("block_start", F.sum("n").over(within) - F.col("n")).join(shards, "shard").select(
        F.col("shard").cast("long").alias("shard"), F.col("block").cast("long").alias("block"),
        (F.col("shard_start") + F.col("block_start")).alias("at"))
    found = lookup(blocks.select(F.explode("doc_ids").alias("doc_id")), folder).select(
        F.col("doc_id").alias("key"), "shard", "block", "offset", F.col("length").alias("key_length"))
    whole = docs.join(starts, ["shard", "block"]).join(found, ["shard", "block", "offset"], "left")
    keyed = F.coalesce((F.col("key") == F.col("doc_id")) & (F.col("key_length") == F.col("n_tokens")), F.lit(False))
    return whole.select("doc_id", (F.col("at") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32",
                        keyed.alias("keyed"))
