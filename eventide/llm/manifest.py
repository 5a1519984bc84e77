"""Merkle manifest of a dataset: a tree of hashes over each group's rows, and one over the groups' roots.

Each group's nodes form a log in completion order (postorder): a node is written as soon as the last leaf below it has
been. Its place is then a closed form. When leaf e is written, the e leaves before it have finished 2e - popcount(e)
nodes, so that

    place of leaf e = 2e - popcount(e)
    place of a node = place of the last leaf below it + its level

A proof is read by those places alone; no pointers are stored and no tree is walked.

The log is cut into aligned segments of 2^SEGMENT_BITS leaves, each written by a builder of its own. The segments'
roots are the leaves of the next tier, built the same way, until one node per group remains. So neither a group of any
size nor any number of groups is ever held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.tables import batched, stored

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Leaves of a builder: 2 to this power.
SEGMENT_BITS = 10
HEX = 64


def leaf_hash(fields: list[Column]) -> Column:
    """sha256 of the fields one after another, each as byte count, colon and text; a null is a dash."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def node_hash(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def place(leaf: int, level: int, n: int) -> int:
    """Where the log of n leaves holds the node of this level above this leaf."""
    last = min(((leaf >> level) + 1) << level, n) - 1
    return 2 * last - last.bit_count() + level


def height(n: int) -> int:
    """Levels above the leaves of a tree of n."""
    return (n - 1).bit_length()


def build(leaves: list[str], levels: int) -> list[str]:
    """The nodes of `levels` levels over the leaves, in completion order; a node without a neighbour is hashed alone."""
    log: list[str] = []
    waiting = [""] * (levels + 1)
    for e, node in enumerate(leaves):
        log.append(node)
        for level in range(levels):
            if (e >> level) & 1:
                node = node_hash(waiting[level], node)
            elif e == len(leaves) - 1:
                node = node_hash(node)
            else:
                waiting[level] = node
                break
            log.append(node)
    return log


def siblings(log: str, leaf: int, levels: int, n: int) -> list[str]:
    """The path from a leaf up: per level 'L' or 'R' with the sibling's hash, or '' where there is none."""
    path = []
    for level in range(levels):
        other = (leaf >> level) ^ 1
        if other << level >= n:
            path.append("")
            continue
        at = HEX * place(other << level, level, n)
        path.append(("R" if other & 1 else "L") + log[at:at + HEX])
    return path


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its path lead to."""
    for step in path:
        leaf = node_hash(step[1:], leaf) if step[:1] == "L" else node_hash(leaf, step[1:])
    return leaf


@dataclass
class Forest:
    """Trees of many groups: the segments of each tier in the shared folder, and (grp, n, root) of each group."""

    tiers: list[DataFrame]
    roots: DataFrame


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `idx`, a row's number from 0 within its `grp` in the given order, and `n`, the group's size.

    Rows are dealt out by ranges of (grp, order) and numbered within their range; a range starts from the counts of
    those before it. A group of any size is so spread over many tasks.
    """
    ranged = stored(rows.repartitionByRange("grp", *order).withColumn("range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("grp", "range").agg(F.count(F.lit(1)).alias("here"))
    whole = Window.partitionBy("grp")
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("grp", "range", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("start"),
                           F.sum("here").over(whole).alias("n"))
    nth = F.row_number().over(Window.partitionBy("grp", "range").orderBy(*order))
    return (ranged.withColumn("nth", nth).join(starts, ["grp", "range"])
            .withColumn("idx", F.col("start") + F.col("nth") - 1).drop("range", "nth", "start"))


_SEGMENT = "grp string, segment long, n long, items long, log string, ids array<long>, given array<string>"


def _segments(items: DataFrame, bits: int) -> DataFrame:
    """One row a segment from (grp, idx, n, hash, id, given): its log, and its leaves' ids and given hashes."""
    schema = pa.schema([("grp", pa.string()), ("segment", pa.int64()), ("n", pa.int64()), ("items", pa.int64()),
                        ("log", pa.string()), ("ids", pa.list_(pa.int64())), ("given", pa.list_(pa.string()))])

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        n, leaves = table["n"][0].as_py(), table["hash"].to_pylist()
        log = build(leaves, bits if n > 1 << bits else height(n))
        return pa.table([[table["grp"][0].as_py()], [table["segment"][0].as_py()], [n], [len(leaves)], ["".join(log)],
                         [table["id"].to_pylist()], [table["given"].to_pylist()]], schema=schema)

    cut = items.select("grp", F.shiftright("idx", bits).alias("segment"), "idx", "n", "hash", "id", "given")
    return cut.groupBy("grp", "segment").applyInArrow(write, _SEGMENT)


def grow(items: DataFrame, bits: int = SEGMENT_BITS) -> Forest:
    """The trees over (grp, idx, n, hash, id, given): `id` and `given` come along for the proofs."""
    tiers: list[DataFrame] = []
    roots, many = None, F.col("n") > (1 << bits)
    while True:
        tier = stored(_segments(items, bits), "segments")
        tiers.append(tier)
        top = F.substring("log", -HEX, HEX)
        done = tier.where(~many).select("grp", "n", top.alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        if tier.where(many).isEmpty():
            return Forest(tiers, roots)
        none = F.lit(None)
        items = tier.where(many).select("grp", F.col("segment").alias("idx"), F.ceil(F.col("n") / (1 << bits)).alias("n"),
                                        top.alias("hash"), none.cast("long").alias("id"), none.cast("string").alias("given"))


_PROOF = pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("id", pa.int64()), ("leaf", pa.string()),
                    ("given", pa.string()), ("path", pa.list_(pa.string()))])


def proofs(forest: Forest, above: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """(grp, idx, id, leaf, given, path) of every leaf; `above` holds each group's path from its root up: (grp, path).

    Tiers are gone through from the top: the paths of one tier's leaves are what lies above the segments below it.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched((row for b in batches for seg in b.to_pylist() for row in rows(seg)), _PROOF)

    def rows(seg: dict) -> Iterator[tuple]:
        levels = bits if seg["n"] > 1 << bits else height(seg["n"])
        log, count, first = seg["log"], seg["items"], seg["segment"] << bits
        for e in range(count):
            at = HEX * place(e, 0, count)
            yield (seg["grp"], first + e, seg["ids"][e], log[at:at + HEX], seg["given"][e],
                   siblings(log, e, levels, count) + seg["path"])

    sql = "grp string, idx long, id long, leaf string, given string, path array<string>"
    below = None
    for tier in reversed(forest.tiers):
        tops = above.select("grp", F.lit(0).cast("long").alias("segment"), "path")
        known = tier.where(F.col("n") <= (1 << bits)).join(tops, ["grp", "segment"])
        if below is not None:
            over = below.select("grp", F.col("idx").alias("segment"), "path")
            known = known.unionByName(tier.where(F.col("n") > (1 << bits)).join(over, ["grp", "segment"]))
        below = known.mapInArrow(read, sql)
    return below


def tampered_chars(doc_id: Column, n_chars: Column) -> Column:
    """n_chars plus 1 where 7 divides the crc32 of the decimal id, else as it is."""
    hit = F.crc32(doc_id.cast("string")) % 7 == 0
    return F.when(hit, F.coalesce(F.try_add(n_chars, F.lit(1)), n_chars)).otherwise(n_chars)


def certified(docs: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, log_place, path of every document.

    A document is a leaf of its language's tree, in the order of doc_id; the languages' roots are the leaves of the
    last tree. The root is folded from the leaf of the row with tampered n_chars.

    Nulls in any column are hashed as a dash. A null language is a group of its own and comes first; documents without
    an id come first in their group and are never tampered. Equal ids go by leaf hash; rows that repeat are leaves
    each. Texts are hashed whole and by the JVM alone, empty and very long ones too. The largest n_chars is not raised
    any further. An empty table gives no rows. Other columns are ignored.
    """
    fields = [F.col(name) for name in FIELDS]
    other = [tampered_chars(F.col("doc_id"), F.col("n_chars")) if name == "n_chars" else F.col(name) for name in FIELDS]
    is_other = ~F.col("n_chars").eqNullSafe(other[FIELDS.index("n_chars")])
    # The name of a group sorts as its language does, null first, and is never null.
    named = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("grp"),
        F.col("doc_id").cast("long").alias("id"), leaf_hash(fields).alias("hash"),
        F.when(is_other, leaf_hash(other)).alias("given"))
    leaves = numbered(stored(named, "leaves"), ["id", "hash"])
    groups = grow(leaves, bits)
    none = F.lit(None)
    names = groups.roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("hash"))
    tops = grow(numbered(names, ["name"]).select("grp", "idx", "n", "hash", none.cast("long").alias("id"), F.col("name").alias("given")), bits)
    over = proofs(tops, tops.roots.select("grp", F.array().cast("array<string>").alias("path")), bits)
    above = stored(over.join(tops.roots.select("grp", "root"), "grp").select(
        F.col("given").alias("grp"), F.col("leaf").alias("subroot"), "root", "path"), "group-paths")
    found = proofs(groups, above.select("grp", "path"), bits).join(above.select("grp", "subroot", "root"), "grp")
    return _folded(found)


def _folded(found: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                        ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_()),
                        ("log_place", pa.int64()), ("path", pa.list_(pa.string()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in batch.to_pylist():
                path = row["path"]
                root = fold(row["given"] or row["leaf"], path)
                yield (row["id"], row["leaf"], row["subroot"], row["root"], node_hash(*[p[1:] for p in path]), root,
                       root == row["root"], 2 * row["idx"] - row["idx"].bit_count(), path)

    return found.mapInArrow(
        lambda batches: batched(rows(batches), schema),
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        "verified boolean, log_place long, path array<string>")
