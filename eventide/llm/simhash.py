"""SimHash near-duplicates found by meet-in-the-middle ball hashing.

Two fingerprints differ in at most 2r bits exactly if their balls of radius r share a fingerprint. So every distinct
fingerprint emits all variants within r (65 for r = 1), and variants are shuffled. Members of a variant's bucket lie
within 2r of each other, so tying each to the bucket's smallest keeps every link's component without listing pairs;
a bucket holds at most 65 distinct fingerprints, however many copies a document has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.components import components
from eventide.llm.tables import batched, rows_of, stored, texts_of

SHINGLE, SEED = 3, 42


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash, as a signed number. No words: 0; fewer words than a shingle: one shingle of all."""
    words = text.lower().split()  # for bytes: lower-cases A-Z only, splits at ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, seed) for p in parts), np.uint64, max(1, len(words) - shingle + 1))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at:at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        yield from batched(((key, fingerprint(text, shingle)) for key, text in rows_of(batches)), schema)

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def variants(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, variant) for every 64-bit number within `radius` bits of fp."""
    masks = {0}
    for _ in range(radius):
        masks |= {m ^ (1 << bit) for m in masks for bit in range(64)}
    signed = sorted(m - (1 << 64) if m >> 63 else m for m in masks)
    flips = F.array(*(F.lit(m).cast("long") for m in signed))
    return fps.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))


def near_links(fps: DataFrame, radius: int = 1) -> DataFrame:
    """Verified links (a, b), a > b, between distinct fingerprints of at most 2 * radius differing bits.

    Not every pair: each bucket ties its members to its smallest, which joins the same components.
    """
    bucket = Window.partitionBy("variant")
    tied = variants(fps, radius).select("fp", F.min("fp").over(bucket).alias("least")).where("fp <> least")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= 2 * radius
    return tied.where(near).select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 1,
                    shingle: int = SHINGLE) -> DataFrame:
    """Per row of `docs`: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Null or blank texts have fingerprint zero and link like any other. Repeated rows each give a row. A null doc_id
    gives a row but is never a component's smallest (the id is null only where no member has one).
    """
    own = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    least = own.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(near_links(least.select("fp"), radius))
    classes = least.join(roots, least.fp == roots.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    ids = stored(classes, "simhash-classes")
    names = ids.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = ids.join(names, "root").select(F.col("fp").alias("fp_"), "component_id")
    return own.join(labels, own.fp == labels.fp_).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
