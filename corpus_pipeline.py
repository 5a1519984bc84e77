"""The corpus pipeline: `documents` through the stages of STAGES, each written as Parquet and read by the next.

A stage drops rows by their doc_id: rows that share an id are one document, and go or stay together. Rows with a null
doc_id stay, but for those that a stage judges row by row.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import decontamination, language, pieces, simhash, suffix_dedup
from eventide.llm.tables import stored, table


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not identified: no letters, letters that fit none of the languages, or no
    language likely enough.

    The text model learns from the documents' own labels; the label is also the declared language, the source the host.
    """
    found = language.identify(docs, language.train(docs), "doc_id", "text", "lang", "source", label_col="lang")
    return _without(docs, found.where("rejected").withColumnRenamed("id", "doc_id"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies."""
    return _without(docs, simhash.near_duplicates(docs).where("doc_id <> component_id"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out strings of 50 bytes and more that an earlier document has."""
    return suffix_dedup.without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more stands in test items."""
    return _without(docs, decontamination.contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded."""
    coded = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece", encode),
]
#: Several stages hash and train; SQL can not express them. The tests hold the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
