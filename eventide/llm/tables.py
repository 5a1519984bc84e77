"""Reading the training-data tables, and writing tables that steps share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import durable_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and text columns alone, as `doc_id` and `text`: other columns can not clash with an operator's own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: later steps survive lost executors and repeat no work."""
    spark = df.sparkSession
    path = durable_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows_of(batches: Iterable[pa.RecordBatch], id_col: str = "doc_id", text_col: str = "text") -> Iterator[tuple]:
    """(id, UTF-8 bytes) of each row, without a Python string for the text; a null text is empty."""
    for batch in batches:
        ids = batch.column(id_col).to_pylist()
        for key, text in zip(ids, batch.column(text_col).cast(pa.binary())):
            yield key, text.as_py() or b""


def batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches of at most `size` rows."""
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) >= size:
            yield _batch(kept, schema)
            kept = []
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
