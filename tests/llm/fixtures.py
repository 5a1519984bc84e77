"""Small tables for the operators' tests, with the cases every operator must take."""

from __future__ import annotations

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The same table with columns of names that operators use inside."""
    for name in ("fp", "variant", "shard", "bucket", "id", "part", "word", "margin", "row", "tie", "h", "l"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)
