"""Text log scans. Every parser takes a DataFrame with one string column holding the lines, so the
same code serves `spark.read.text`, `spark.readStream.text` and a Kafka value column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.eventtime import from_millis, from_seconds
from eventide.sources import schemas as S


def _typed(text: Column, kind: str, name: str) -> Column:
    """Cast that stops the job on a bad or missing field instead of passing a null on."""
    bad = F.raise_error(F.concat(F.lit(f"bad {name}: "), F.coalesce(text, F.lit("missing"))))
    value = text if kind == "string" else text.try_cast(kind)
    return F.coalesce(value, bad.cast(kind))


def row_id(line: Column) -> Column:
    """A number for a line: the same whenever and wherever the line is read, in a batch or a stream. Lines that repeat
    share it; they are equal in all else too."""
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("bigint")


def _id_column(line: str, with_id: bool) -> list[Column]:
    return [row_id(F.col(line)).alias("event_id")] if with_id else []


#: Event times by the name of the field they come from.
_TIMES = {"ts_s": from_seconds, "ts_ms": from_millis}


def _delimited(lines: DataFrame, fields: tuple, line: str, with_id: bool) -> DataFrame:
    parts = F.split(F.col(line), ",")
    cols = []
    for i, (name, kind) in enumerate(fields):
        value = _typed(F.get(parts, i), kind, name)
        cols.append(_TIMES[name](value).alias("ts") if name in _TIMES else value.alias(name))
    return lines.select(*_id_column(line, with_id), *cols)


def parse_behavior_log(lines: DataFrame, line: str = "value", with_id: bool = False) -> DataFrame:
    return _delimited(lines, S.BEHAVIOR, line, with_id)


def parse_login_log(lines: DataFrame, line: str = "value", with_id: bool = False) -> DataFrame:
    return _delimited(lines, S.LOGIN, line, with_id)


def parse_order_log(lines: DataFrame, line: str = "value", with_id: bool = False) -> DataFrame:
    """tx_id stays the empty string on create rows."""
    return _delimited(lines, S.ORDER, line, with_id)


def parse_receipt_log(lines: DataFrame, line: str = "value", with_id: bool = False) -> DataFrame:
    return _delimited(lines, S.RECEIPT, line, with_id)


def parse_ad_log(lines: DataFrame, line: str = "value", with_id: bool = False) -> DataFrame:
    return _delimited(lines, S.AD_CLICK, line, with_id)


def parse_market_log(lines: DataFrame, line: str = "value", with_id: bool = False) -> DataFrame:
    return _delimited(lines, S.MARKET, line, with_id)


def parse_access_log(lines: DataFrame, line: str = "value", with_id: bool = False) -> DataFrame:
    parts = F.split(F.col(line), " ")
    token = {name: F.get(parts, i) for name, i in S.ACCESS_TOKENS.items()}
    # The zone is spelled out, so that the session's plays no part.
    when = F.try_to_timestamp(F.concat(token["time"], F.lit(" +0000")), F.lit(f"{S.ACCESS_TIME_FORMAT} Z"))
    bad = F.raise_error(F.concat(F.lit("bad time: "), F.coalesce(token["time"], F.lit("missing"))))
    return lines.select(
        *_id_column(line, with_id),
        *[_typed(token[name], "string", name).alias(name) for name in ("ip", "user_id", "method", "url")],
        F.coalesce(when, bad.cast("timestamp")).alias("ts"),
    )


def payments(orders: DataFrame) -> DataFrame:
    """The pays of an order log with ids, as one side of the reconciliation; the order rides along."""
    return (orders.filter(F.col("event_type") == "pay")
            .select("tx_id", F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts"), "order_id"))


def receipts(receipt_log: DataFrame) -> DataFrame:
    """A receipt log with ids as the other side; the channel rides along."""
    return receipt_log.select("tx_id", F.col("event_id").alias("receipt_id"), F.col("ts").alias("receipt_ts"), "pay_channel")


_PARSERS = {
    "behavior": parse_behavior_log,
    "login": parse_login_log,
    "order": parse_order_log,
    "receipt": parse_receipt_log,
    "ad": parse_ad_log,
    "access": parse_access_log,
    "market": parse_market_log,
}


def read_log(spark: SparkSession, kind: str, path: str, with_id: bool = False) -> DataFrame:
    """With ids, the rows of a log go straight into the pattern operators."""
    return _PARSERS[kind](spark.read.text(path), with_id=with_id)


def stream_log(spark: SparkSession, kind: str, path: str, files_per_trigger: int | None = None,
               with_id: bool = False) -> DataFrame:
    """Unbounded line source over a directory that keeps receiving files."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _PARSERS[kind](reader.text(path), with_id=with_id)


def stream_log_kafka(spark: SparkSession, kind: str, servers: str, topic: str, with_id: bool = False) -> DataFrame:
    """Unbounded line source over a topic; needs the Kafka connector on the class path."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", servers).option("subscribe", topic).load())
    return _PARSERS[kind](raw.select(F.col("value").cast("string").alias("value")), with_id=with_id)
