"""Running a stream to the end of its input, and the sinks the twins share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.eventtime import epoch_micros
from eventide.session import durable_dir, use_utc
from eventide.sources.tables import instants

#: State stores of a stream, unless the session's setting of this name says otherwise.
STATE_STORES = 8
STORES_CONF = "eventide.stream.stores"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows of this key and time only push the watermark.
FLUSH_KEY = -1
FLUSH_AT = datetime(2200, 1, 1, tzinfo=timezone.utc)


def stream_session(spark: SparkSession, stores: int | None = None) -> SparkSession:
    """A session of its own, so that state settings do not leak into batch queries.

    `stores` is the number of state stores, which a checkpoint keeps for its life: as many as tasks
    that the stream may ever need, whatever executors are up when it starts. On a cluster, set it here
    or as `eventide.stream.stores` in the session.
    """
    stores = stores or int(spark.conf.get(STORES_CONF, str(STATE_STORES)))
    own = spark.newSession()
    use_utc(own)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.shuffle.partitions", str(stores))
    return own


def events_stream(spark: SparkSession, folder: str, pattern: str = "events.parquet",
                  files_per_trigger: int | None = None) -> DataFrame:
    """The event files of a folder as a stream, in the raw types of the files."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


class Replay:
    """A finite replay of event files.

    `end()` adds one far-future row per event type, which lets the watermark pass all real rows, the
    way the end of a bounded input closes every window. It is to be called once the files have been
    processed: a row that far ahead makes everything after it late.
    """

    def __init__(self, spark: SparkSession, folder: str, event_types: list[str], **options):
        raw = events_stream(spark, folder, **options)
        self._schema, self._types = raw.schema, event_types
        self._spark, self._path = spark, durable_dir(spark, "flush")
        self._rows([]).write.parquet(self._path)
        self.events = instants(raw.unionByName(spark.readStream.schema(raw.schema).parquet(self._path)))

    def end(self) -> None:
        self._rows(self._types).coalesce(1).write.mode("append").parquet(self._path)

    def _rows(self, event_types: list[str]) -> DataFrame:
        fixed = {"ts": F.lit(FLUSH_AT), "user_id": F.lit(FLUSH_KEY), "event_type": F.col("kind"),
                 "event_id": F.lit(-1), "props": F.lit('{"k": 0}')}
        return (self._spark.createDataFrame([(kind,) for kind in event_types], "kind string")
                .select(*[fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                          for f in self._schema]))


def in_time_order(spark: SparkSession, folder: str, pieces: int, pattern: str = "events.parquet") -> str:
    """The event files of a folder as a new folder of `pieces` consecutive stretches of time, written one after another:
    a replay that takes a file at a time sees time pass. Rows without a time come first."""
    rows = spark.read.option("pathGlobFilter", pattern).parquet(folder)
    path = durable_dir(spark, "in-order")
    t = epoch_micros(F.col("ts").cast("timestamp"))
    low, high = rows.agg(F.min(t), F.max(t)).first()
    part = F.least(F.call_function("div", (t - F.lit(low)) * pieces, F.lit(max((high or 0) - (low or 0), 1))), F.lit(pieces - 1))
    for i in range(pieces):
        rows.filter(F.coalesce(part, F.lit(0)) == i).write.mode("append").parquet(path)
    return path


def append_batches(path: str, transform: Callable[[DataFrame], DataFrame] | None = None):
    """Sink that keeps each micro-batch in a folder of its own: a batch run again after a failure
    replaces its own rows and nothing else."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def run(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
        mode: str = "append") -> None:
    """Processes all input there is, then stops. The same checkpoint continues where it ended."""
    query = (stream.writeStream.outputMode(mode).foreachBatch(sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def collect_ended(end: Callable[[], None], stream: DataFrame, label: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Runs an append-mode stream over all its input, then over what `end` adds to it, and returns what it wrote."""
    spark = stream.sparkSession
    home = durable_dir(spark, label)
    sink = append_batches(f"{home}/out", transform)
    run(stream, sink, f"{home}/checkpoint")
    end()
    run(stream, sink, f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/out").drop("batch_id")


def collect_appended(replay: Replay, stream: DataFrame, label: str,
                     transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Runs an append-mode stream over a replay to its end and returns what it wrote."""
    return collect_ended(replay.end, stream, label, transform)
