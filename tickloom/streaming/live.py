"""Structured Streaming: ingest, live bars, sessions, routing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom import schemas
from tickloom.operators.bars import finished, merge_partials, partial_bars, tick_bars
from tickloom.operators.detect import clusters
from tickloom.sinks.lake import PARTITIONS, with_day_columns
from tickloom.sources.wire import parse


def tick_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Tick JSON lines as they arrive, with event time ``ts``.

    ``files_per_trigger`` bounds a batch: nothing is dropped when data comes faster, it waits.
    """
    raw = spark.readStream.schema(schemas.TICK).option("maxFilesPerTrigger", files_per_trigger).json(path)
    return raw.withColumn("ts", F.timestamp_millis("ts_event"))


def message_stream(spark: SparkSession, path: str, exchange: str) -> DataFrame:
    """Raw exchange messages, one JSON text a line, as ticks."""
    lines = spark.readStream.text(path).select(F.col("value").alias("message"), F.unix_millis(F.current_timestamp()).alias("ts_recv"))
    return parse(exchange, lines).withColumn("ts", F.timestamp_millis("ts_event"))


def live_bars(ticks: DataFrame, seconds: int = 1, late: str = "10 seconds") -> DataFrame:
    """Bars by event time; a tick within ``late`` of the newest goes to its own bucket."""
    return tick_bars(ticks.withWatermark("ts", late), seconds)


def live_candle(ticks: DataFrame, seconds: int = 60, late: str = "5 minutes") -> DataFrame:
    """The same for display in update mode: each batch gives the candles that changed."""
    return live_bars(ticks.where("stream = 'trade'"), seconds, late).select("exchange", "symbol", "ts", "open", "high", "low", "close", "volume_base")


def live_clusters(anomalies: DataFrame, cooldown_seconds: int = 5, late: str = "1 minute") -> DataFrame:
    """Bursts of anomalies as sessions that close when the watermark passes."""
    return clusters(anomalies.withWatermark("ts", late), cooldown_seconds)


def channel(ticks: DataFrame, symbols: str = "*", types: str = "all") -> DataFrame:
    """A subscriber's part of the stream; a ``*`` or ``all`` on either side means everything."""
    if symbols == "*" or types == "all":
        return ticks
    wanted = [f"{t.strip()}:{s.strip()}" for s in symbols.split(",") for t in types.split(",")]
    return ticks.where(F.concat_ws(":", "stream", "symbol").isin(wanted))


def write_rotated(ticks: DataFrame, path: str, checkpoint: str, every: str = "60 seconds") -> StreamingQuery:
    """JSON files by exchange, symbol and day of receipt, one set for each interval."""
    day = F.date_format(F.timestamp_millis("ts_recv"), "yyyy-MM-dd")
    return ticks.drop("ts").withColumn("date", day).writeStream.format("json").partitionBy("exchange", "symbol", "date").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def write_bars(bars: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Closed bars as Parquet, each exactly once; ``once`` stops when the input is read."""
    made = bars.withColumn("date", F.to_date("ts")).writeStream.format("parquet").partitionBy("exchange", "date").option("path", path).option("checkpointLocation", checkpoint)
    return (made.trigger(availableNow=True) if once else made.trigger(processingTime="10 seconds")).start()


def upsert_batch(ticks: DataFrame, batch: int, root: str, partials: str, seconds: int = 1) -> None:
    """Bring one batch of ticks into the stored bars; the same batch again changes nothing.

    What the batch tells about its bars is written under its own number in ``partials``
    (exchange=/symbol=/year=/month=/day=/batch=), replacing what an earlier attempt left.
    The days that it touches are then put together from all their batches and replaced in
    ``root``, so a tick of any lateness repairs its bar.  Only those days are read.
    """
    if ticks.isEmpty():
        return
    spark = ticks.sparkSession
    parts = with_day_columns(partial_bars(ticks, seconds), "start").withColumn("batch", F.lit(batch))
    write = lambda df, path, keys: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    write(parts.repartition(*PARTITIONS), partials, [*PARTITIONS, "batch"])
    stored = spark.read.schema(parts.schema).parquet(partials)
    touched = stored.where(F.col("batch") == batch).select(*PARTITIONS).distinct()
    days = stored.join(F.broadcast(touched), PARTITIONS, "left_semi")  # a row for each symbol and day of the batch
    bars = with_day_columns(finished(merge_partials(days)))
    write(bars.repartition(*PARTITIONS).sortWithinPartitions(*PARTITIONS, "ts"), root, PARTITIONS)


def upsert_bars(ticks: DataFrame, root: str, partials: str, checkpoint: str, seconds: int = 1, once: bool = False, every: str = "60 seconds", after: Callable[[int], None] | None = None) -> StreamingQuery:
    """Keep the bars of the lake up to date with a stream of ticks, in micro-batches.

    The checkpoint numbers the batches; one that is replayed after a failure has the same
    number and the same ticks, see ``upsert_batch``.  ``after`` is told the number of each
    batch that is stored.
    """

    def bring(batch: DataFrame, number: int) -> None:
        upsert_batch(batch, number, root, partials, seconds)
        if after is not None:
            after(number)

    made = ticks.writeStream.foreachBatch(bring).option("checkpointLocation", checkpoint)
    return (made.trigger(availableNow=True) if once else made.trigger(processingTime=every)).start()
