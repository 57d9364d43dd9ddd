"""The preview of anomalies on a stream: keyed state with timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql import functions as F

from tickloom.operators.detect import Shown
from tickloom.operators.ordered import series_keys

#: The state store that keyed state with timers needs.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Preview(StatefulProcessor):
    """Rows of a key wait until the watermark has passed them, then are walked in time order.

    State: the last printed time, and the rows that still wait, as many as lateness allows.
    """

    def __init__(self, quiet: int, columns: list[str]) -> None:
        self.quiet, self.columns = quiet, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.shown = handle.getValueState("shown", "at bigint")
        self.waiting = handle.getListState("waiting", "at bigint, z double")

    def _release(self, key: tuple, rows: list[tuple], until: int) -> Iterator[pd.DataFrame]:
        """Print what is due of the rows that wait, and set the timer for the next."""
        due, later = sorted(r for r in rows if r[0] < until), sorted(r for r in rows if r[0] >= until)
        last = self.shown.get()
        keep, shown = Shown(None if last is None else last[0], self.quiet).walk([at for at, _ in due])
        if shown.at is not None:
            self.shown.update((shown.at,))
        if later:
            self.waiting.put(later)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(later[0][0] // 1000 + 1)
        else:
            self.waiting.clear()
        out = [(*key, pd.Timestamp(at, unit="us"), z) for (at, z), k in zip(due, keep, strict=True) if k]
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        waiting = [tuple(r) for r in self.waiting.get()]
        for part in rows:
            waiting += [(int(at), float(z)) for at, z in zip(part["at"], part["z"], strict=True)]
        yield from self._release(key, waiting, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting = [tuple(r) for r in self.waiting.get()]
        yield from self._release(key, waiting, timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


def live_preview(anomalies: DataFrame, quiet_seconds: float = 2.0, late: str = "1 minute") -> DataFrame:
    """``detect.preview`` of a stream of anomalies: the same rows, each once its time can get no earlier rows.

    Rows later than ``late`` behind the newest are dropped, as for any watermark.  The session
    must use the state store ``STORE``.
    """
    keys = [*series_keys(anomalies), "detector"]
    rows = anomalies.withWatermark("ts", late).select(*keys, "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "z")
    schema = rows.select(*keys, "ts", "z").schema
    processor = Preview(round(quiet_seconds * 1_000_000), schema.names)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def write_preview(shown: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Printed rows as Parquet; reads what is there and stops, and goes on from the checkpoint when called again."""
    spark: SparkSession = shown.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return shown.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
