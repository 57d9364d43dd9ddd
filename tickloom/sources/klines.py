"""Official bars and macro bars: typed rows from arrays, and a batch source for paged services."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tickloom.functions.scalars import clean, number

#: Minutes that one request returns at most.
PAGE = 1000


def typed(rows: DataFrame) -> DataFrame:
    """(symbol, kline array<string>) as official bars; bad numbers become null."""
    at = lambda i: F.try_element_at("kline", F.lit(i + 1))
    ts = lambda i: F.timestamp_millis(at(i).try_cast("bigint"))
    names = ("open", "high", "low", "close", "volume")
    return rows.select("symbol", ts(0).alias("open_time"), ts(6).alias("close_time"), *[number(at(i + 1)).alias(n) for i, n in enumerate(names)], number(at(7)).alias("quote_volume"), at(8).try_cast("bigint").alias("trades"), number(at(9)).alias("taker_base_vol"), number(at(10)).alias("taker_quote_vol"))


def macro(rows: DataFrame) -> DataFrame:
    """Macro bars cleaned: rows without all prices drop, missing volume is 0."""
    prices = {c: clean(F.col(c).cast("double")) for c in ("open", "high", "low", "close")}
    volume = F.coalesce(clean(F.col("volume").cast("double")), F.lit(0.0)).cast("bigint")
    return rows.select("ticker", F.col("ts").cast("timestamp").alias("ts"), *[v.alias(c) for c, v in prices.items()], volume.alias("volume")).dropna(subset=list(prices))


class Page(InputPartition):
    """One request: a symbol and the minutes [start, stop) in epoch milliseconds."""

    def __init__(self, symbol: str, start: int, stop: int) -> None:
        super().__init__((symbol, start, stop))


def pages(symbols: list[str], start: int, stop: int, minutes: int = PAGE) -> list[Page]:
    """Requests that cover the range for every symbol; a day takes two of 1,000 minutes."""
    step = minutes * 60_000
    return [Page(s, a, min(a + step, stop)) for s in symbols for a in range(start, stop, step)]


def with_retries(call: Callable[[], list], tries: int = 5, wait: Callable[[float], None] | None = None, base: float = 2.0, most: float = 60.0) -> list:
    """Call until it works, waiting ``min(base ** n, most)`` seconds, or as long as a limit error asks."""
    for n in range(tries):
        try:
            return call()
        except ConnectionError as error:
            if n == tries - 1:
                raise
            (wait or (lambda _: None))(getattr(error, "retry_after", None) or min(base**n, most))
    return []


class KlineSource(DataSource):
    """Batch source ``klines``: options symbols, start, stop (ISO, UTC) and ``fetch``, an importable ``module:function``.

    The function takes (symbol, start_ms, stop_ms) and returns rows of strings; each page is
    one partition, so a lost executor repeats only its own requests.
    """

    @classmethod
    def name(cls) -> str:
        return "klines"

    def schema(self) -> str:
        return "symbol string, kline array<string>"

    def reader(self, schema) -> DataSourceReader:
        return KlineReader(self.options)


class KlineReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[Page]:
        ms = lambda text: int(datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp() * 1000)
        return pages(self.options["symbols"].split(","), ms(self.options["start"]), ms(self.options["stop"]))

    def read(self, partition: Page) -> Iterator[tuple]:
        import importlib

        module, _, function = self.options["fetch"].partition(":")
        symbol, start, stop = partition.value
        fetch = getattr(importlib.import_module(module), function)
        for row in with_retries(lambda: fetch(symbol, start, stop)):
            yield symbol, [None if x is None else str(x) for x in row]
