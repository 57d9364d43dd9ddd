"""Slices of bars by timeframe and source, and the read calls built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import TIMEFRAMES
from tickloom.operators.bars import latest, latest_n, rollup, time_slice

#: Limits of the read calls.
MOST_BARS, MOST_LATEST = 50_000, 10_000


def check_slice(timeframe: str, source: str) -> None:
    """One-second data exists only as own bars, official bars only by the minute."""
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {timeframe!r}")
    if source not in ("bars", "klines"):
        raise ValueError(f"unknown source {source!r}")
    if source == "klines" and timeframe != "1m":
        raise ValueError("official bars have the timeframe 1m only")


def bars_at(bars: DataFrame, timeframe: str, start=None, end=None, symbols: list[str] | None = None) -> DataFrame:
    """Bars of a timeframe; the filters are applied to the finest bars, before the rollup.

    ``start`` and ``end`` should lie on bucket borders, so that buckets are whole.
    """
    base = time_slice(bars, symbols, start, end)
    return base if timeframe == "1s" else rollup(base, TIMEFRAMES[timeframe])


def of_day(bars: DataFrame, day=None, ts: str = "ts") -> DataFrame:
    """The rows of one day, by default today's, as a range of times that reaches the scan."""
    start = F.to_timestamp_ntz(F.date_format(F.current_date() if day is None else F.lit(day), "yyyy-MM-dd"))
    if dict(bars.dtypes)[ts] == "timestamp":
        start = start.cast("timestamp")
    return bars.where((F.col(ts) >= start) & (F.col(ts) < start + F.make_dt_interval(F.lit(1))))


def slice_of(own: DataFrame, official: DataFrame, symbols: list[str], start, end, timeframe: str, source: str = "bars") -> DataFrame:
    """The rows to export, ordered by symbol and time."""
    check_slice(timeframe, source)
    rows = bars_at(own, timeframe, start, end, symbols) if source == "bars" else time_slice(official, symbols, start, end)
    return rows.orderBy("symbol", "ts")


class Engine:
    """The read calls of a service over one frame of finest bars."""

    def __init__(self, bars: DataFrame, macro: DataFrame | None = None) -> None:
        self.finest, self.macro_bars = bars, macro

    def symbols(self) -> DataFrame:
        return self.finest.select("exchange", "symbol").distinct()

    def bars(self, symbol: str, timeframe: str = "1m", start=None, end=None, limit: int = 1000) -> DataFrame:
        """The newest ``limit`` bars in the range, newest first."""
        if not 1 <= limit <= MOST_BARS:
            raise ValueError(f"limit must be from 1 to {MOST_BARS}")
        return bars_at(self.finest, timeframe, start, end, [symbol]).orderBy(F.desc("ts")).limit(limit)

    def latest(self, symbol: str, timeframe: str = "1m", limit: int = 60) -> DataFrame:
        """The newest bars in ascending order."""
        if not 1 <= limit <= MOST_LATEST:
            raise ValueError(f"limit must be from 1 to {MOST_LATEST}")
        return latest_n(bars_at(self.finest, timeframe, symbols=[symbol]), symbol, limit)

    def prices(self) -> DataFrame:
        return latest(self.finest)

    def macro(self, ticker: str, limit: int = 1000) -> DataFrame:
        if self.macro_bars is None:
            raise ValueError("no macro bars")
        return self.macro_bars.where(F.col("ticker") == ticker).orderBy(F.desc("ts")).limit(limit)
