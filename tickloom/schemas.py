"""Schemas (as DDL text) of ticks, bars, official bars, violations and anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame


TICK = "exchange string, symbol string, ts_event bigint, ts_recv bigint, price double, qty double, side string, bid double, ask double, stream string, trade_id bigint"
BAR = "exchange string, symbol string, ts timestamp, open double, high double, low double, close double, volume_base double, volume_quote double, trade_count bigint, vwap double, bid double, ask double, spread double"
KLINE = "symbol string, open_time timestamp, close_time timestamp, open double, high double, low double, close double, volume double, quote_volume double, trades bigint, taker_base_vol double, taker_quote_vol double"
MACRO = "ticker string, ts timestamp, open double, high double, low double, close double, volume bigint"
CONNECTION = "event string, exchange string, ts string, reason string, gap_seconds double"
VIOLATION = "symbol string, ts timestamp, rule string, severity string, detail string, row_sample string"
ANOMALY = "symbol string, ts timestamp, detector string, features map<string,double>, label string, rationale string, confidence double, cluster struct<count:bigint,start_ts:timestamp,end_ts:timestamp,max_abs_z:double>"

#: Columns that every stored bar has.
BAR_COLUMNS = ("window_start", "symbol", "open", "high", "low", "close", "volume_base", "volume_quote", "trade_count", "vwap", "bid", "ask", "spread")

#: The columns of the relational export of each table; fixed names of the storage contract.
EXPORTS = {
    "bars": ("symbol", "ts", "open", "high", "low", "close", "volume_base", "volume_quote", "trade_count", "vwap", "bid", "ask", "spread"),
    "klines_1m": ("symbol", "ts", "open", "high", "low", "close", "volume", "trades"),
    "compare": ("symbol", "ts", "diff_open", "diff_high", "diff_low", "diff_close", "abs_error"),
}


def column_difference(df: DataFrame, expected: tuple[str, ...], ignore: tuple[str, ...] = ("year", "month", "day")) -> dict[str, list[str]]:
    """Missing and extra columns against a contract, without the partition columns."""
    own, wanted = set(df.columns) - set(ignore), set(expected) - set(ignore)
    return {"missing": sorted(wanted - own), "extra": sorted(own - wanted)}
