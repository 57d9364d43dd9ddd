"""Exchange messages as ticks: one projection for each exchange.

The input has a string column ``message`` (one JSON text) and ``ts_recv`` (epoch
milliseconds).  Bad JSON gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import instant, number

def _tick(exchange: str, symbol: Column, ts_event: Column, stream: Column, price: Column, qty: Column, side: Column, bid: Column, ask: Column, trade_id: Column) -> list[Column]:
    trade, quote = stream == "trade", stream == "bookTicker"
    return [
        F.lit(exchange).alias("exchange"), symbol.alias("symbol"), ts_event.alias("ts_event"), F.col("ts_recv"),
        F.when(trade, price).alias("price"), F.when(trade, qty).alias("qty"), F.when(trade, side).alias("side"),
        F.when(quote, bid).alias("bid"), F.when(quote, ask).alias("ask"), stream.alias("stream"), F.when(trade, trade_id).alias("trade_id"),
    ]


def binance(raw: DataFrame) -> DataFrame:
    """Combined-stream messages; the stream name decides the kind, and the event type only where there is none."""
    # field names differ in case only (e and E), which a struct cannot hold
    body = F.coalesce(F.get_json_object("message", "$.data"), F.col("message"))
    rows = raw.withColumn("body", body)
    d = lambda name: F.get_json_object("body", f"$.{name}")
    name, kind = F.coalesce(F.get_json_object("message", "$.stream"), F.lit("")), F.lower(F.coalesce(d("e"), F.lit("")))
    stream = (
        F.when(name.contains("@trade"), "trade").when(name.contains("@bookTicker"), "bookTicker")
        .when((name == "") & kind.contains("trade"), "trade").when((name == "") & kind.contains("bookticker"), "bookTicker").otherwise(F.coalesce(F.nullif(d("e"), F.lit("")), F.lit("unknown")))
    )
    ms = lambda name: F.nullif(d(name).try_cast("bigint"), F.lit(0))
    kept = rows.where(d("s").isNotNull() | d("e").isNotNull())
    side = F.when(d("m") == "true", "sell").otherwise("buy")
    return kept.select(*_tick("binance", F.upper(d("s")), F.coalesce(ms("E"), ms("T"), F.col("ts_recv")), stream, number(d("p")), number(d("q")), side, number(d("b")), number(d("a")), d("t").try_cast("bigint")))


def coinbase(raw: DataFrame) -> DataFrame:
    """Matches are trades, tickers are quotes; control messages drop out."""
    d = F.from_json("message", "type string, product_id string, time string, price string, size string, side string, best_bid string, best_ask string, trade_id bigint")
    rows = raw.withColumn("d", d)
    stream = F.when(F.col("d.type").isin("match", "last_match"), "trade").when(F.col("d.type") == "ticker", "bookTicker")
    ts = F.coalesce(F.unix_millis(instant(F.col("d.time"))), F.col("ts_recv"))
    kept = rows.where(stream.isNotNull())
    return kept.select(*_tick("coinbase", F.col("d.product_id"), ts, stream, number(F.col("d.price")), number(F.col("d.size")), F.col("d.side"), number(F.col("d.best_bid")), number(F.col("d.best_ask")), F.col("d.trade_id")))


def kraken(raw: DataFrame, first_only: bool = False) -> DataFrame:
    """Every element of ``data`` is a tick; ``first_only`` keeps one for each message."""
    d = F.from_json("message", "channel string, data array<struct<symbol:string,price:string,qty:string,side:string,trade_id:bigint,timestamp:string,bid:string,ask:string>>")
    rows = raw.withColumn("d", d).where(F.col("d.channel").isin("trade", "ticker") & F.col("d.data").isNotNull())
    x = rows.select("ts_recv", "d.channel", F.explode(F.slice("d.data", 1, 1) if first_only else F.col("d.data")).alias("x"))
    stream = F.when(F.col("channel") == "trade", "trade").otherwise("bookTicker")
    ts = F.when(F.col("channel") == "trade", F.coalesce(F.unix_millis(instant(F.col("x.timestamp"))), F.col("ts_recv"))).otherwise(F.col("ts_recv"))
    return x.select(*_tick("kraken", F.col("x.symbol"), ts, stream, number(F.col("x.price")), number(F.col("x.qty")), F.col("x.side"), number(F.col("x.bid")), number(F.col("x.ask")), F.col("x.trade_id")))


PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {"binance": binance, "coinbase": coinbase, "kraken": kraken}


def parse(exchange: str, raw: DataFrame) -> DataFrame:
    """Ticks of an exchange; an unknown one is an error."""
    if exchange.lower() not in PARSERS:
        raise ValueError(f"unknown exchange {exchange!r}; known: {', '.join(sorted(PARSERS))}")
    return PARSERS[exchange.lower()](raw)


def subscription(exchange: str, url: str, symbols: list[str]) -> tuple[str, list[dict]]:
    """The address to connect to and the messages to send first."""
    match exchange.lower():
        case "binance":
            names = "/".join(f"{s.lower()}@{kind}" for s in symbols for kind in ("trade", "bookTicker"))
            return f"{url.rstrip('/')}/stream?streams={names}", []
        case "coinbase":
            return url, [{"type": "subscribe", "product_ids": symbols, "channels": ["ticker", "matches"]}]
        case "kraken":
            return url, [{"method": "subscribe", "params": {"channel": c, "symbol": symbols}} for c in ("ticker", "trade")]
    raise ValueError(f"unknown exchange {exchange!r}")
