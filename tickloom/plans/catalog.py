"""Registered queries over the driver tables, with the same results in DuckDB's SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.operators import bars as B
from tickloom.operators import detect, fusion, keys, parity, profiles, quality
from tickloom.operators.ordered import with_neighbour
from tickloom.plans import qa, slices
from tickloom.session import materialise, shared_folder
from tickloom.sinks import lake as sink
from tickloom.sources import klines, lake, wire
from tickloom.sources.adapters import driver_table, event_ticks, line_trades

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if there is one."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal."""
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def ticks_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ticks(driver_table(spark, sf_dir, "events"))


def millis(c: str) -> Column:
    """Milliseconds since 1970 of a time without zone."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(c))


def bars_of(spark: SparkSession, sf_dir: str, seconds: int = 3600) -> DataFrame:
    return B.tick_bars(ticks_of(spark, sf_dir), seconds)


def reference_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of a part of the users, standing in for official bars."""
    return B.tick_bars(ticks_of(spark, sf_dir).where("user_id % 3 <> 0"), 3600)


def seeded(df: DataFrame) -> DataFrame:
    """Bars with defects at fixed hours, so that every rule has something to find."""
    h = F.hour("ts")
    return df.withColumns(
        {
            "high": F.when(h == 1, F.col("open") - 1).otherwise(F.col("high")),
            "close": F.when(h == 2, -1.0).when(h == 4, None).otherwise(F.col("close")),
            "ask": F.when(h == 3, F.col("bid") - 1).otherwise(F.col("ask")),
            "volume_base": F.when(h == 5, -1.0).otherwise(F.col("volume_base")),
            "spread": F.when(h == 6, -0.5).when(h == 7, F.col("bid")).otherwise(F.col("spread")),
        }
    )


TICKS = """
ticks AS (
  SELECT 'driver' AS exchange, event_type AS symbol, ts, event_id AS trade_id, user_id,
         CASE WHEN user_id % 2 = 0 THEN 'trade' ELSE 'bookTicker' END AS stream,
         CASE WHEN user_id % 2 = 0 THEN value END AS price,
         CASE WHEN user_id % 2 = 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS qty,
         CASE WHEN user_id % 2 <> 0 THEN value END AS bid,
         CASE WHEN user_id % 2 <> 0 THEN value + CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 END AS ask
  FROM events)"""


def bars_sql(name: str, seconds: int, source: str = "ticks", drop: bool = True) -> str:
    """A common table expression of tick bars."""
    return f"""
{name} AS (
  SELECT exchange, symbol, start AS ts, open, high, low, close, volume_base, volume_quote, trade_count,
         CASE WHEN volume_base > 0 THEN volume_quote / volume_base ELSE close END AS vwap, bid, ask, ask - bid AS spread
  FROM (
    SELECT exchange, symbol, time_bucket(INTERVAL '{seconds} seconds', ts, TIMESTAMP '1970-01-01') AS start,
           first(price ORDER BY ts, trade_id) FILTER (WHERE price IS NOT NULL) AS open, max(price) AS high, min(price) AS low,
           last(price ORDER BY ts, trade_id) FILTER (WHERE price IS NOT NULL) AS close,
           coalesce(sum(qty), 0.0) AS volume_base, coalesce(sum(price * qty), 0.0) AS volume_quote, count(price) AS trade_count,
           last(bid ORDER BY ts, trade_id) FILTER (WHERE bid IS NOT NULL) AS bid, last(ask ORDER BY ts, trade_id) FILTER (WHERE ask IS NOT NULL) AS ask
    FROM {source} GROUP BY 1, 2, 3)
  {"WHERE close IS NOT NULL" if drop else ""})"""


BAR_COLUMNS = "exchange, symbol, ts, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, round(volume_base, 6) AS volume_base, round(volume_quote, 6) AS volume_quote, trade_count, round(vwap, 6) AS vwap, round(bid, 6) AS bid, round(ask, 6) AS ask, round(spread, 6) AS spread"
HOURLY = f"WITH {TICKS}, {bars_sql('bars', 3600)}"
BOTH = f"{HOURLY}, few AS (SELECT * FROM ticks WHERE user_id % 3 <> 0), {bars_sql('reference', 3600, 'few')}"
SEEDED = f"""{HOURLY},
seeded AS (
  SELECT exchange, symbol, ts, open, low, volume_quote, trade_count, vwap, bid,
         CASE WHEN hour(ts) = 1 THEN open - 1 ELSE high END AS high,
         CASE WHEN hour(ts) = 2 THEN -1.0 WHEN hour(ts) = 4 THEN NULL ELSE close END AS close,
         CASE WHEN hour(ts) = 3 THEN bid - 1 ELSE ask END AS ask,
         CASE WHEN hour(ts) = 5 THEN -1.0 ELSE volume_base END AS volume_base,
         CASE WHEN hour(ts) = 6 THEN -0.5 WHEN hour(ts) = 7 THEN bid ELSE spread END AS spread
  FROM bars),
gapped AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts) AS gap FROM seeded),
rules AS (
  SELECT *,
    NOT coalesce(low <= open AND low <= close AND open <= high AND close <= high, false) AS r1,
    NOT coalesce(open > 0 AND high > 0 AND low > 0 AND close > 0, false) AS r2,
    coalesce(ask < bid, false) AS r3,
    open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL AS r4,
    coalesce(gap > 3600000000, false) AS r5,
    CASE WHEN spread IS NOT NULL AND bid IS NOT NULL AND ask IS NOT NULL AND spread < 0 THEN 'negative'
         WHEN spread IS NOT NULL AND bid IS NOT NULL AND ask IS NOT NULL
              AND CASE WHEN bid + ask = 0 THEN spread > 0 ELSE spread / ((bid + ask) / 2) * 10000 >= 500 END THEN 'excessive' END AS kind,
    coalesce(volume_base < 0 OR volume_quote < 0, false) AS neg_vol
  FROM gapped)"""


def _rollup_sql(seconds: int, vwap: str = "last(vwap ORDER BY ts)", spread: str = "last(spread ORDER BY ts)", source_seconds: int = 1) -> str:
    return f"""WITH {TICKS}, {bars_sql('bars', source_seconds)},
rolled AS (
  SELECT exchange, symbol, time_bucket(INTERVAL '{seconds} seconds', ts, TIMESTAMP '1970-01-01') AS start, first(open ORDER BY ts) AS open, max(high) AS high, min(low) AS low,
         last(close ORDER BY ts) AS close, sum(volume_base) AS volume_base, sum(volume_quote) AS volume_quote, CAST(sum(trade_count) AS BIGINT) AS trade_count,
         {vwap} AS vwap, last(bid ORDER BY ts) AS bid, last(ask ORDER BY ts) AS ask, {spread} AS spread, count(*) AS bar_count
  FROM bars GROUP BY 1, 2, 3)
SELECT {BAR_COLUMNS.replace('ts,', 'start AS ts,', 1)}, bar_count FROM rolled"""


RECOMPUTED = "CASE WHEN sum(volume_base) > 0 THEN sum(volume_quote) / sum(volume_base) ELSE last(close ORDER BY ts) END"


# Bars


def _tick_bars(name: str, seconds: int) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(bars_of(spark, sf_dir, seconds))

    QUERIES[f"ohlcv_{name}"] = run
    ORACLE_SQL[f"ohlcv_{name}"] = f"WITH {TICKS}, {bars_sql('bars', seconds)} SELECT {BAR_COLUMNS} FROM bars"


def _rollup(name: str, seconds: int) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(B.rollup(bars_of(spark, sf_dir, 1), seconds))

    QUERIES[f"rollup_{name}"] = run
    ORACLE_SQL[f"rollup_{name}"] = _rollup_sql(seconds)


for _name, _seconds in (("1s", 1), ("1m", 60), ("1h", 3600)):
    _tick_bars(_name, _seconds)
for _name, _seconds in (("1m", 60), ("5m", 300), ("15m", 900), ("1h", 3600)):
    _rollup(_name, _seconds)


@query(f"""WITH {TICKS}, {bars_sql('grouped', 3600, drop=False)},
known AS (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY exchange, symbol ORDER BY ts) AS carried FROM grouped),
filled AS (SELECT * REPLACE (coalesce(open, carried) AS open, coalesce(high, carried) AS high, coalesce(low, carried) AS low, coalesce(close, carried) AS close, coalesce(vwap, carried) AS vwap) FROM known WHERE carried IS NOT NULL)
SELECT {BAR_COLUMNS} FROM filled""")
def ohlcv_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars that also stand where only quotes came."""
    return rounded(B.tick_bars(ticks_of(spark, sf_dir), 3600, fill="ffill"))


@query(_rollup_sql(300, RECOMPUTED, "avg(spread)", 60))
def gui_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute bars from minute bars with recomputed VWAP and mean spread."""
    return rounded(B.rollup(bars_of(spark, sf_dir, 60), 300, vwap="recompute", spread="avg"))


@query(f"""{HOURLY} SELECT exchange, symbol, CAST(ts AS DATE) AS date, round(first(open ORDER BY ts), 6) AS open, round(max(high), 6) AS high, round(min(low), 6) AS low,
  round(last(close ORDER BY ts), 6) AS close, round(sum(volume_base), 6) AS volume_base, round(sum(volume_quote), 6) AS volume_quote, CAST(sum(trade_count) AS BIGINT) AS trade_count,
  round({RECOMPUTED}, 6) AS vwap, count(*) AS bar_count FROM bars GROUP BY 1, 2, 3""")
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(B.daily_summary(bars_of(spark, sf_dir)))


@query("""SELECT 'driver' AS exchange, l_returnflag || l_linestatus AS symbol, date_trunc('day', l_shipdate) AS ts,
  first(l_extendedprice / l_quantity ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS open, max(l_extendedprice / l_quantity) AS high,
  min(l_extendedprice / l_quantity) AS low, last(l_extendedprice / l_quantity ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS close,
  sum(l_quantity) AS volume_base, count(*) AS trade_count
FROM lineitem WHERE l_quantity > 0 GROUP BY 1, 2, 3""")
def trade_bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of order lines; ties within a day go by order and line."""
    made = B.tick_bars(line_trades(driver_table(spark, sf_dir, "lineitem").where("l_quantity > 0")), 86400)
    return made.select("exchange", "symbol", "ts", "open", "high", "low", "close", "volume_base", "trade_count")


@query(f"{HOURLY} SELECT {BAR_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY exchange, symbol ORDER BY ts DESC) AS r FROM bars) WHERE r = 1")
def latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(B.latest(bars_of(spark, sf_dir)))


@query(f"{HOURLY} SELECT {BAR_COLUMNS} FROM bars WHERE symbol = (SELECT min(event_type) FROM events) ORDER BY ts DESC LIMIT 60")
def latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest sixty bars of the first symbol, ascending."""
    first = driver_table(spark, sf_dir, "events").agg(F.min("event_type").alias("symbol"))  # one row
    return rounded(B.latest_n(bars_of(spark, sf_dir).join(F.broadcast(first), "symbol", "left_semi"), None, 60))


@query(f"{HOURLY} SELECT {BAR_COLUMNS} FROM bars WHERE symbol IN ('click', 'view', 'purchase') AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
def slice_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week of some symbols; the filter on raw times reaches the scan."""
    days = [F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-12")]
    ticks = B.time_slice(ticks_of(spark, sf_dir), ["click", "view", "purchase"], *days)
    return rounded(B.tick_bars(ticks, 3600))


@query(f"WITH {TICKS} SELECT exchange, symbol, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS ts, count(price) AS trade_count, max(price) AS high, count(bid) AS quote_count, max(bid) AS max_bid FROM ticks GROUP BY 1, 2, 3")
def outer_trades_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.joined_trades_quotes(ticks_of(spark, sf_dir), 3600)


@query(f"""{BOTH} SELECT exchange, symbol, ts, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, round(volume_base, 6) AS volume_base,
  round(volume_quote, 6) AS volume_quote, trade_count, round(CASE WHEN volume_base > 0 THEN volume_quote / volume_base ELSE close END, 6) AS vwap,
  CAST(NULL AS DOUBLE) AS bid, CAST(NULL AS DOUBLE) AS ask, CAST(NULL AS DOUBLE) AS spread FROM reference""")
def kline_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official bars in the shape of own bars."""
    own = reference_of(spark, sf_dir)
    official = own.select("symbol", F.col("ts").alias("open_time"), "open", "high", "low", "close", F.col("volume_base").alias("volume"), F.col("volume_quote").alias("quote_volume"), F.col("trade_count").alias("trades"))
    return rounded(B.from_klines(official, "driver"))


# Parity


@query(f"""{BOTH} SELECT b.exchange, symbol, ts, {', '.join(f'round(b.{p}, 6) AS our_{p}, round(k.{p}, 6) AS kline_{p}, round(b.{p} - k.{p}, 6) AS {p}_diff' for p in quality.PRICES)},
  round(b.volume_base, 6) AS our_volume, round(k.volume_base, 6) AS kline_volume, round(b.volume_base - k.volume_base, 6) AS volume_diff_abs,
  round(CASE WHEN k.volume_base > 0 THEN abs(b.volume_base - k.volume_base) / k.volume_base * 10000 END, 6) AS volume_diff_bps
FROM bars b JOIN reference k USING (symbol, ts)""")
def compare_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(parity.compare(bars_of(spark, sf_dir), reference_of(spark, sf_dir)))


@query(f"""{BOTH} SELECT symbol, ts, {', '.join(f'round(b.{p} - k.{p}, 6) AS diff_{p}' for p in quality.PRICES)},
  round(greatest({', '.join(f'abs(b.{p} - k.{p})' for p in quality.PRICES)}), 6) AS abs_error FROM bars b JOIN reference k USING (symbol, ts)""")
def export_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(parity.export_compare(parity.compare(bars_of(spark, sf_dir), reference_of(spark, sf_dir))))


MATCHED = f"""{BOTH}, flags AS (
  SELECT symbol, ts, greatest({', '.join(f'abs(b.{p} - k.{p})' for p in quality.PRICES)}) AS d,
         coalesce(abs(b.volume_base - k.volume_base) / nullif(k.volume_base, 0) * 10000, 0) AS v
  FROM bars b JOIN reference k USING (symbol, ts))"""


@query(f"""{MATCHED} SELECT symbol, count(*) AS aligned, count(*) FILTER (WHERE d > 0.001 OR v > 50) AS mismatch_rows, round(100.0 * count(*) FILTER (WHERE d > 0.001) / count(*), 6) AS ohlc_pct,
  round(100.0 * count(*) FILTER (WHERE v > 50) / count(*), 6) AS volume_pct, round(max(d), 6) AS max_diff, round(max(v), 6) AS max_volume_bps FROM flags GROUP BY 1""")
def parity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(parity.parity_summary(parity.flag(bars_of(spark, sf_dir), reference_of(spark, sf_dir))))


@query(f"""{BOTH} SELECT count(*) AS bars, count(*) FILTER (WHERE {' OR '.join(f'abs(b.{p} - k.{p}) > 1e-4' for p in quality.PRICES)}) AS mismatches,
  round(avg(abs(b.volume_base - k.volume_base) / nullif(k.volume_base, 0) * 10000), 6) AS avg_volume_bps, round(max(abs(b.volume_base - k.volume_base) / nullif(k.volume_base, 0) * 10000), 6) AS max_volume_bps
FROM bars b JOIN reference k USING (symbol, ts)""")
def r7_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(parity.r7_summary(parity.compare(bars_of(spark, sf_dir), reference_of(spark, sf_dir))))


@query(f"{BOTH} SELECT symbol, ts FROM bars b JOIN reference k USING (symbol, ts) WHERE {' OR '.join(f'abs(b.{p} - k.{p}) > 1e-4' for p in quality.PRICES)}")
def rule_r7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.r7(parity.compare(bars_of(spark, sf_dir), reference_of(spark, sf_dir))).select("symbol", "ts")


# Rules


def _rule(name: str, condition: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.with_gaps(seeded(bars_of(spark, sf_dir)), 3600).where(quality.rule(name)).select("symbol", "ts")

    QUERIES[f"rule_{name.lower()}"] = run
    ORACLE_SQL[f"rule_{name.lower()}"] = f"{SEEDED} SELECT symbol, ts FROM rules WHERE {condition}"


for _name, _condition in (("R1", "r1"), ("R2", "r2"), ("R3", "r3"), ("R4", "r4"), ("R5", "r5"), ("R6", "kind IS NOT NULL"), ("NEG_VOL", "neg_vol")):
    _rule(_name, _condition)

SUMMARY = f"""{SEEDED} SELECT count(*) AS bars, {', '.join(f'count(*) FILTER (WHERE {c}) AS {c}' for c in ('r1', 'r2', 'r3', 'r4', 'r5'))},
  count(*) FILTER (WHERE kind IS NOT NULL) AS r6, count(*) FILTER (WHERE neg_vol) AS neg_vol, count(*) FILTER (WHERE kind = 'negative') AS r6_negative, count(*) FILTER (WHERE kind = 'excessive') AS r6_excessive,
  count(*) FILTER (WHERE spread IS NOT NULL AND bid IS NOT NULL AND ask IS NOT NULL) AS r6_checked FROM rules"""


@query(SUMMARY)
def rule_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_summary(seeded(bars_of(spark, sf_dir)), 3600)


@query(f"SELECT *, CASE WHEN r1 + r2 + r3 + r4 = 0 AND r6 = 0 THEN 'PASS' WHEN r1 + r2 + r3 + r4 = 0 AND coalesce(100.0 * r6_excessive / nullif(r6_checked, 0), 0) < 0.1 THEN 'INVESTIGATE' ELSE 'FAIL' END AS verdict FROM ({SUMMARY})")
def report_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report_verdict(quality.rule_summary(seeded(bars_of(spark, sf_dir)), 3600))


LISTED = f"""{SEEDED}, listed AS (
  {' UNION ALL '.join(f"SELECT symbol, ts, '{n}' AS rule, '{quality.SEVERITY[n]}' AS severity FROM rules WHERE {c}" for n, c in (("R1", "r1"), ("R2", "r2"), ("R3", "r3"), ("R4", "r4"), ("R5", "r5"), ("R6", "kind IS NOT NULL"), ("NEG_VOL", "neg_vol")))}),
capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY symbol, ts) AS place FROM listed) WHERE place <= 25)"""


@query(f"{LISTED} SELECT symbol, ts, rule, severity FROM capped")
def violation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest 25 violations of each rule: a report limit that is part of the operator."""
    return quality.violations(seeded(bars_of(spark, sf_dir)), 3600).select("symbol", "ts", "rule", "severity")


@query(f"{LISTED} SELECT rule, severity, count(*) AS violations FROM listed GROUP BY 1, 2")
def violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violation_counts(quality.violations(seeded(bars_of(spark, sf_dir)), 3600, None))


@query(f"{LISTED} SELECT symbol, ts, NOT EXISTS (SELECT 1 FROM listed c WHERE c.symbol = s.symbol AND c.ts = s.ts) AS is_clean FROM seeded s")
def clean_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = seeded(bars_of(spark, sf_dir))
    return keys.clean_rows(rows, quality.violations(rows, 3600, None)).select("symbol", "ts", "is_clean")


# Profiles


@query(f"{HOURLY} SELECT symbol, ts, gap AS gap_seconds FROM (SELECT symbol, ts, (epoch_us(lead(ts) OVER (PARTITION BY symbol ORDER BY ts)) - epoch_us(ts)) / 1000000.0 AS gap FROM bars) WHERE gap > 3600")
def gap_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.gap_rows(bars_of(spark, sf_dir), ["symbol"], longer_than=3600).select("symbol", "ts", "gap_seconds")


GAPS = f"{HOURLY}, gaps AS (SELECT symbol, ts, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY symbol ORDER BY ts))) / 1000000.0 AS gap FROM bars)"


@query(f"""{GAPS}, g AS (SELECT symbol, avg(gap) AS a, max(gap) AS m, count(*) FILTER (WHERE gap > 7200) AS large FROM gaps GROUP BY 1)
SELECT symbol, round(a, 6) AS avg_gap, m AS max_gap, large AS large_gaps, CASE WHEN a BETWEEN 55 AND 120 AND large < 10 THEN 'PASS' ELSE 'WARN' END AS status FROM g""")
def gap_lag_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiles.gap_profile(bars_of(spark, sf_dir), ["symbol"], large=7200))


@query(f"""{GAPS}, c AS (SELECT symbol, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts, count(*) FILTER (WHERE gap > 5400) AS gaps FROM gaps GROUP BY 1)
SELECT *, CAST(floor((epoch_us(last_ts) - epoch_us(first_ts)) / 1000000.0 / 3600) + 1 AS BIGINT) AS expected,
  round(n_rows / (floor((epoch_us(last_ts) - epoch_us(first_ts)) / 1000000.0 / 3600) + 1) * 100, 6) AS completeness FROM c""")
def continuity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiles.continuity(bars_of(spark, sf_dir), ["symbol"], 3600))


@query(f"{GAPS} SELECT symbol, ts, 'GAP ' || CAST(CAST(floor(gap / 3600) AS BIGINT) AS VARCHAR) || 'h' AS marker FROM gaps WHERE gap > 5400")
def gap_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.gap_markers(bars_of(spark, sf_dir), ["symbol"], 3600).select("symbol", "ts", "marker")


@query("SELECT count(*) AS n_rows, count(DISTINCT (user_id, event_type)) AS distinct_keys, count(*) - count(DISTINCT (user_id, event_type)) AS duplicates FROM events")
def dup_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.duplicates(driver_table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query(f"""{SEEDED} SELECT count(*) AS bars, count(*) FILTER (WHERE high < low) AS high_below_low,
  count(*) FILTER (WHERE coalesce(open < low OR open > high, false) OR coalesce(close < low OR close > high, false)) AS outside,
  count(*) FILTER (WHERE least(open, high, low, close) <= 0) AS not_positive, round(avg(CASE WHEN volume_base > 0 THEN 1.0 ELSE 0.0 END), 6) AS share_with_volume FROM seeded""")
def ohlc_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiles.ohlc_sanity(seeded(bars_of(spark, sf_dir))))


@query("SELECT event_type, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0, 6) AS days, count(DISTINCT user_id) AS distinct_values FROM events GROUP BY 1")
def span_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiles.span(driver_table(spark, sf_dir, "events"), by=("event_type",), distinct="user_id"))


@query(f"{HOURLY} " + " UNION ALL ".join(f"SELECT '{c}' AS field, round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max, round(avg({c}), 6) AS mean FROM bars" for c in ("open", "high", "low", "close", "volume_base", "trade_count")))
def stats_min_max_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiles.summary_table(bars_of(spark, sf_dir), ["open", "high", "low", "close", "volume_base", "trade_count"]))


@query(f"{SEEDED} SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in ("open", "close", "bid", "ask", "spread")) + " FROM seeded")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.null_profile(seeded(bars_of(spark, sf_dir)), ["open", "close", "bid", "ask", "spread"])


@query(f"{HOURLY} SELECT symbol, round(avg(close), 6) AS mean_close FROM bars GROUP BY 1")
def mean_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(bars_of(spark, sf_dir).groupBy("symbol").agg(F.avg("close").alias("mean_close")))


@query("""WITH newest AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS place FROM events),
kept AS (SELECT event_type, list(value ORDER BY value) AS v FROM newest WHERE place <= 1000 GROUP BY 1),
p AS (SELECT event_type, CAST(len(v) AS BIGINT) AS n, v[CAST(floor(len(v) / 2.0) AS BIGINT) + 1] AS p50, v[CAST(floor(len(v) * 0.95) AS BIGINT) + 1] AS p95, v[len(v)] AS max FROM kept)
SELECT *, p95 > 2000 OR max > 5000 AS warn FROM p""")
def latency_pctl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the last thousand values of each type: that window is the operator's own."""
    return profiles.latency(driver_table(spark, sf_dir, "events"), ["event_type"], "value", "event_id")


@query("""SELECT event_type AS exchange, count(*) FILTER (WHERE user_id % 3 = 0) AS disconnected, count(*) FILTER (WHERE user_id % 3 = 1) AS reconnecting, round(sum(value), 4) AS gap_seconds,
  arg_max(CASE user_id % 3 WHEN 0 THEN 'disconnected' WHEN 1 THEN 'reconnecting' ELSE 'connected' END, ts) AS last_event, max(ts) AS last_ts FROM events GROUP BY 1""")
def conn_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as a connection log, one exchange for each type."""
    kind = F.when(F.col("user_id") % 3 == 0, "disconnected").when(F.col("user_id") % 3 == 1, "reconnecting").otherwise("connected")
    log = driver_table(spark, sf_dir, "events").select(F.col("event_type").alias("exchange"), kind.alias("event"), "ts", F.col("value").alias("gap_seconds"))
    return rounded(profiles.connection_gaps(log), 4)


# Keys


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.dedup(driver_table(spark, sf_dir, "events"), ["user_id", "event_type"], ["event_id"], "last").select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS r FROM events) WHERE r = 1")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.dedup(driver_table(spark, sf_dir, "events"), ["user_id", "event_type"], ["event_id"], "first").select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE value > 200 AND user_id % 3 = 0)")
def anti_join_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = driver_table(spark, sf_dir, "events")
    return keys.only_new(events, events.where("value > 200 and user_id % 3 = 0"), ["user_id"]).select("event_id", "user_id")


@query("SELECT user_id, arg_max(event_id, event_id + CASE WHEN event_type = 'click' THEN 1000000000000 ELSE 0 END) AS event_id FROM events GROUP BY 1")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh rows (clicks) win over stored ones with the same user."""
    events = driver_table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    stored = keys.dedup(events.where("event_type <> 'click'"), ["user_id"], ["event_id"])
    fresh = keys.dedup(events.where("event_type = 'click'"), ["user_id"], ["event_id"])
    return keys.upsert(stored, fresh, ["user_id"]).select("user_id", "event_id")


@query("SELECT event_id, user_id, event_type, CAST(NULL AS DOUBLE) AS value FROM events WHERE user_id % 2 = 0 UNION ALL SELECT event_id, user_id, CAST(NULL AS VARCHAR), value FROM events WHERE user_id % 2 = 1")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = driver_table(spark, sf_dir, "events")
    return keys.union_all([events.where("user_id % 2 = 0").select("event_id", "user_id", "event_type"), events.where("user_id % 2 = 1").select("event_id", "user_id", "value")])


@query("""SELECT 'nation' AS "table", (SELECT count(*) FROM nation) AS source_rows, (SELECT count(DISTINCT n_nationkey) FROM nation) AS target_rows, true AS same
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders WHERE o_orderstatus = 'F'), (SELECT count(*) FROM orders) = (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')""")
def migration_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, orders = driver_table(spark, sf_dir, "nation"), driver_table(spark, sf_dir, "orders")
    return keys.count_difference({"nation": nation, "orders": orders}, {"nation": nation.dropDuplicates(["n_nationkey"]), "orders": orders.where("o_orderstatus = 'F'")})


@query(f"{HOURLY} SELECT exchange, symbol FROM bars GROUP BY 1, 2")
def distinct_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.Engine(bars_of(spark, sf_dir)).symbols()


# Detectors

FEATURES = f"""{HOURLY}, f AS (
  SELECT *, CASE WHEN spread IS NOT NULL THEN spread / nullif((bid + ask) / 2, 0) * 10000 END AS spread_bp,
         CASE WHEN volume_base > 0 THEN ln(1 + volume_base) END AS log_volume,
         CASE WHEN close > 0 THEN (vwap - close) / close * 10000 END AS vwap_drift_bp
  FROM bars)"""


def _zscore_sql(frame: str, k: float, order: str = "ts") -> str:
    parts = [f"SELECT symbol, ts, 'ZSCORE_{c.upper()}' AS detector, {c} AS value, ({c} - avg({c}) OVER w) / (stddev_samp({c}) OVER w + 1e-10) AS z FROM big WINDOW w AS (PARTITION BY symbol ORDER BY {order} {frame})" for c in ("spread_bp", "log_volume", "vwap_drift_bp")]
    return f"""{FEATURES}, big AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS n FROM f) WHERE n >= 10)
SELECT symbol, ts, detector, round(value, 5) AS value, round(z, 5) AS z FROM ({' UNION ALL '.join(parts)}) WHERE abs(z) > {k}"""


@query(_zscore_sql("ROWS BETWEEN 47 PRECEDING AND CURRENT ROW", 3.0))
def zscore_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(detect.zscores(bars_of(spark, sf_dir), 48, 3.0).drop("exchange"), 5)


@query(_zscore_sql("RANGE BETWEEN 172799999999 PRECEDING AND CURRENT ROW", 3.0, "epoch_us(ts)"))
def zscore_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(detect.zscores(bars_of(spark, sf_dir), "2d", 3.0).drop("exchange"), 5)


JUMP = f"""{FEATURES}, r AS (SELECT *, ln(close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY ts), 0)) AS ret, coalesce(spread_bp <= 50, false) AS stable FROM f),
a AS (SELECT *, bool_or(stable) OVER (PARTITION BY symbol) AS any_stable FROM r),
u AS (SELECT *, CASE WHEN NOT any_stable OR stable THEN ret END AS used FROM a),
s AS (SELECT *, avg(used) OVER w AS mean, stddev_samp(used) OVER w AS sigma, count(used) OVER w AS n FROM u WINDOW w AS (PARTITION BY symbol)),
jump AS (SELECT symbol, ts, 'JUMP' AS detector, ret, (ret - mean) / sigma AS z, spread_bp FROM s WHERE n >= 10 AND sigma > 0 AND abs((ret - mean) / sigma) > 2)"""


@query(f"{JUMP} SELECT symbol, ts, detector, round(ret, 5) AS ret, round(z, 5) AS z, round(spread_bp, 5) AS spread_bp FROM jump")
def jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(detect.jumps(bars_of(spark, sf_dir), 2.0).drop("exchange", "mean"), 5)


@query(f"""{JUMP} SELECT symbol, ts, detector, round(z, 5) AS z, 'anomaly' AS label,
  CASE WHEN coalesce(spread_bp <> 0 AND spread_bp < 20, false) AND abs(z) > 8 THEN 0.95 WHEN abs(z) > 6 THEN 0.75 ELSE 0.5 END AS confidence FROM jump""")
def label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(detect.label(detect.jumps(bars_of(spark, sf_dir), 2.0)).select("symbol", "ts", "detector", "z", "label", "confidence"), 5)


CLUSTER = f"""{JUMP}, marked AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 36000000000 THEN 0 ELSE 1 END AS fresh FROM jump WINDOW w AS (PARTITION BY symbol, detector ORDER BY ts)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol, detector ORDER BY ts) AS c FROM marked),
burst AS (SELECT symbol, detector, c, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n, max(abs(z)) AS max_abs_z FROM numbered GROUP BY 1, 2, 3)"""


@query(f"{CLUSTER} SELECT symbol, detector, start_ts, end_ts, n, round(max_abs_z, 5) AS max_abs_z FROM burst")
def cluster_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(detect.clusters(detect.jumps(bars_of(spark, sf_dir), 2.0), 36_000).drop("exchange"), 5)


@query(f"{CLUSTER} SELECT symbol, CAST(sum(n) AS BIGINT) AS anomalies, count(*) AS bursts, min(start_ts) AS first_ts, max(end_ts) AS last_ts FROM burst GROUP BY 1")
def cluster_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.weighted_counts(detect.clusters(detect.jumps(bars_of(spark, sf_dir), 2.0), 36_000))


@query(f"""{JUMP.replace('WITH ', 'WITH RECURSIVE ', 1)},
later AS (SELECT a.symbol, a.detector, a.ts, min(b.ts) AS next_ts FROM jump a LEFT JOIN jump b ON a.symbol = b.symbol AND a.detector = b.detector AND epoch_us(b.ts) - epoch_us(a.ts) >= 172800000000 GROUP BY 1, 2, 3),
shown AS (SELECT symbol, detector, min(ts) AS ts FROM jump GROUP BY 1, 2
  UNION ALL SELECT s.symbol, s.detector, l.next_ts FROM shown s JOIN later l ON s.symbol = l.symbol AND s.detector = l.detector AND s.ts = l.ts WHERE l.next_ts IS NOT NULL)
SELECT symbol, detector, ts, round(z, 5) AS z FROM jump SEMI JOIN shown USING (symbol, detector, ts)""")
def burst_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies to print, none within two days of the last printed one of its key."""
    return rounded(detect.preview(detect.jumps(bars_of(spark, sf_dir), 2.0), 172_800).drop("exchange"), 5)


@query()
def iforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Isolation forest over complete bars; a random method that SQL cannot express."""
    return detect.isolation_forest(bars_of(spark, sf_dir), contamination=0.01).drop("exchange")


FUSED = f"""{LISTED}, {JUMP.split('WITH ', 1)[1].split(bars_sql('bars', 3600), 1)[1].lstrip(', ')},
v AS (SELECT symbol, count(*) FILTER (WHERE severity = 'critical') AS critical, count(*) FILTER (WHERE severity = 'major') AS major, count(*) FILTER (WHERE severity = 'minor') AS minor FROM listed GROUP BY 1),
n AS (SELECT symbol, count(*) AS anomalies, avg(CASE WHEN coalesce(spread_bp <> 0 AND spread_bp < 20, false) AND abs(z) > 8 THEN 0.95 WHEN abs(z) > 6 THEN 0.75 ELSE 0.5 END) AS confidence FROM jump GROUP BY 1),
w AS (SELECT symbol, coalesce(critical, 0) AS critical, coalesce(major, 0) AS major, coalesce(minor, 0) AS minor, coalesce(anomalies, 0) AS anomalies, confidence
      FROM (SELECT DISTINCT symbol FROM bars) LEFT JOIN v USING (symbol) LEFT JOIN n USING (symbol)),
parts AS (SELECT *, greatest(0.0, 1 - 0.5 * critical - 0.2 * major - 0.05 * minor) AS schema_score, 1 / (1 + anomalies / 10.0) AS detector_score,
      CASE WHEN anomalies = 0 THEN 1.0 ELSE least(1.0, greatest(0.0, 1 - confidence)) END AS ai_score FROM w),
scored AS (SELECT *, 0.7 * schema_score + 0.2 * detector_score + 0.1 * ai_score AS raw FROM parts),
fused AS (SELECT symbol, CASE WHEN critical > 0 OR raw < 0.65 THEN 'FAIL' WHEN major > 0 OR raw < 0.85 THEN 'REVIEW' ELSE 'PASS' END AS verdict, CAST(round(raw, 4) AS DOUBLE) AS score, critical, major, minor, anomalies FROM scored)"""


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = materialise(bars_of(spark, sf_dir))  # three stages read them
    found = detect.label(detect.jumps(own, 2.0))
    return fusion.fuse(own.select("symbol").distinct(), quality.violations(seeded(own), 3600, None), found)


@query(f"{FUSED} SELECT * FROM fused")
def fusion_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(spark, sf_dir).select("symbol", "verdict", "score", "critical", "major", "minor", "anomalies")


@query(f"{FUSED} SELECT count(*) AS symbols, count(*) FILTER (WHERE verdict = 'PASS') AS pass, count(*) FILTER (WHERE verdict = 'REVIEW') AS review, count(*) FILTER (WHERE verdict = 'FAIL') AS fail, round(avg(score), 6) AS avg_score, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score FROM fused")
def fusion_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fusion.fusion_summary(_fused(spark, sf_dir)))


def _qa_sql() -> str:
    """The chain's verdicts with default settings: all rules, then z-scores and jumps of the clean bars."""
    rules = SEEDED[SEEDED.index("gapped AS") :].replace("FROM seeded", "FROM bars")
    listed = LISTED[LISTED.index("listed AS") : LISTED.index("),\ncapped") + 1]
    jumps = JUMP[JUMP.index("f AS") :].replace("FROM bars)", "FROM clean)", 1).replace("> 2)", "> 6)")
    z = " UNION ALL ".join(f"SELECT symbol, 'ZSCORE_{c.upper()}' AS detector, ({c} - avg({c}) OVER w) / (stddev_samp({c}) OVER w + 1e-10) AS z FROM big WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 3599 PRECEDING AND CURRENT ROW)" for c in ("spread_bp", "log_volume", "vwap_drift_bp"))
    confidence = """CASE WHEN detector = 'ZSCORE_SPREAD_BP' THEN CASE WHEN abs(z) > 10 THEN 0.9 WHEN abs(z) > 5 THEN 0.7 ELSE 0.5 END
      WHEN detector = 'JUMP' THEN CASE WHEN coalesce(spread_bp <> 0 AND spread_bp < 20, false) AND abs(z) > 8 THEN 0.95 WHEN abs(z) > 6 THEN 0.75 ELSE 0.5 END ELSE 0.5 END"""
    found = f"""big AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS n FROM f) WHERE n >= 10),
found AS (SELECT symbol, detector, z, spread_bp FROM jump UNION ALL SELECT symbol, detector, z, CAST(NULL AS DOUBLE) FROM ({z}) WHERE abs(z) > 5),
v AS ({FUSED[FUSED.index("v AS (") + 6 : FUSED.index("),", FUSED.index("v AS ("))]}),
n AS (SELECT symbol, count(*) AS anomalies, avg({confidence}) AS confidence FROM found GROUP BY 1),
{FUSED[FUSED.index("w AS (SELECT symbol, coalesce") :]}"""
    return f"""{HOURLY}, {rules}, {listed}, clean AS (SELECT * FROM bars b WHERE NOT EXISTS (SELECT 1 FROM listed l WHERE l.symbol = b.symbol AND l.ts = b.ts)), {jumps}, {found}
SELECT symbol, verdict, score, critical, major, minor, anomalies FROM fused"""


@query(_qa_sql())
def qa_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain with its default settings."""
    return qa.chain(bars_of(spark, sf_dir), 3600)["fused"].select("symbol", "verdict", "score", "critical", "major", "minor", "anomalies")


# Scalars, parsing, sources


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, round(ln(1 + value), 6) AS log_value, sha256(event_type) AS type_sha256, md5(event_type) AS type_md5, upper(substr(event_type, 1, 3)) AS prefix FROM events")
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = driver_table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.round(F.log1p("value"), 6).alias("log_value"), F.sha2("event_type", 256).alias("type_sha256"), F.md5("event_type").alias("type_md5"), F.upper(F.substring("event_type", 1, 3)).alias("prefix"))


@query("SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, date_trunc('minute', ts) AS minute, CAST(ts AS DATE) AS date FROM events")
def partition_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = driver_table(spark, sf_dir, "events")
    return events.select("event_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"), scalars.bucket("ts", 60).alias("minute"), F.to_date("ts").alias("date"))


@query("""SELECT event_id, CASE WHEN value < 60 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || 's' WHEN value < 3600 THEN CAST(CAST(floor(value / 60) AS BIGINT) AS VARCHAR) || 'm' ELSE CAST(CAST(floor(value / 3600) AS BIGINT) AS VARCHAR) || 'h' END AS gap,
  CASE WHEN value < 300 THEN 'FRESH' WHEN value < 3600 THEN 'RECENT' ELSE 'STALE' END AS age, CASE WHEN value >= 95 THEN 'EMERGENCY' WHEN value >= 90 THEN 'CRITICAL' WHEN value >= 80 THEN 'WARNING' ELSE 'OK' END AS disk,
  CAST(CASE WHEN value >= 95 THEN 1 WHEN value >= 90 THEN 2 WHEN value >= 80 THEN 3 ELSE 7 END AS INTEGER) AS keep_days, 'pg://me:***@' || event_type AS url FROM events WHERE value >= 0""")
def scalar_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    v: Column = F.col("value")
    rows = driver_table(spark, sf_dir, "events").where(v >= 0)
    return rows.select("event_id", scalars.gap_label(v).alias("gap"), scalars.freshness(v).alias("age"), scalars.disk_alert(v).alias("disk"), scalars.retention_days(v).alias("keep_days"), scalars.masked_password(F.concat(F.lit("pg://me:secret@"), "event_type")).alias("url"))


@query("SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def instant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written as text in two forms and parsed again."""
    events = driver_table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    return events.select("event_id", F.convert_timezone(F.lit(zone), F.lit("UTC"), scalars.instant(text).cast("timestamp_ntz")).alias("parsed"))


@query("""SELECT 'binance' AS exchange, upper(event_type) AS symbol, epoch_us(ts) // 1000 AS ts_event, stream, CASE WHEN stream = 'trade' THEN value END AS price, CASE WHEN stream = 'trade' THEN 2.5 END AS qty,
  CASE WHEN stream = 'trade' THEN CASE WHEN user_id % 4 = 0 THEN 'sell' ELSE 'buy' END END AS side, CASE WHEN stream = 'bookTicker' THEN value END AS bid, CASE WHEN stream = 'bookTicker' THEN value END AS ask,
  CASE WHEN stream = 'trade' THEN event_id END AS trade_id FROM (SELECT *, CASE WHEN user_id % 5 = 1 THEN 'aggTrade' WHEN user_id % 2 = 0 THEN 'trade' ELSE 'bookTicker' END AS stream FROM events)""")
def wire_binance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as exchange messages and normalised again; aggregate trades are no trades, and some messages have no stream name."""
    events = driver_table(spark, sf_dir, "events")
    trade, bare, ms, v = F.col("user_id") % 2 == 0, F.col("user_id") % 7 == 0, millis("ts"), F.col("value").cast("string")
    side = F.when(F.col("user_id") % 4 == 0, "true").otherwise("false")
    t = F.format_string('{"e":"trade","E":%d,"s":"%s","p":"%s","q":"2.5","t":%d,"m":%s}', ms, "event_type", v, "event_id", side)
    q = F.format_string('{"e":"bookTicker","E":%d,"s":"%s","b":"%s","a":"%s"}', ms, "event_type", v, v)
    g = F.format_string('{"e":"aggTrade","E":%d,"s":"%s","p":"%s","q":"2.5"}', ms, "event_type", v)
    named = lambda kind, body: F.concat(F.lit('{"stream":"'), "event_type", F.lit(f'@{kind}","data":'), body, F.lit("}"))
    one = F.when(F.col("user_id") % 5 == 1, named("aggTrade", g)).when(trade & bare, t).when(trade, named("trade", t)).when(bare, q).otherwise(named("bookTicker", q))
    return wire.binance(events.select(one.alias("message"), ms.alias("ts_recv"))).drop("ts_recv")


@query("""SELECT 'coinbase' AS exchange, event_type AS symbol, epoch_us(date_trunc('second', ts)) // 1000 AS ts_event, CASE WHEN user_id % 2 = 0 THEN 'trade' ELSE 'bookTicker' END AS stream, CASE WHEN user_id % 2 = 0 THEN value END AS price, CASE WHEN user_id % 2 = 0 THEN 2.5 END AS qty,
  CASE WHEN user_id % 2 = 0 THEN 'sell' END AS side, CASE WHEN user_id % 2 = 1 THEN value END AS bid, CASE WHEN user_id % 2 = 1 THEN value + 1 END AS ask, CASE WHEN user_id % 2 = 0 THEN event_id END AS trade_id FROM events WHERE user_id % 5 <> 0""")
def wire_coinbase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches and tickers as messages, with control messages between them."""
    events = driver_table(spark, sf_dir, "events")
    v, time = F.col("value").cast("string"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = F.when(F.col("user_id") % 5 == 0, "heartbeat").when(F.col("user_id") % 4 == 0, "match").when(F.col("user_id") % 2 == 0, "last_match").otherwise("ticker")
    t = F.format_string('{"type":"%s","product_id":"%s","time":"%s","price":"%s","size":"2.5","side":"sell","trade_id":%d}', kind, "event_type", time, v, "event_id")
    q = F.format_string('{"type":"%s","product_id":"%s","time":"%s","best_bid":"%s","best_ask":"%s"}', kind, "event_type", time, v, (F.col("value") + 1).cast("string"))
    return wire.coinbase(events.select(F.when(F.col("user_id") % 2 == 0, t).otherwise(q).alias("message"), F.lit(0).cast("bigint").alias("ts_recv"))).drop("ts_recv")


@query("""SELECT 'kraken' AS exchange, event_type AS symbol, CASE WHEN user_id % 2 = 0 THEN epoch_us(date_trunc('second', ts)) // 1000 ELSE 5 END AS ts_event, CASE WHEN user_id % 2 = 0 THEN 'trade' ELSE 'bookTicker' END AS stream,
  CASE WHEN user_id % 2 = 0 THEN value END AS price, CASE WHEN user_id % 2 = 0 THEN qty END AS qty, CASE WHEN user_id % 2 = 0 THEN 'buy' END AS side, CASE WHEN user_id % 2 = 1 THEN value END AS bid, CASE WHEN user_id % 2 = 1 THEN value END AS ask,
  CASE WHEN user_id % 2 = 0 THEN event_id END AS trade_id FROM events, (VALUES (1.0), (2.0)) AS two(qty) WHERE user_id % 5 <> 0""")
def wire_kraken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two elements in every message, with messages of other channels between them."""
    events = driver_table(spark, sf_dir, "events")
    v, time = F.col("value").cast("string"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    channel = F.when(F.col("user_id") % 5 == 0, "status").when(F.col("user_id") % 2 == 0, "trade").otherwise("ticker")
    one = lambda qty: F.format_string('{"symbol":"%s","price":"%s","qty":"' + qty + '","side":"buy","trade_id":%d,"timestamp":"%s","bid":"%s","ask":"%s"}', "event_type", v, "event_id", time, v, v)
    message = F.concat(F.lit('{"channel":"'), channel, F.lit('","data":['), one("1"), F.lit(","), one("2"), F.lit("]}"))
    return wire.kraken(events.select(message.alias("message"), F.lit(5).cast("bigint").alias("ts_recv"))).drop("ts_recv")


@query("SELECT event_type AS symbol, ts AS open_time, value AS open, value + 1 AS high, value - 1 AS low, value AS close, CAST(user_id AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS quote_volume, event_id AS trades FROM (SELECT *, date_trunc('millisecond', ts) AS t FROM events) AS e, LATERAL (SELECT t AS ts)".replace("SELECT event_type AS symbol, ts AS open_time", "SELECT event_type AS symbol, e.t AS open_time"))
def kline_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of strings as official bars; a bad number becomes null."""
    events = driver_table(spark, sf_dir, "events")
    ms, s = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")), lambda c: c.cast("string")
    v = F.col("value")
    row = F.array(s(ms), s(v), s(v + 1), s(v - 1), s(v), s(F.col("user_id")), s(ms), F.lit("bad"), s(F.col("event_id")), F.lit("0"), F.lit("0"), F.lit("0"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    made = klines.typed(events.select(F.col("event_type").alias("symbol"), row.alias("kline")))
    return made.withColumn("open_time", F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col("open_time").cast("timestamp_ntz"))).drop("close_time", "taker_base_vol", "taker_quote_vol")


@query("SELECT o_custkey AS ticker, o_orderdate AS ts, CAST(o_totalprice AS DOUBLE) AS open, CAST(0 AS BIGINT) AS volume FROM orders WHERE o_orderkey % 7 <> 0")
def macro_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a price drop; missing volume is 0."""
    price = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).otherwise(F.lit(float("nan")))
    rows = driver_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("ticker"), F.col("o_orderdate").alias("ts"), *[price.alias(c) for c in ("open", "high", "low", "close")], F.lit(None).cast("double").alias("volume"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    made = klines.macro(rows.withColumn("ts", F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("ts"))))
    return made.select("ticker", F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col("ts").cast("timestamp_ntz")).alias("ts"), "open", "volume")


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-23'")
def recent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookback cut-off, with a fixed present."""
    events = driver_table(spark, sf_dir, "events").select("event_id", "ts")
    return lake.recent(events, 7, F.lit("2024-01-30").cast("timestamp_ntz"))


#: Each column as text after its length; a dash for null.
ROW_HASH = "sha256(" + " || ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("event_id", "user_id", "event_type", "props")) + ")"


@query(f"SELECT event_id, {ROW_HASH} AS row_sha256 FROM events")
def hash_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "events").select("event_id", profiles.row_hash(["event_id", "user_id", "event_type", "props"]).alias("row_sha256"))


@query("SELECT count(*) AS n_rows, sha256(concat_ws(',', " + ", ".join(f"CAST(coalesce(sum(CAST('0x' || substr(h, {15 * k + 1}, 15) AS BIGINT)), 0) AS VARCHAR)" for k in range(4)) + f")) AS content_sha256 FROM (SELECT {ROW_HASH} AS h FROM events)")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hash of the whole table that does not depend on row order."""
    return profiles.content_hash(driver_table(spark, sf_dir, "events"), ["event_id", "user_id", "event_type", "props"])


@query("SELECT event_id, event_type AS symbol FROM events WHERE (CASE WHEN user_id % 2 = 0 THEN 'trade' ELSE 'bookTicker' END || ':' || event_type) IN ('trade:click', 'trade:view')")
def channel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.streaming.live import channel

    return channel(ticks_of(spark, sf_dir), "click,view", "trade").select(F.col("trade_id").alias("event_id"), "symbol")


@query(f"{HOURLY} SELECT symbol, ts, close >= open AS up, round(close - lag(close) OVER (PARTITION BY symbol ORDER BY ts), 6) AS change FROM bars")
def candle_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candle direction and change against the close before."""
    near = with_neighbour(bars_of(spark, sf_dir), ["exchange", "symbol"], ["close"])
    return rounded(near.select("symbol", "ts", scalars.candle_up(F.col("open"), F.col("close")).alias("up"), (F.col("close") - F.col("prev_close")).alias("change")))


@query(f"""{GAPS}, checks AS (SELECT coalesce(avg(gap) BETWEEN 55 AND 120 AND count(*) FILTER (WHERE gap > 120) < 10, false) AS steady FROM gaps GROUP BY symbol)
SELECT CASE WHEN count(*) FILTER (WHERE NOT steady) > 0 THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS status FROM checks""")
def system_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of the continuity checks, which warn at hourly steps, and one that passes."""
    checks = profiles.gap_profile(bars_of(spark, sf_dir), ["symbol"]).select("status").unionByName(spark.range(1).select(F.lit("SKIP").alias("status")))
    return profiles.system_status(checks)




# Two exchanges, evidence, bursts, examples

#: Ticks of two exchanges: every third user trades on the second, so that series of one symbol stand side by side.
TWO_TICKS = TICKS.replace("SELECT 'driver' AS exchange,", "SELECT CASE WHEN user_id % 3 = 0 THEN 'north' ELSE 'south' END AS exchange,")
TWO = f"WITH {TWO_TICKS}, {bars_sql('bars', 3600)}"
SERIES = "PARTITION BY exchange, symbol"


def two_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = ticks_of(spark, sf_dir).withColumn("exchange", F.when(F.col("user_id") % 3 == 0, "north").otherwise("south"))
    return B.tick_bars(ticks, 3600)


TWO_FEATURES = FEATURES.replace(HOURLY, TWO)
TWO_Z = " UNION ALL ".join(
    f"SELECT exchange, symbol, ts, 'ZSCORE_{c.upper()}' AS detector, {c} AS value, ({c} - avg({c}) OVER w) / (stddev_samp({c}) OVER w + 1e-10) AS z FROM big WINDOW w AS ({SERIES} ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
    for c in ("spread_bp", "log_volume", "vwap_drift_bp")
)
TWO_BIG = f"big AS (SELECT * FROM (SELECT *, count(*) OVER ({SERIES}) AS n FROM f) WHERE n >= 10)"


@query(f"{TWO_FEATURES}, {TWO_BIG} SELECT exchange, symbol, ts, detector, round(value, 5) AS value, round(z, 5) AS z FROM ({TWO_Z}) WHERE abs(z) > 3")
def zscore_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z-scores of each exchange's own series, in frames of a day."""
    return rounded(detect.zscores(two_exchanges(spark, sf_dir), 24, 3.0), 5)


TWO_JUMP = JUMP.replace(FEATURES, TWO_FEATURES).replace("PARTITION BY symbol", SERIES).replace("SELECT symbol, ts, 'JUMP' AS detector", "SELECT exchange, symbol, ts, trade_count, 'JUMP' AS detector")


@query(f"{TWO_JUMP} SELECT exchange, symbol, ts, detector, round(ret, 5) AS ret, round(z, 5) AS z, round(spread_bp, 5) AS spread_bp FROM jump WHERE coalesce(trade_count >= 4, true)")
def jump_traded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jumps of each exchange's own series in bars of at least four trades."""
    return rounded(detect.jumps(two_exchanges(spark, sf_dir), 2.0, min_trades=4).drop("mean"), 5)


@query(f"""{SEEDED.replace(HOURLY, TWO).replace("PARTITION BY symbol", SERIES)}
SELECT exchange, symbol, ts, NOT (r1 OR r2 OR r3 OR r4 OR r5 OR kind IS NOT NULL OR neg_vol) AS is_clean FROM rules""")
def clean_mask_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A violation on one exchange leaves the other's bar of the same symbol and time clean."""
    rows = seeded(two_exchanges(spark, sf_dir))
    return keys.clean_rows(rows, quality.violations(rows, 3600, None)).select("exchange", "symbol", "ts", "is_clean")


def _evident(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = materialise(two_exchanges(spark, sf_dir))
    jumps, scores = detect.jumps(own, 2.0).withColumn("value", F.lit(None).cast("double")), detect.zscores(own, 24, 3.0)
    both = jumps.unionByName(scores.withColumns({c: F.lit(None).cast("double") for c in ("ret", "spread_bp", "mean")}))
    return detect.label(detect.evidence(both, 3.0, 2.0))


EVIDENT = f"""{TWO_JUMP}, {TWO_BIG}, zs AS (SELECT * FROM ({TWO_Z}) WHERE abs(z) > 3),
evident AS (
  SELECT exchange, symbol, ts, detector, z, ret, spread_bp, NULL AS value, 'Price jump Z-score ' || printf('%.2f', z) || ' exceeds 2.0' AS rationale,
         CASE WHEN coalesce(spread_bp <> 0 AND spread_bp < 20, false) AND abs(z) > 8 THEN 0.95 WHEN abs(z) > 6 THEN 0.75 ELSE 0.5 END AS confidence FROM jump
  UNION ALL
  SELECT exchange, symbol, ts, detector, z, NULL, NULL, value, lower(substr(detector, 8)) || ' Z-score ' || printf('%.2f', z) || ' exceeds threshold 3.0',
         CASE WHEN detector = 'ZSCORE_SPREAD_BP' THEN CASE WHEN abs(z) > 10 THEN 0.9 WHEN abs(z) > 5 THEN 0.7 ELSE 0.5 END ELSE 0.5 END FROM zs)"""


@query(f"""{EVIDENT} SELECT exchange, symbol, ts, detector, 'anomaly' AS label, confidence, rationale, CASE WHEN detector = 'JUMP' THEN 3 ELSE 2 END AS n_features, round(z, 5) AS z_score,
  round(ret, 5) AS log_return, round(spread_bp, 5) AS jump_spread_bp, round(CASE WHEN detector = 'ZSCORE_LOG_VOLUME' THEN value END, 5) AS log_volume FROM evident""")
def anomaly_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each detector measured, as a map, and why the row is listed."""
    rows = _evident(spark, sf_dir)
    of = lambda name: F.try_element_at("features", F.lit(name))
    jump_only = F.when(F.col("detector") == "JUMP", of("spread_bp"))
    return rounded(rows.select("exchange", "symbol", "ts", "detector", "label", "confidence", "rationale", F.size("features").alias("n_features"), of("z_score").alias("z_score"), of("log_return").alias("log_return"), jump_only.alias("jump_spread_bp"), of("log_volume").alias("log_volume")), 5)


TWO_BURST = f"""{EVIDENT}, marked AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 36000000000 THEN 0 ELSE 1 END AS fresh FROM evident WINDOW w AS (PARTITION BY exchange, symbol, detector ORDER BY ts)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY exchange, symbol, detector ORDER BY ts) AS c FROM marked),
burst AS (SELECT exchange, symbol, detector, c, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n, max(abs(z)) AS max_abs_z, arg_min(rationale, ts) AS rationale, arg_min(confidence, ts) AS confidence, arg_min(z, ts) AS z FROM numbered GROUP BY 1, 2, 3, 4)"""


@query(f"""{TWO_BURST} SELECT exchange, symbol, start_ts AS ts, detector, 'anomaly' AS label, rationale, confidence, round(z, 5) AS z_score, CASE WHEN n > 1 THEN n END AS cluster_rows,
  CASE WHEN n > 1 THEN end_ts END AS cluster_end, round(CASE WHEN n > 1 THEN max_abs_z END, 5) AS cluster_max FROM burst""")
def burst_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bursts as stored: the first row's features, label and rationale, and the cluster where there are more rows."""
    made = detect.records(detect.clusters(_evident(spark, sf_dir), 36_000))
    cluster = F.col("cluster")
    return rounded(made.select("exchange", "symbol", "ts", "detector", "label", "rationale", "confidence", F.col("features")["z_score"].alias("z_score"), cluster["count"].alias("cluster_rows"), cluster["end_ts"].alias("cluster_end"), cluster["max_abs_z"].alias("cluster_max")), 5)


@query(f"""{TWO_BURST} SELECT symbol, CAST(sum(n) AS BIGINT) AS anomalies, count(*) AS bursts, min(start_ts) AS first_ts, max(end_ts) AS last_ts,
  first(rationale ORDER BY start_ts, detector, exchange) AS first_rationale, 'anomaly' AS first_label FROM burst GROUP BY 1""")
def busiest_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies of each symbol with the rationale and label of the first."""
    return detect.weighted_counts(detect.clusters(_evident(spark, sf_dir), 36_000))


@query(f"""{EVIDENT}, placed AS (SELECT *, row_number() OVER (PARTITION BY detector ORDER BY ts, symbol, exchange) AS place, count(*) OVER (PARTITION BY detector) AS total FROM evident)
SELECT detector, CAST(place AS INTEGER) AS place, total, exchange, symbol, ts, rationale FROM placed WHERE place <= 10""")
def detector_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten anomalies of each detector: a report's limit that is part of the operator."""
    chosen = detect.examples(_evident(spark, sf_dir), 10, order=("ts", "symbol", "exchange"))
    return chosen.select("detector", "place", "total", "exchange", "symbol", "ts", "rationale")


# Derivatives, verdicts, batches, files, read calls


@query(f"""{HOURLY}, derived AS (SELECT event_type AS symbol, date_trunc('minute', ts) AS ts, max(value / 1000) AS funding_rate, max(CAST(user_id AS DOUBLE)) AS open_interest, max(value * user_id) AS oi_usd
  FROM events WHERE user_id % 50 = 0 GROUP BY 1, 2)
SELECT b.symbol, b.ts, round(b.close, 6) AS close, round(d.funding_rate, 6) AS funding_rate, d.open_interest, round(d.oi_usd, 6) AS oi_usd FROM bars b ASOF LEFT JOIN derived d ON b.symbol = d.symbol AND b.ts >= d.ts""")
def derivatives_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars with the last funding rate and open interest of their symbol, some days old."""
    events = driver_table(spark, sf_dir, "events").where("user_id % 50 = 0")
    derived = events.select(F.col("event_type").alias("symbol"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"), (F.col("value") / 1000).alias("funding_rate"), F.col("user_id").cast("double").alias("open_interest"), (F.col("value") * F.col("user_id")).alias("oi_usd"))
    return rounded(lake.with_derivatives(bars_of(spark, sf_dir), derived).select("symbol", "ts", "close", "funding_rate", "open_interest", "oi_usd"))


#: Bars whose defects differ by day: even days none, every third an excessive spread in the first hour, days divisible by five a crossed high.
VERDICT_BARS = f"""{HOURLY},
damaged AS (
  SELECT * REPLACE (CASE WHEN day(ts) % 5 = 0 AND hour(ts) = 1 THEN open - 1 ELSE high END AS high, CASE WHEN day(ts) % 3 = 0 AND hour(ts) = 0 AND symbol = (SELECT min(event_type) FROM events) THEN bid ELSE 0.0 END AS spread) FROM bars),
lines AS (SELECT *, CAST(day(ts) % 5 = 0 AS INTEGER) * 2 + CAST(day(ts) % 3 = 0 AS INTEGER) AS kind FROM damaged WHERE bid > 0 AND ask > 0 AND ask >= bid)"""


@query(f"""{VERDICT_BARS}, judged AS (SELECT kind, count(*) AS bars,
  count(*) FILTER (WHERE NOT (low <= open AND low <= close AND open <= high AND close <= high)) AS r1, count(*) FILTER (WHERE NOT coalesce(open > 0 AND high > 0 AND low > 0 AND close > 0, false)) AS r2,
  count(*) FILTER (WHERE spread / ((bid + ask) / 2) * 10000 >= 500) AS r6 FROM lines GROUP BY 1)
SELECT kind, bars, r1, r2, r6, CASE WHEN r1 + r2 = 0 AND r6 = 0 THEN 'PASS' WHEN r1 + r2 = 0 AND 100.0 * r6 / bars < 5 THEN 'INVESTIGATE' ELSE 'FAIL' END AS verdict FROM judged""")
def report_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for each kind of day, so that every outcome occurs; five percent of spreads may be excessive."""
    own = bars_of(spark, sf_dir)
    first = F.broadcast(driver_table(spark, sf_dir, "events").agg(F.min("event_type").alias("__first")))  # one row
    day, hour = F.dayofmonth("ts"), F.hour("ts")
    wide = (day % 3 == 0) & (hour == 0) & (F.col("symbol") == F.col("__first"))
    damaged = own.join(first).withColumns({"high": F.when((day % 5 == 0) & (hour == 1), F.col("open") - 1).otherwise(F.col("high")), "spread": F.when(wide, F.col("bid")).otherwise(0.0)}).drop("__first")
    lines = damaged.where("bid > 0 and ask > 0 and ask >= bid").withColumn("kind", (day % 5 == 0).cast("int") * 2 + (day % 3 == 0).cast("int"))
    judged = quality.report_verdict(quality.rule_summary(lines, 3600, ("kind",)), most_percent=5.0)
    return judged.select("kind", "bars", "r1", "r2", "r6", "verdict")


@query(f"{LISTED} SELECT symbol, ts, rule FROM listed WHERE severity = 'critical'")
def critical_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.critical(quality.violations(seeded(bars_of(spark, sf_dir)), 3600, None)).select("symbol", "ts", "rule")


@query(f"WITH {TICKS}, {bars_sql('bars', 90)} SELECT symbol, ts FROM bars WHERE second(ts) <> 0")
def rule_r5_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of ninety seconds, judged as minute bars: every other one starts inside a minute."""
    flagged = quality.flagged(bars_of(spark, sf_dir, 90), 60)
    return flagged.where(F.array_contains("rules", "R5")).select("symbol", "ts")


@query(f"{HOURLY} SELECT {BAR_COLUMNS.replace('round(vwap, 6) AS vwap, ', '')} FROM bars")
def bars_from_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars put together from seven batches of ticks that came in no order."""
    ticks = ticks_of(spark, sf_dir).withColumn("batch", F.pmod(F.xxhash64("trade_id"), F.lit(7)))
    parts = B.partial_bars(ticks, 3600, ["exchange", "symbol", "batch"]).drop("batch")
    return rounded(B.finished(B.merge_partials(parts)).drop("vwap"))


@query("SELECT event_type AS symbol, CAST(count(*) AS BIGINT) AS ticks, round(sum(value), 4) AS price_sum FROM events WHERE user_id % 7 <> 3 GROUP BY 1")
def raw_file_rejection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw JSON files, of which one group has a broken line each; such files are left out whole."""
    events = driver_table(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.lit("driver").alias("exchange"), F.col("event_type").alias("symbol"), F.col("value").alias("price"), F.col("event_id").alias("trade_id")))
    group = (F.col("user_id") % 7).alias("part")
    broken = spark.range(1).select(F.lit('{"symbol": "cut of').alias("value"), F.lit(3).cast("bigint").alias("part"))
    folder = f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
    # all rows of a part in one file, as a collector writes them; the broken line goes to the third
    events.select(line.alias("value"), group.cast("bigint")).unionByName(broken).repartition(7, "part").write.partitionBy("part").text(folder)
    kept = lake.ticks(spark, folder, reject="file")
    return rounded(kept.groupBy("symbol").agg(F.count("*").alias("ticks"), F.sum("price").alias("price_sum")), 4)


@query(f"{HOURLY} SELECT symbol, ts, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, round(volume_base, 6) AS volume_base, round(volume_quote, 6) AS volume_quote, trade_count, round(vwap, 6) AS vwap, round(bid, 6) AS bid, round(ask, 6) AS ask, round(spread, 6) AS spread FROM bars")
def export_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in the columns of the relational table."""
    return rounded(sink.projected(bars_of(spark, sf_dir), "bars"))


@query(f"{HOURLY} SELECT symbol, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, round(close, 6) AS close FROM bars WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def today_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's bars, a fixed one for today's, with times as ISO text."""
    day = slices.of_day(bars_of(spark, sf_dir), F.lit("2024-01-10").cast("date"))
    return rounded(scalars.iso_times(day.select("symbol", "ts", "close")))


@query(f"{HOURLY} SELECT symbol, ts, CAST(row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS INTEGER) AS place, round(close, 6) AS close FROM (SELECT * FROM bars WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-11')")
def newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A closed range of time, each symbol's bars numbered from the newest."""
    closed = B.time_slice(bars_of(spark, sf_dir), None, *[F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-11")], closed=True)
    order = Window.partitionBy("symbol").orderBy(F.desc("ts"))
    return rounded(closed.select("symbol", "ts", F.row_number().over(order).alias("place"), "close"))


@query(f"{EVIDENT} SELECT detector, count(*) AS anomalies FROM evident GROUP BY 1")
def detector_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.counts(_evident(spark, sf_dir))


@query(f"""WITH {TICKS}, {bars_sql('bars', 60)}, part AS (SELECT * FROM bars WHERE symbol IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'),
rolled AS (SELECT exchange, symbol, time_bucket(INTERVAL '900 seconds', ts, TIMESTAMP '1970-01-01') AS ts, first(open ORDER BY ts) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY ts) AS close, count(*) AS bar_count FROM part GROUP BY 1, 2, 3)
SELECT exchange, symbol, ts, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, bar_count FROM rolled""")
def slice_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter-hour bars of two symbols and a day: symbols, range and timeframe together."""
    day = [F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-06")]
    made = slices.bars_at(bars_of(spark, sf_dir, 60), "15m", *day, symbols=["click", "view"])
    return rounded(made.select("exchange", "symbol", "ts", "open", "high", "low", "close", "bar_count"))


@query(f"""{SEEDED}, known AS (SELECT symbol, ts, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts) AS known FROM seeded),
back AS (SELECT *, lag(known) OVER (PARTITION BY symbol ORDER BY ts) AS before FROM known)
SELECT symbol, ts, round(coalesce(known / nullif(before, 0) - 1, 0), 6) AS ret1 FROM back""")
def padded_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns over bars of which some lack a close."""
    return rounded(detect.padded_returns(seeded(bars_of(spark, sf_dir))).select("symbol", "ts", "ret1"))


@query(f"{HOURLY} SELECT count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM bars WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def day_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a day has come in."""
    return profiles.span(slices.of_day(bars_of(spark, sf_dir), F.lit("2024-01-10").cast("date"))).select("n_rows", "first_ts", "last_ts")


@query("SELECT count(*) AS n_rows, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts, count(DISTINCT o_custkey) AS distinct_values FROM orders")
def macro_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as macro rows, a ticker for each customer."""
    return profiles.span(driver_table(spark, sf_dir, "orders"), "o_orderdate", distinct="o_custkey").drop("days")
