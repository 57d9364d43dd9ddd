"""Small cases with known results."""

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions import scalars
from tickloom.operators import bars, detect, fusion, keys, profiles, quality
from tickloom.plans import qa, slices
from tickloom.sources import klines, wire

T0 = datetime(2025, 1, 1)
TICK = "exchange string, symbol string, ts timestamp_ntz, trade_id bigint, stream string, price double, qty double, bid double, ask double"


def tick(ms, price=None, qty=None, bid=None, ask=None, symbol="S", i=0):
    return ("x", symbol, T0 + timedelta(milliseconds=ms), i, "trade" if price is not None else "bookTicker", price, qty, bid, ask)


THREE_SECONDS = [tick(0, 100.0, 1.0, i=1), tick(500, 101.0, 2.0, i=2), tick(900, 102.0, 1.5, i=3), tick(1500, 101.0, 0.5, i=4), tick(1200, bid=99.5, ask=100.5), tick(2200, bid=99.0, ask=101.0)]


def test_tick_bars(spark):
    rows = bars.tick_bars(spark.createDataFrame(THREE_SECONDS, TICK)).orderBy("ts").collect()
    assert len(rows) == 2
    first, second = rows
    assert (first.open, first.high, first.low, first.close, first.volume_base, first.volume_quote, first.trade_count) == (100, 102, 100, 102, 4.5, 455, 3)
    assert first.vwap == pytest.approx(455 / 4.5) and first.bid is None
    assert (second.close, second.volume_base, second.bid, second.ask, second.spread) == (101, 0.5, 99.5, 100.5, 1.0)


def test_quote_only_seconds_can_be_filled(spark):
    ticks = spark.createDataFrame([tick(100, 100.0, 1.0), tick(1200, bid=99.5, ask=100.5), tick(2300, bid=99.6, ask=100.6), tick(3400, bid=99.7, ask=100.7)], TICK)
    assert bars.tick_bars(ticks).count() == 1
    rows = bars.tick_bars(ticks, fill="ffill").orderBy("ts").collect()
    assert [r.close for r in rows] == [100] * 4 and [r.volume_base for r in rows] == [1, 0, 0, 0] and rows[-1].bid == 99.7
    with pytest.raises(ValueError):
        bars.tick_bars(ticks, fill="zero")


def test_rollup_in_one_or_two_steps_is_the_same(spark):
    ticks = spark.createDataFrame([tick(i * 7000, 100.0 + i % 13, 1.0 + i % 3, i=i) for i in range(800)], TICK)
    base = bars.tick_bars(ticks)
    columns = ["ts", "open", "high", "low", "close", "volume_base", "trade_count"]
    once, twice = bars.rollup(base, 3600), bars.rollup(bars.rollup(base, 60), 3600)
    assert sorted(once.select(columns).collect()) == sorted(twice.select(columns).collect())
    assert once.agg(F.sum("volume_base")).first() == base.agg(F.sum("volume_base")).first()


def test_messages(spark):
    raw = spark.createDataFrame(
        [
            ('{"stream":"adausdt@trade","data":{"e":"trade","E":1699999999000,"s":"ADAUSDT","p":"0.2500","q":"10","t":12345678,"m":false}}', 5),
            ('{"stream":"adausdt@bookTicker","data":{"e":"bookTicker","E":1699999999500,"s":"ADAUSDT","b":"0.2498","a":"0.2502"}}', 5),
            ("not json", 5),
        ],
        "message string, ts_recv bigint",
    )
    trade, quote = wire.parse("binance", raw).orderBy("ts_event").collect()
    assert (trade.stream, trade.price, trade.qty, trade.side, trade.trade_id, trade.ts_event) == ("trade", 0.25, 10, "buy", 12345678, 1699999999000)
    assert (quote.stream, quote.bid, quote.ask, quote.trade_id, quote.price) == ("bookTicker", 0.2498, 0.2502, None, None)
    other = spark.createDataFrame([('{"type":"match","product_id":"B-U","time":"2025-01-01T00:00:00Z","price":"1","size":"2","side":"buy","trade_id":7}', 5), ('{"type":"heartbeat"}', 5)], "message string, ts_recv bigint")
    (row,) = wire.coinbase(other).collect()
    assert (row.symbol, row.price, row.qty, row.ts_event) == ("B-U", 1, 2, 1735689600000)
    both = spark.createDataFrame([('{"channel":"trade","data":[{"symbol":"A/B","price":1,"qty":2,"side":"buy","trade_id":1,"timestamp":"2025-01-01T00:00:00Z"},{"symbol":"A/B","price":3,"qty":2,"side":"buy","trade_id":2,"timestamp":"2025-01-01T00:00:01Z"}]}', 5)], "message string, ts_recv bigint")
    assert wire.kraken(both).count() == 2 and wire.kraken(both, first_only=True).count() == 1
    with pytest.raises(ValueError):
        wire.parse("nowhere", raw)


def clean_bars(spark):
    rows = [("x", "S", T0 + timedelta(seconds=i), 100.0 + i, 100.5 + i, 99.5 + i, 100.2 + i, 1000.0, 100200.0, 10, 100.1, 100.0 + i, 100.1 + i, 0.1) for i in range(5)]
    return spark.createDataFrame(rows, "exchange string, symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume_base double, volume_quote double, trade_count bigint, vwap double, bid double, ask double, spread double")


@pytest.mark.parametrize(("rule", "column", "value"), [("r1", "high", 99.0), ("r2", "close", -1.0), ("r3", "ask", 99.0), ("r4", "close", None), ("r6", "spread", -0.5), ("neg_vol", "volume_base", -1.0)])
def test_each_rule_finds_its_defect(spark, rule, column, value):
    frame = clean_bars(spark)
    broken = frame.withColumn(column, F.when(F.second("ts") == 0, F.lit(value).cast("double")).otherwise(F.col(column)))
    assert quality.rule_summary(frame).first()[rule] == 0
    assert quality.rule_summary(broken).first()[rule] == 1


def test_continuity_rule(spark):
    frame = clean_bars(spark)
    late = frame.withColumn("ts", F.when(F.second("ts") >= 2, F.col("ts") + F.expr("interval 5 seconds")).otherwise(F.col("ts")))
    assert quality.rule_summary(late).first()["r5"] == 1
    assert profiles.gap_rows(late, ["symbol"]).count() == 1


def test_clusters(spark):
    rows = [("S", "JUMP", T0 + timedelta(seconds=t), z) for t, z in ((0, 7.5), (1, 8.0), (3, 6.5), (9, 9.0))] + [("R", "JUMP", T0, 7.0)]
    found = {(r.symbol, r.start_ts): r for r in detect.clusters(spark.createDataFrame(rows, "symbol string, detector string, ts timestamp_ntz, z double"), 5).collect()}
    first = found["S", T0]
    assert len(found) == 3 and (first.n, first.end_ts, first.max_abs_z) == (3, T0 + timedelta(seconds=3), 8.0)
    assert detect.clusters(spark.createDataFrame(rows, "symbol string, detector string, ts timestamp_ntz, z double"), 0).count() == 5


@pytest.mark.parametrize(("levels", "score", "verdict"), [((), 1.0, "PASS"), (("critical", "critical"), 0.3, "FAIL"), (("major", "major"), 0.72, "REVIEW"), (("minor", "minor"), 0.93, "PASS")])
def test_fusion(spark, levels, score, verdict):
    symbols = spark.createDataFrame([("S",)], "symbol string")
    broken = spark.createDataFrame([("S", x) for x in levels], "symbol string, severity string")
    row = fusion.fuse(symbols, broken, spark.createDataFrame([], "symbol string, confidence double")).first()
    assert (row.score, row.verdict) == (pytest.approx(score), verdict)


def test_fusion_with_anomalies(spark):
    found = spark.createDataFrame([("S", 0.9)] * 5, "symbol string, confidence double")
    row = fusion.fuse(spark.createDataFrame([("S",)], "symbol string"), spark.createDataFrame([], "symbol string, severity string"), found).first()
    assert row.detector_score == pytest.approx(2 / 3) and row.ai_score == pytest.approx(0.1)


def test_dedup_and_upsert(spark):
    frame = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, seq int, v string")
    assert {r.v for r in keys.dedup(frame, ["k"], ["seq"]).collect()} == {"b", "c"}
    assert {r.v for r in keys.dedup(frame, ["k"], ["seq"], "first").collect()} == {"a", "c"}
    fresh = spark.createDataFrame([(2, 9, "d"), (3, 9, "e")], "k int, seq int, v string")
    assert {r.v for r in keys.upsert(keys.dedup(frame, ["k"], ["seq"]), fresh, ["k"]).collect()} == {"b", "d", "e"}


def test_klines_and_pages(spark):
    row = ["1735689600000", "100", "101", "99", "100.5", "1000", "1735689659999", "100500", "50", "1", "2", "x"]
    made = klines.typed(spark.createDataFrame([("S", row), ("S", ["bad"])], "symbol string, kline array<string>")).orderBy(F.col("open").asc_nulls_last()).collect()
    assert (made[0].open, made[0].trades, made[1].open) == (100, 50, None)
    assert len(klines.pages(["A", "B"], 0, 1440 * 60_000)) == 4
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError
        return [1]

    assert klines.with_retries(flaky) == [1] and len(calls) == 3


def fetched(symbol, start, stop):
    return [[ms, "1", "2", "0.5", "1.5", "10", ms + 59_999, "15", "3", "1", "1", "0"] for ms in range(start, stop, 60_000)]


def test_kline_source_reads_whole_days(spark):
    spark.dataSource.register(klines.KlineSource)
    frame = spark.read.format("klines").options(symbols="A,B", start="2025-01-01", stop="2025-01-02", fetch="tests.test_cases:fetched").load()
    assert klines.typed(frame).select("symbol", "open_time").distinct().count() == 2 * 1440


def test_arguments():
    now = datetime(2025, 3, 5, 12, tzinfo=UTC)
    assert scalars.parse_instant("TODAY", now) == datetime(2025, 3, 5, tzinfo=UTC)
    assert scalars.parse_instant("2025-01-01T02:00:00+02:00") == datetime(2025, 1, 1, tzinfo=UTC)
    assert scalars.parse_instant("") is None
    assert scalars.day_range("2025-01-31")[1] == datetime(2025, 2, 1, tzinfo=UTC)
    with pytest.raises(ValueError):
        scalars.parse_instant("soon")
    with pytest.raises(ValueError):
        slices.check_slice("1s", "klines")
    with pytest.raises(ValueError):
        qa.QaConfig.of({"zscore_k": -1})
    with pytest.raises(ValueError):
        qa.QaConfig.of({"colour": 1})


def test_report_and_schema(spark):
    stages = qa.chain(clean_bars(spark), 1)
    assert "PASS" in qa.report(stages, "2025-01-01")
    assert schemas.column_difference(clean_bars(spark), schemas.BAR_COLUMNS) == {"missing": ["window_start"], "extra": ["exchange", "ts"]}


def test_chain_judges_all_violations(spark):
    early = clean_bars(spark).limit(1).crossJoin(spark.range(30)).withColumn("ts", F.col("ts") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).drop("id").withColumn("high", F.lit(99.0))
    frame = early.unionByName(early.limit(3).withColumn("symbol", F.lit("T")))
    stages = qa.chain(frame, 1)
    assert {r.symbol: (r.critical, r.verdict) for r in stages["fused"].collect()} == {"S": (30, "FAIL"), "T": (3, "FAIL")}
    assert stages["violations"].count() == 25 and {r.rule: r.violations for r in stages["violation_counts"].collect()} == {"R1": 33}
    assert "| R1 | critical | 33 |" in qa.report(stages, "2025-01-01")


def test_preview_depends_on_the_last_printed_row(spark):
    rows = [("S", "JUMP", T0 + timedelta(seconds=t), 7.0) for t in (0, 1, 2, 3, 4)]
    shown = detect.preview(spark.createDataFrame(rows, "symbol string, detector string, ts timestamp, z double"), 2).orderBy("ts").collect()
    assert [r.ts.second for r in shown] == [0, 2, 4]


def test_forest_finds_an_outlier(spark):
    frame = clean_bars(spark).limit(1).crossJoin(spark.range(400)).withColumn("ts", F.col("ts") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)")))
    noisy = frame.withColumn("close", 100 + F.rand(1)).withColumn("vwap", F.when(F.col("id") == 200, 150.0).otherwise(F.col("close") * 1.0001)).drop("id")
    found = detect.isolation_forest(noisy, contamination=0.01, trees=50).collect()
    assert any(r.ts == T0 + timedelta(seconds=200) for r in found) and len(found) < 20
