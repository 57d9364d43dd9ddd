"""Series of several exchanges and days: neighbours, frames, as-of values, evidence, bursts, plans."""

import math
import os
import statistics
from datetime import datetime, timedelta

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.oracle import rows_of, same
from tickloom.operators import bars, detect, keys, ordered, quality
from tickloom.plans import catalog, qa, reports, slices
from tickloom.functions import scalars
from tickloom.sinks import lake as sink

T0 = datetime(2025, 1, 1)
ROW = "exchange string, symbol string, ts timestamp_ntz, x double"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def series(spark, values, step=timedelta(hours=5), exchanges=("a", "b")):
    """The same times on two exchanges, other values."""
    rows = [(e, "S", T0 + i * step, None if v is None else v * (1 + k)) for k, e in enumerate(exchanges) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ROW)


@pytest.mark.parametrize("after", [False, True])
def test_neighbours_of_two_exchanges_and_ties(spark, after):
    frame = series(spark, [1.0, 2.0, None, 4.0, 5.0, 6.0])
    tie = spark.createDataFrame([("a", "S", T0, 0.5)], ROW)
    near = ordered.with_neighbour(frame.unionByName(tie), ["exchange", "symbol"], ["x"], after=after)
    got = {e: [r[0] for r in near.where(F.col("exchange") == e).orderBy("ts", F.asc_nulls_first("x")).select("next_x" if after else "prev_x").collect()] for e in ("a", "b")}
    assert got["b"] == ([4.0, None, 8.0, 10.0, 12.0, None] if after else [None, 2.0, 4.0, None, 8.0, 10.0])
    assert got["a"] == ([1.0, 2.0, None, 4.0, 5.0, 6.0, None] if after else [None, 0.5, 1.0, 2.0, None, 4.0, 5.0])
    assert "SortAggregate" not in plan_of(near)


def test_positions(spark):
    frame = ordered.with_position(series(spark, [3.0] * 20), ["exchange", "symbol"], ["x"])
    for e in ("a", "b"):
        assert [r.position for r in frame.where(F.col("exchange") == e).orderBy("ts").collect()] == list(range(20))
    assert {r[0] for r in frame.select("rows_of_series").collect()} == {20}


@pytest.mark.parametrize("length", [1, 2, 3, 7, 50])
def test_trailing_moments_of_rows(spark, length):
    values = [1.0, 5.0, None, 2.0, 2.0, 9.0, -4.0, None, None, 1e6, 1.0, 1.5, 2.5]
    frame = ordered.with_position(series(spark, values), ["exchange", "symbol"], ["x"])
    got = ordered.trailing_moments(frame, ["exchange", "symbol"], "position", length, ["x"]).orderBy("exchange", "ts").collect()
    assert len(got) == 2 * len(values)
    for r in got:
        scale = 1 if r.exchange == "a" else 2
        own = [v * scale for v in values[max(0, r.position - length + 1) : r.position + 1] if v is not None]
        m = r.x_moments
        assert m.n == len(own)
        if own:
            assert m.mean == pytest.approx(statistics.fmean(own))
            assert m.m2 == pytest.approx(statistics.pvariance(own) * len(own), abs=1e-9, rel=1e-12)


def test_trailing_moments_of_times_with_ties(spark):
    at = [0, 10, 10, 19, 20, 29, 30, 30, 31, 95, 104, 105]
    frame = spark.createDataFrame([("S", t, float(i)) for i, t in enumerate(at)], "symbol string, at bigint, x double")
    for length in (1, 10, 11, 40):
        for r in ordered.trailing_moments(frame, ["symbol"], "at", length, ["x"]).collect():
            own = [float(i) for i, t in enumerate(at) if r["at"] - length < t <= r["at"]]
            assert r.x_moments.n == len(own) and r.x_moments.mean == pytest.approx(statistics.fmean(own)), (length, r)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e3, 1e3), min_size=1, max_size=6), st.lists(st.floats(-1e3, 1e3), min_size=0, max_size=6))
def test_merged_moments(spark, a, b):
    of = lambda v: F.struct(F.lit(len(v)).alias("n"), F.lit(statistics.fmean(v) if v else 0.0).alias("mean"), F.lit(statistics.pvariance(v) * len(v) if v else 0.0).alias("m2"))
    m = spark.range(1).select(ordered.merged(of(a), of(b)).alias("m")).first().m
    both = a + b
    assert m.n == len(both) and math.isclose(m.mean, statistics.fmean(both), abs_tol=1e-9) and math.isclose(m.m2, statistics.pvariance(both) * len(both), rel_tol=1e-6, abs_tol=1e-3)


def test_no_window_over_a_whole_series(spark):
    frame = detect.zscores(catalog.bars_of(spark, SF), 48, 3.0)
    windows = [line for line in plan_of(frame).splitlines() if "Window" in line and "windowspecdefinition" in line]
    assert windows
    for line in windows:
        spec = line.split("windowspecdefinition(")[1]
        # rows are in windows of a day or block; whole series only in windows over days
        assert "__day" in spec or "__block" in spec or "sum(__n" in line, line
    assert "Python" not in plan_of(frame)


def test_as_of(spark):
    left = spark.createDataFrame([(k, T0 + timedelta(hours=h), h) for k in ("S", "T", "U") for h in (0, 1, 30, 80)], "symbol string, ts timestamp_ntz, h int")
    right = spark.createDataFrame([("S", T0 + timedelta(hours=1), 1.0, 2.0), ("S", T0 + timedelta(hours=29), 3.0, None), ("T", T0 + timedelta(hours=50), 9.0, 9.0)], "symbol string, ts timestamp_ntz, a double, b double")
    at = {(r.symbol, r.h): (r.a, r.b) for r in ordered.as_of(left, right, ["symbol"], ["a", "b"]).collect()}
    assert [at["S", h] for h in (0, 1, 30, 80)] == [(None, None), (1.0, 2.0), (3.0, None), (3.0, None)]
    assert [at["T", h] for h in (0, 1, 30, 80)] == [(None, None)] * 3 + [(9.0, 9.0)]
    assert all(at["U", h] == (None, None) for h in (0, 1, 30, 80))
    before = {(r.symbol, r.h): r.a for r in ordered.as_of(left, right, ["symbol"], ["a", "b"], strict=True).collect()}
    assert before["S", 1] is None and before["S", 30] == 3.0
    plan = plan_of(ordered.as_of(left, right, ["symbol"], ["a", "b"]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_filled_bars_carry_over_days(spark):
    tick = lambda h, price=None, bid=None: ("x", "S", T0 + timedelta(hours=h), h, "trade" if price else "bookTicker", price, 1.0 if price else None, bid, bid)
    ticks = spark.createDataFrame([tick(0, bid=1.0), tick(1, 5.0), tick(30, bid=2.0), tick(100, bid=3.0), tick(101, 7.0)], "exchange string, symbol string, ts timestamp_ntz, trade_id bigint, stream string, price double, qty double, bid double, ask double")
    rows = bars.tick_bars(ticks, 3600, fill="ffill").orderBy("ts").collect()
    assert [(r.ts - T0, r.close) for r in rows] == [(timedelta(hours=h), c) for h, c in ((1, 5.0), (30, 5.0), (100, 5.0), (101, 7.0))]


def test_tick_order_with_null_ids_old_times_and_long_ids(spark):
    schema = "exchange string, symbol string, ts timestamp_ntz, trade_id {}, stream string, price double, qty double, bid double, ask double"
    old = datetime(1969, 12, 31, 23, 59, 59)
    for kind, ids in (("bigint", (None, -(2**63), -1, 2**63 - 1)), ("decimal(26,0)", (None, -(10**26) + 1, 0, 10**26 - 1))):
        from decimal import Decimal

        number = (lambda i: i) if kind == "bigint" else (lambda i: None if i is None else Decimal(i))
        rows = [("x", "S", old, number(i), "trade", float(p), 1.0, None, None) for p, i in enumerate(ids)]
        rows.append(("x", "S", old + timedelta(milliseconds=1), number(0), "trade", 50.0, 1.0, None, None))
        made = bars.tick_bars(spark.createDataFrame(rows, schema.format(kind)), 86400)
        one = made.first()
        assert (one.open, one.close, one.trade_count) == (0.0, 50.0, 5)
        assert "SortAggregate" not in plan_of(made)


def test_parts_of_bars_in_any_order_make_the_bars(spark):
    ticks = catalog.ticks_of(spark, SF)
    whole = bars.tick_bars(ticks, 3600)
    parts = [bars.partial_bars(ticks.where(F.col("trade_id") % 3 == k), 3600) for k in (2, 0, 1)]
    made = bars.finished(bars.merge_partials(bars.merge_partials(parts[0].unionByName(parts[1])).unionByName(parts[2])))
    rows = lambda df: sorted(catalog.rounded(df).collect(), key=str)
    assert rows(made) == rows(whole)


def test_a_violation_masks_only_its_own_exchange(spark):
    bar = lambda e, high: (e, "S", T0, 1.0, high, 1.0, 1.0, 1.0, 1.0, None, None, None)
    frame = spark.createDataFrame([bar("a", 0.5), bar("b", 1.0)], "exchange string, symbol string, ts timestamp, open double, high double, low double, close double, volume_base double, volume_quote double, spread double, bid double, ask double")
    broken = quality.violations(frame, 1, None)
    assert {(r.exchange, r.is_clean) for r in keys.clean_rows(frame, broken).collect()} == {("a", False), ("b", True)}
    judged = quality.flagged(frame, 1)
    assert sorted(quality.violations(judged, 1, None).collect()) == sorted(broken.collect())


# Bursts, as the detector's records describe them


def anomaly(spark, rows):
    frame = spark.createDataFrame([(s, d, T0 + timedelta(seconds=t), z, f"Test {i}") for i, (s, d, t, z) in enumerate(rows)], "symbol string, detector string, ts timestamp, z double, rationale string")
    return frame.withColumns({"features": F.create_map(F.lit("z_score"), F.col("z")), "label": F.lit("anomaly"), "confidence": F.lit(0.5)})


def test_bursts_keep_the_first_record(spark):
    rows = [("S", "JUMP", 0, 7.5), ("S", "JUMP", 1, -8.0), ("S", "JUMP", 3, 6.5), ("S", "JUMP", 9, 9.0), ("T", "JUMP", 1, 7.0), ("S", "ZSCORE_SPREAD_BP", 1, 7.0)]
    made = detect.records(detect.clusters(anomaly(spark, rows), 5)).orderBy("symbol", "detector", "ts").collect()
    assert len(made) == 4
    first, second = made[0], made[1]
    assert (first.cluster["count"], first.cluster["max_abs_z"]) == (3, 8.0)
    assert (first.cluster["end_ts"] - first.cluster["start_ts"]).total_seconds() == 3
    assert first.rationale == "Test 0" and first.features == {"z_score": 7.5} and first.label == "anomaly"
    assert second.cluster is None and second.rationale == "Test 3"
    assert detect.records(detect.clusters(anomaly(spark, rows), 0)).where("cluster is not null").count() == 0
    assert detect.records(detect.clusters(anomaly(spark, []), 5)).count() == 0


def test_evidence_of_each_detector(spark):
    rows = [("S", "ZSCORE_SPREAD_BP", 7.129, 33.0, None, None), ("S", "JUMP", -9.5, None, 0.25, 12.0), ("S", "IFOREST", 0.75, None, None, None), ("S", "JUMP", 7.0, None, 0.1, None)]
    frame = spark.createDataFrame(rows, "symbol string, detector string, z double, value double, ret double, spread_bp double")
    z, jump, forest, unknown = detect.evidence(frame, 5.0, 6.0).collect()
    assert z.features == {"spread_bp": 33.0, "z_score": 7.129} and z.rationale == "spread_bp Z-score 7.13 exceeds threshold 5.0"
    assert jump.features == {"log_return": 0.25, "z_score": -9.5, "spread_bp": 12.0} and jump.rationale == "Price jump Z-score -9.50 exceeds 6.0"
    assert forest.features == {"anomaly_score": 0.75} and "0.750" in forest.rationale
    assert unknown.features["spread_bp"] is None


def test_examples_are_bounded_before_the_shuffle(spark):
    rows = [("S", f"D{i % 2}", i, 1.0) for i in range(60)]
    chosen = detect.examples(anomaly(spark, rows), 10)
    assert plan_of(chosen).count("WindowGroupLimit") == 2  # on both sides of the exchange
    got = chosen.collect()
    assert len(got) == 20 and {r.total for r in got} == {30} and max(r.place for r in got) == 10


def test_busiest_symbols_name_the_first(spark):
    rows = [("S", "JUMP", 5, 7.5), ("S", "JUMP", 6, 8.0), ("T", "JUMP", 1, 9.0), ("S", "ZSCORE_X", 1, 3.0)]
    top = detect.weighted_counts(detect.clusters(anomaly(spark, rows), 5)).collect()
    assert [(r.symbol, r.anomalies, r.bursts, r.first_rationale) for r in top] == [("S", 3, 2, "Test 3"), ("T", 1, 1, "Test 2")]


# The chain and its reports


def test_the_chain_reads_its_bars_once(spark):
    stages = qa.chain(catalog.bars_of(spark, SF), 3600)
    for name in ("fused", "records", "violations", "violation_counts"):
        plan = plan_of(stages[name])
        assert "events.parquet" not in plan and "FileScan" not in plan, name
    assert plan_of(catalog.fusion_scores(spark, SF)).count("FileScan") == 0
    page = qa.report(stages, "2025-01-01")
    assert "## Violations by rule" in page and "## Examples by detector" in page


def test_every_verdict_occurs(spark):
    assert {r.verdict for r in catalog.report_verdicts(spark, "/root/testdata/sf0.01").collect()} == {"PASS", "INVESTIGATE", "FAIL"}


def test_rules_and_parity_reports(spark):
    own = catalog.bars_of(spark, SF)
    page = reports.rules_report(catalog.seeded(own), 3600, "all", "2024-01-01", "2024-02-01", "1h")
    assert "| R1 | OHLC ordering violation |" in page and "FAIL: critical violations" in page and "... and" in page
    assert all(len(part) < 400 for part in page.splitlines())
    even = reports.parity_report(own, own, "2024-01-01", "2024-02-01")
    assert "None." in even
    odd = reports.parity_report(own, catalog.reference_of(spark, SF), "2024-01-01", "2024-02-01")
    assert "### click" in odd and odd.count("\n| 2024") <= 25 * 10


def test_text_report(spark, tmp_path):
    frame = catalog.bars_of(spark, SF).where("symbol = 'click'")
    n = frame.count()
    lines = dict(x.split(": ", 1) for x in reports.validation_lines(frame.unionByName(frame.limit(1)), "driver", "click", 3600).splitlines())
    assert int(lines["rows"]) == n + 1 and lines["duplicates"] == "1" and int(lines["gaps"]) >= 0 and lines["symbol"] == "click"
    reports.write_text(spark, str(tmp_path / "deep" / "report.txt"), "ä: 1\n")
    assert (tmp_path / "deep" / "report.txt").read_text() == "ä: 1\n"
    assert reports.validation_lines(frame, "driver", "nothing").splitlines()[2] == "rows: 0"


def test_export_needs_its_columns(spark):
    with pytest.raises(ValueError):
        sink.projected(spark.range(1), "bars")
    with pytest.raises(ValueError):
        sink.projected(spark.range(1), "unknown")


def test_iso_times_and_days(spark):
    frame = spark.createDataFrame([(datetime(2025, 1, 2, 3, 4, 5, 600000), datetime(2025, 1, 2, 3, 4, 5), datetime(2025, 1, 2).date(), 7)], "a timestamp_ntz, b timestamp, c date, d int")
    assert tuple(scalars.iso_times(frame).first()) == ("2025-01-02T03:04:05.600000", "2025-01-02T03:04:05+00:00", "2025-01-02", 7)
    edge = spark.createDataFrame([(datetime(2025, 1, 2),), (datetime(2025, 1, 2, 23, 59, 59),), (datetime(2025, 1, 3),)], "ts timestamp")
    assert slices.of_day(edge, datetime(2025, 1, 2).date()).count() == 2
    assert slices.of_day(spark.sql("select current_timestamp() as ts union all select current_timestamp() - interval 2 days")).count() == 1


def test_orders_of_lists(spark):
    """The read calls and reports give their rows in the order they promise."""
    own = catalog.bars_of(spark, SF)
    engine = slices.Engine(own)
    newest = [r.ts for r in engine.bars("click", "1h", limit=50).collect()]
    assert newest == sorted(newest, reverse=True) and len(newest) == 50
    ascending = [r.ts for r in engine.latest("click", "1h", 20).collect()]
    assert ascending == sorted(ascending) and ascending == newest[:20][::-1]
    part = [(r.symbol, r.ts) for r in slices.slice_of(own, own, ["view", "click"], None, None, "1h").collect()]
    assert part == sorted(part) and {s for s, _ in part} == {"view", "click"}
    counts = quality.violation_counts(quality.violations(catalog.seeded(own), 3600, None)).collect()
    rank = {"critical": 0, "major": 1, "minor": 2}
    assert [(rank[r.severity], -r.violations, r.rule) for r in counts] == sorted((rank[r.severity], -r.violations, r.rule) for r in counts)


def test_plans_that_were_heavy(spark):
    """No sort of all ticks for bars of ticks with whole-number ids."""
    assert "SortAggregate" not in plan_of(catalog.QUERIES["ohlcv_1h"](spark, SF))
    assert "SortAggregate" not in plan_of(catalog.candle_changes(spark, SF))


def test_compaction_counts_gaps_and_reads_only_its_days(spark, tmp_path):
    root = str(tmp_path / "daily")
    frame = lambda day, seconds: spark.createDataFrame([("x", "S", T0 + timedelta(days=day, seconds=t), 1, 1.0) for t in seconds], "exchange string, symbol string, ts timestamp, trade_count bigint, close double")
    columns = ["exchange", "symbol", "ts", "close"]
    sink.compact(frame(5, [0, 1]), root, columns)
    summary = {str(r.date): r for r in sink.compact(frame(0, [86395, 86397, 86399]).unionByName(frame(1, [0, 7, 8, 20])), root, columns).collect()}
    # the second day's first row comes a second after the first day's last
    assert {d: (r.n_rows, r.gaps) for d, r in summary.items()} == {"2025-01-01": (3, 2), "2025-01-02": (4, 2)}
    assert spark.read.parquet(root).select("date").distinct().count() == 3


def test_detectors_are_pluggable(spark):
    own = catalog.bars_of(spark, SF)

    def first_hour(clean, masked, config):
        return clean.where(F.hour("ts") == 0).select("exchange", "symbol", "ts", F.lit("MIDNIGHT").alias("detector"), F.lit(9.0).alias("z"))

    with pytest.raises(ValueError):
        qa.QaConfig(detectors=("midnight",))
    qa.DETECTORS["midnight"] = first_hour
    try:
        stages = qa.chain(own, 3600, qa.QaConfig(detectors=("jump", "midnight")))
        rows = stages["anomalies"].where("detector = 'MIDNIGHT'")
        assert rows.count() > 0 and rows.first().label == "anomaly" and rows.first().confidence == 0.5
    finally:
        del qa.DETECTORS["midnight"]
    silent = qa.chain(own, 3600, qa.QaConfig(detectors=(), labeler="none"))
    assert silent["anomalies"].count() == 0 and silent["fused"].count() > 0
    named = qa.chain(own, 3600, qa.QaConfig(detectors=("zscore",), zscore_k=0.5, labeler="none"))["anomalies"]
    assert named.count() > 0 and {(r.label, r.confidence) for r in named.collect()} == {("unreviewed", 0.5)}


def test_the_forest_finds_outliers_of_either_exchange(spark):
    own = catalog.two_exchanges(spark, SF).withColumn("ask", F.coalesce("ask", F.lit(11.0))).withColumn("bid", F.coalesce("bid", F.lit(10.0))).withColumn("spread", F.col("ask") - F.col("bid"))
    odd = own.withColumn("vwap", F.when((F.col("exchange") == "north") & (F.dayofmonth("ts") == 3), F.col("close") * 50).otherwise(F.col("vwap")))
    found = detect.isolation_forest(odd, contamination=0.02)
    assert found.count() > 0 and set(found.columns) == {"exchange", "symbol", "ts", "detector", "score"}
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, detect.isolation_forest(odd, contamination=0.02).collect()))


def test_tables_and_exports(spark, tmp_path):
    made = sink.projected(catalog.bars_of(spark, SF), "bars")
    sink.export(catalog.bars_of(spark, SF), str(tmp_path / "p"), table="bars")
    sink.export(made, str(tmp_path / "c"), "csv")
    assert spark.read.parquet(str(tmp_path / "p")).columns == list(made.columns) and spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == made.count()
    with pytest.raises(ValueError):
        sink.export(made, str(tmp_path / "x"), "xml")
    assert spark.range(1).select(scalars.basis_points(F.lit(1.0), F.lit(200.0)), scalars.basis_points(F.lit(1.0), F.lit(0.0))).first()[:] == (50.0, None)


@pytest.fixture(scope="module")
def worthless(tmp_path_factory):
    """Events with closes of zero in wide spreads (view) and in stable ones (click), and one below zero (signup)."""
    folder = tmp_path_factory.mktemp("worthless")
    value = """CASE WHEN event_type = 'view' AND day(ts) = 3 THEN 0.0
      WHEN user_id % 2 = 0 AND event_type = 'click' AND day(ts) = 5 THEN 0.0
      WHEN user_id % 2 = 0 AND event_type = 'signup' AND day(ts) = 5 THEN -1.0
      WHEN user_id % 2 <> 0 AND event_type IN ('click', 'signup') THEN value + 10000 ELSE value END"""
    for f in os.listdir(SF):
        if f != "events.parquet":
            os.symlink(f"{SF}/{f}", folder / f)
    duckdb.sql(f"COPY (SELECT * REPLACE ({value} AS value) FROM '{SF}/events.parquet' ORDER BY event_id) TO '{folder}/events.parquet'")
    return str(folder)


@pytest.mark.parametrize(
    "name", ["jump", "jump_traded", "label", "cluster_sessions", "cluster_counts", "burst_preview", "fusion_scores", "anomaly_records", "burst_records", "busiest_symbols", "detector_counts", "detector_examples"]
)
def test_jumps_of_worthless_closes_equal_sql(spark, worthless, name):
    same(catalog.QUERIES[name](spark, worthless), worthless, catalog.ORACLE_SQL[name])


def told_apart(rows):
    """Rows in which a number that is none does not count as null."""
    return [[1e300 if isinstance(v, float) and math.isnan(v) else v for v in r] for r in rows]


@pytest.mark.parametrize("name", ["burst_preview", "jump", "cluster_sessions"])
def test_scores_that_are_no_numbers_are_not_null(spark, worthless, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{worthless}/events.parquet'")
    wanted = con.execute(catalog.ORACLE_SQL[name])
    columns, wanted = [d[0] for d in wanted.description], told_apart(wanted.fetchall())
    assert any(1e300 in r for r in wanted)
    df = catalog.QUERIES[name](spark, worthless)
    assert rows_of(df.columns, told_apart(df.collect())) == rows_of(columns, wanted)


@pytest.fixture(scope="module")
def nameless(tmp_path_factory):
    """Events most of which have no type, so that one series has no symbol."""
    folder = tmp_path_factory.mktemp("nameless")
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN event_type = 'click' THEN event_type END AS event_type) FROM '{SF}/../sf0.01/events.parquet' ORDER BY event_id) TO '{folder}/events.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", ["jump", "jump_traded", "cluster_sessions", "cluster_counts", "detector_counts", "burst_records", "detector_examples"])
def test_a_series_without_symbol_stays(spark, nameless, name):
    df = catalog.QUERIES[name](spark, nameless)
    assert "symbol" not in df.columns or df.where("symbol IS NULL").count() > 0
    same(df, nameless, catalog.ORACLE_SQL[name])


@pytest.fixture(scope="module")
def timeless(tmp_path_factory):
    """Events some of which have no time."""
    folder = tmp_path_factory.mktemp("timeless")
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 11 > 0 THEN ts END AS ts) FROM '{SF}/../sf0.01/events.parquet' ORDER BY event_id) TO '{folder}/events.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", ["jump_traded", "cluster_sessions", "cluster_counts", "detector_counts"])
def test_rows_without_a_time_stay(spark, timeless, name):
    same(catalog.QUERIES[name](spark, timeless), timeless, catalog.ORACLE_SQL[name])


@pytest.fixture(scope="module")
def negative(tmp_path_factory):
    """Events some of which are worth less than nothing, others nothing."""
    folder = tmp_path_factory.mktemp("negative")
    value = "CASE WHEN event_id % 31 = 0 THEN -value WHEN event_type = 'click' AND event_id % 37 = 0 THEN 0.0 ELSE value END"
    duckdb.sql(f"COPY (SELECT * REPLACE ({value} AS value) FROM '{SF}/../sf0.01/events.parquet' ORDER BY event_id) TO '{folder}/events.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", ["burst_records", "detector_examples"])
def test_sentences_on_closes_below_zero_equal_sql(spark, negative, name):
    df = catalog.QUERIES[name](spark, negative)
    assert df.where("rationale LIKE '% nan %'").count() > 0
    same(df, negative, catalog.ORACLE_SQL[name])


def test_scores_that_are_no_numbers_in_sentences(spark):
    rows = [(2.5, 1.0, 1.0), (math.inf, 1.0, 1.0), (-math.inf, 1.0, 1.0), (math.nan, 1.0, -math.inf), (math.nan, math.nan, 1.0), (math.nan, 1.0, math.nan), (math.nan, None, None)]
    frame = spark.createDataFrame(rows, "z double, ret double, mean double")
    said = [r[0] for r in frame.select(detect.hundredths(F.col("z"), F.col("ret"), F.col("mean"))).collect()]
    assert said == ["2.50", "inf", "-inf", "-nan", "nan", "nan", "-nan"]


def test_the_first_of_equal_beginnings_goes_by_exchange(spark):
    rows = [(e, "S", "JUMP", T0, T0, 1, 3.0, f"of {e}", f"label of {e}") for e in ("b", "a", "c")]
    frame = spark.createDataFrame(rows, "exchange string, symbol string, detector string, start_ts timestamp, end_ts timestamp, n bigint, max_abs_z double, rationale string, label string")
    for order in (F.asc("exchange"), F.desc("exchange")):
        r = detect.weighted_counts(frame.coalesce(1).sortWithinPartitions(order)).first()
        assert (r.first_rationale, r.first_label) == ("of a", "label of a")
