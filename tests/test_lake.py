"""Writing and reading the lake, and streaming over files."""

import json
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from tests.test_cases import THREE_SECONDS, TICK
from tickloom.operators import bars
from tickloom.sinks import lake as sink
from tickloom.sources import lake
from tickloom.streaming import live


def test_rewriting_a_day_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "bars")
    made = bars.tick_bars(spark.createDataFrame(THREE_SECONDS, TICK)).withColumn("ts", F.col("ts").cast("timestamp"))
    later = made.withColumn("ts", F.col("ts") + F.expr("interval 1 day"))
    sink.write_bars(made.unionByName(later), root)
    sink.write_bars(made, root)
    assert lake.bars(spark, root).count() == 4
    day = lake.bars(spark, root, "x", datetime(2025, 1, 2, tzinfo=UTC), datetime(2025, 1, 3, tzinfo=UTC))
    assert day.count() == 2
    assert "PartitionFilters: [isnotnull" in day._jdf.queryExecution().toString()


def test_upsert_rewrites_only_touched_days(spark, tmp_path):
    root, staging = str(tmp_path / "k"), str(tmp_path / "staging")
    (tmp_path / "k").mkdir()
    frame = lambda close, minutes: spark.createDataFrame([("S", datetime(2025, 1, 1) + timedelta(minutes=m), close) for m in minutes], "symbol string, ts timestamp, close double")
    keys, parts = ["symbol", "ts"], ["symbol", "year", "month", "day"]
    sink.upsert_days(spark, frame(1.0, range(5)), root, staging, keys, parts)
    sink.upsert_days(spark, frame(2.0, range(3, 8)), root, staging, keys, parts)
    rows = spark.read.parquet(root).orderBy("ts").collect()
    assert [r.close for r in rows] == [1, 1, 1, 2, 2, 2, 2, 2]


def test_compaction_keeps_the_first_of_equal_keys(spark, tmp_path):
    made = bars.tick_bars(spark.createDataFrame(THREE_SECONDS, TICK))
    columns = ["exchange", "symbol", "ts", "close"]
    summary = sink.compact(made.unionByName(made), str(tmp_path / "daily"), columns).first()
    again = sink.compact(made, str(tmp_path / "daily"), columns).first()
    assert summary.n_rows == 2 and summary.content_sha256 == again.content_sha256
    assert lake.day_or_daily(spark, str(tmp_path / "daily"), "nowhere", datetime(2025, 1, 1)).count() == 2


def test_missing_records_are_empty(spark, tmp_path):
    assert lake.quality_records(spark, str(tmp_path / "none"), "violations").count() == 0


def test_plans_for_files(spark):
    local = spark.createDataFrame([("a/2025-01-01.parquet", 5), ("a/2025-01-02.parquet", 6), ("b.parquet", 7)], "path string, length bigint")
    remote = spark.createDataFrame([("b.parquet", 7)], "path string, length bigint")
    assert [r.path for r in sink.to_upload(local, remote, "2025-01-02").collect()] == ["a/2025-01-01.parquet"]
    old = spark.createDataFrame([("x.jsonl", datetime(2025, 1, 1)), ("y.jsonl", datetime(2025, 1, 9)), ("z.parquet", datetime(2025, 1, 1))], "path string, modificationTime timestamp")
    assert [r.path for r in sink.to_delete(old, 7, datetime(2025, 1, 10)).collect()] == ["x.jsonl"]


def test_stream_gives_the_batch_bars(spark, tmp_path):
    source, out = tmp_path / "raw", str(tmp_path / "bars")
    source.mkdir()
    fields = ("exchange", "symbol", "ts_event", "trade_id", "stream", "price", "qty", "bid", "ask")
    epoch = lambda t: int(t.replace(tzinfo=UTC).timestamp() * 1000)
    last = ("x", "S", datetime(2025, 1, 1, 1), 9, "trade", 1.0, 1.0, None, None)  # moves the watermark past all others
    for n, part in enumerate((THREE_SECONDS, [last])):
        lines = [json.dumps(dict(zip(fields, (*t[:2], epoch(t[2]), *t[3:]), strict=True))) for t in part]
        (source / f"{n}.jsonl").write_text("\n".join(lines) + "\n")
    query = live.write_bars(live.live_bars(live.tick_stream(spark, str(source), 1)), out, str(tmp_path / "checkpoint"), once=True)
    query.awaitTermination(120)
    closed = spark.read.parquet(out).where("ts < '2025-01-01 00:30:00'").select("open", "high", "low", "close", "volume_base", "bid").orderBy("open").collect()
    batch = bars.tick_bars(spark.createDataFrame(THREE_SECONDS, TICK)).select("open", "high", "low", "close", "volume_base", "bid").orderBy("open").collect()
    assert closed == batch
