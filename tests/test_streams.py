"""Streams against their batch results, with late data, replays and restarts."""

import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tickloom.operators import bars, detect, profiles
from tickloom.plans import catalog
from tickloom.sinks import lake as sink
from tickloom.sources import digests, lake
from tickloom.streaming import bursts, health, live

T0 = datetime(2025, 1, 1)


def tick(seconds, price, i, symbol="S", late=5):
    at = int((T0 + timedelta(seconds=seconds)).replace(tzinfo=UTC).timestamp() * 1000)
    return {"exchange": "x", "symbol": symbol, "ts_event": at, "ts_recv": at + late, "trade_id": i, "stream": "trade", "price": price, "qty": 1.0}


def put(folder, name, ticks):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(t) + "\n" for t in ticks))


BATCHES = [
    [tick(0.2, 10.0, 1), tick(0.8, 12.0, 2), tick(1.5, 11.0, 3), tick(3.0, 20.0, 9, "7")],
    [tick(2.1, 13.0, 4), tick(86400.5, 50.0, 5)],
    [tick(0.5, 99.0, 6), tick(0.1, 8.0, 7), tick(2.05, 1.0, 8)],  # late by a day; one before the stored open
]


def stored(spark, root):
    return sorted((str(r.symbol), r.ts, r.open, r.high, r.low, r.close, r.volume_base, r.trade_count) for r in spark.read.parquet(root).collect())


def test_batches_repair_stored_bars(spark, tmp_path):
    raw, root, parts, checkpoint = tmp_path / "raw", *(str(tmp_path / n) for n in ("bars", "parts", "checkpoint"))
    done = []
    for n, batch in enumerate(BATCHES):  # each start goes on from the checkpoint
        put(raw, f"{n}.jsonl", batch)
        live.upsert_bars(live.tick_stream(spark, str(raw)), root, parts, checkpoint, once=True, after=done.append).awaitTermination(120)
    assert done == [0, 1, 2]
    every = live_batch(spark, raw)
    wanted = sorted((r.symbol, r.ts, r.open, r.high, r.low, r.close, r.volume_base, r.trade_count) for r in bars.tick_bars(every).collect())
    assert stored(spark, root) == wanted and wanted[1][2:6] == (8.0, 99.0, 8.0, 12.0)
    before = stored(spark, root)
    again = live_batch(spark, raw).where("trade_id in (6, 7, 8)")
    live.upsert_batch(again, 2, root, parts)  # the same batch again
    live.upsert_batch(again.limit(0), 3, root, parts)
    assert stored(spark, root) == before


def live_batch(spark, raw):
    return lake.ticks(spark, str(raw)).withColumn("ts", F.timestamp_millis("ts_event"))


def test_an_empty_first_batch_stores_nothing(spark, tmp_path):
    put(tmp_path / "raw", "0.jsonl", BATCHES[0])
    live.upsert_batch(live_batch(spark, tmp_path / "raw").limit(0), 0, str(tmp_path / "bars"), str(tmp_path / "parts"))
    assert not (tmp_path / "bars").exists()


def test_preview_on_a_stream_equals_the_batch(spark, tmp_path):
    frame = detect.jumps(catalog.bars_of(spark, "/root/testdata/sf0.01"), 2.0).select("exchange", "symbol", "detector", F.col("ts").cast("timestamp").alias("ts"), "z")
    rows = frame.orderBy("ts").collect()
    quiet = 172_800
    wanted = sorted((r.symbol, r.ts, r.z) for r in detect.preview(frame, quiet).collect())
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    third = len(rows) // 3
    last = max(r.ts for r in rows) + timedelta(days=30)
    for n, part in enumerate((rows[:third], rows[third : 2 * third], rows[2 * third :], [("driver", "end", "JUMP", last, 0.0)], [("driver", "end", "JUMP", last + timedelta(days=9), 0.0)])):
        # each step is a restart; rows of one file come in no order
        spark.createDataFrame(sorted(part, key=str, reverse=True), frame.schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(frame.schema).parquet(str(source))
        bursts.write_preview(bursts.live_preview(stream, quiet, "1 hour"), out, checkpoint).awaitTermination(180)
        assert n < 4 or sorted((r.symbol, r.ts, r.z) for r in spark.read.parquet(out).where("symbol <> 'end'").collect()) == wanted
    assert wanted


def test_heartbeat_of_a_replay(spark, tmp_path):
    for n, batch in enumerate(BATCHES):
        put(tmp_path / "raw", f"{n}.jsonl", [{**t, "ts_recv": t["ts_event"] + 10 * (i + 1)} for i, t in enumerate(batch)])
    beat = health.Heartbeat("TEST")
    spark.streams.addListener(beat)
    try:
        ticks = health.observed(live.tick_stream(spark, str(tmp_path / "raw"), 1))
        query = live.write_bars(live.live_bars(ticks), str(tmp_path / "out"), str(tmp_path / "checkpoint"), once=True)
        query.awaitTermination(120)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
        import time

        for _ in range(50):  # Python hears of the end a little later
            if beat.status == "stopped" and beat.batches >= 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(beat)
    whole = health.profile(live_batch(spark, tmp_path / "raw"))
    events = spark.createDataFrame([("x", "disconnected", T0, 1.5), ("x", "connected", T0 + timedelta(seconds=9), 2.0)], "exchange string, event string, ts timestamp, gap_seconds double")
    payload = beat.payload(profiles.connection_gaps(events), datetime(2025, 1, 3, tzinfo=UTC))
    c = payload["collector"]
    assert (c["ticks"], c["trades"], c["status"]) == (whole["ticks"], whole["trades"], "stopped") == (9, 9, "stopped")
    assert c["last_seen_ts"] == datetime.fromtimestamp(whole["last_ms"] / 1000, UTC).isoformat() and c["latency_max_ms"] == whole["latency_max_ms"] == 40
    health.write_heartbeat(spark, payload, str(tmp_path / "beat.json"), str(tmp_path / "beat.md"))
    assert json.loads((tmp_path / "beat.json").read_text())["collector"]["ticks"] == 9
    page = (tmp_path / "beat.md").read_text()
    assert "STOPPED" in page and "| x |" in page and "Mode: TEST" in page
    assert [health.overall(*s) for s in (("running",), ("running", "error"), ("stopped",), ("starting",))] == ["HEALTHY", "ERROR", "STOPPED", "UNKNOWN"]


def drained(frame, spark, name, mode):
    """What a stream gives in memory when all its input is read."""
    query = frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.table(name)


def test_messages_candles_clusters_and_rotation(spark, tmp_path):
    message = lambda i, price: json.dumps({"stream": "s@trade", "data": {"e": "trade", "E": 1735689600000 + i * 1000, "s": "S", "p": str(price), "q": "2", "t": i, "m": False}})
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "0.txt").write_text("\n".join([message(i, 10 + i) for i in range(5)] + ["not json"]) + "\n")
    ticks = drained(live.message_stream(spark, str(tmp_path / "m"), "binance"), spark, "messages", "append").collect()
    assert sorted(r.price for r in ticks) == [10, 11, 12, 13, 14] and ticks[0].ts == datetime(2025, 1, 1) + timedelta(seconds=ticks[0].trade_id)
    put(tmp_path / "raw", "0.jsonl", BATCHES[0])
    put(tmp_path / "raw", "1.jsonl", BATCHES[1])
    stream = lambda: live.tick_stream(spark, str(tmp_path / "raw"), 1)
    candles = drained(live.live_candle(stream(), 60), spark, "candles", "update")
    last = candles.where("symbol = 'S'").groupBy("ts").agg(F.max_by("close", "volume_base").alias("close"), F.max("volume_base").alias("volume")).orderBy("ts").collect()
    assert [(r.close, r.volume) for r in last] == [(13.0, 4.0), (50.0, 1.0)]  # the newest state of each candle
    live.write_rotated(stream(), str(tmp_path / "rotated"), str(tmp_path / "c1"), "1 second").processAllAvailable()
    for q in spark.streams.active:
        q.stop()
    kept = spark.read.json(str(tmp_path / "rotated"))
    assert kept.count() == 6 and {str(r.date) for r in kept.select("date").distinct().collect()} == {"2025-01-01", "2025-01-02"}
    rows = [("S", "JUMP", T0 + timedelta(seconds=t), z) for t, z in ((0, 7.0), (3, -9.0), (20, 8.0), (500, 1.0))]
    for n, r in enumerate(rows):
        spark.createDataFrame([r], "symbol string, detector string, ts timestamp, z double").coalesce(1).write.mode("append").parquet(str(tmp_path / "a"))
    found = spark.readStream.schema("symbol string, detector string, ts timestamp, z double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "a"))
    closed = drained(live.live_clusters(found, 5, "1 minute"), spark, "clusters", "append").orderBy("start_ts").collect()
    assert [(r.n, r.max_abs_z) for r in closed] == [(2, 9.0), (1, 8.0)]


# Raw files, digests, database


def test_a_bad_line_rejects_its_file(spark, tmp_path):
    put(tmp_path / "raw", "good.jsonl", BATCHES[0])
    put(tmp_path / "raw", "bad.jsonl", BATCHES[1])
    with open(tmp_path / "raw" / "bad.jsonl", "a") as f:
        f.write("\n  \n{'single': 1}\n{\"cut\": \n[1, 2]\n")
    (tmp_path / "raw" / "wrong.jsonl").write_text('{"symbol": "W", "price": "none", "extra": {"x": 1}}\n')
    assert [(r.file.rsplit("/", 1)[1], r.bad_lines) for r in lake.bad_files(spark, str(tmp_path / "raw")).collect()] == [("bad.jsonl", 3)]
    assert lake.ticks(spark, str(tmp_path / "raw")).count() == 4 + 2 + 1
    kept = lake.ticks(spark, str(tmp_path / "raw"), reject="file")
    assert kept.count() == 5 and kept.where("symbol = 'W' and price is null").count() == 1
    with pytest.raises(ValueError):
        lake.ticks(spark, str(tmp_path / "raw"), reject="folder")


def test_records_and_connections_of_missing_files(spark, tmp_path):
    assert lake.connection_events(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "c.jsonl").write_text('{"event": "disconnected", "exchange": "x", "ts": "2025-01-01", "gap_seconds": 2.5}\n')
    assert lake.connection_events(spark, str(tmp_path / "c.jsonl")).first().gap_seconds == 2.5


def test_file_digests_in_pieces(spark, tmp_path):
    import hashlib

    for n, size in enumerate((7, 1, 999, 3_000_000)):
        (tmp_path / f"f {n}.bin").write_bytes(bytes(i % 251 for i in range(size)))
    listed = lake.file_list(spark, str(tmp_path)).select("path")
    got = {r.path.rsplit("%20", 1)[-1].rsplit(" ", 1)[-1]: (r.length, r.digest) for r in digests.file_digests(listed.unionByName(listed), piece=1000).collect()}
    assert len(got) == 4
    (tmp_path / "none.bin").write_bytes(b"")
    empty = spark.createDataFrame([(str(tmp_path / "none.bin"),), (None,)], "path string")
    assert [(r.length, r.digest) for r in digests.file_digests(empty).collect()] == [(0, hashlib.md5(b"").hexdigest())]
    for n, size in enumerate((7, 1, 999, 3_000_000)):
        data = (tmp_path / f"f {n}.bin").read_bytes()
        assert got[f"{n}.bin"] == (size, hashlib.md5(data).hexdigest())
    known = spark.createDataFrame(digests.file_digests(listed).collect())
    (tmp_path / "f 1.bin").write_bytes(b"other")
    assert [r.path[-5:] for r in digests.changed(listed, known).collect()] == ["1.bin"]
    with pytest.raises(ValueError):
        digests.file_digests(listed, "md99")


def test_database_round_trip(spark, tmp_path):
    base = sink.Database(spark, f"jdbc:derby:{tmp_path}/base;create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    own = catalog.rounded(catalog.bars_of(spark, SF)).withColumn("ts", F.col("ts").cast("timestamp"))
    made = sink.projected(own, "bars")
    n = made.count()
    assert not base.exists("BARS")
    half = made.where(F.dayofmonth("ts") < 10)
    assert base.load(half, "BARS", ["symbol", "ts"], batch=500, parts=2) == half.count()
    assert base.load(made.unionByName(made.limit(5)), "BARS", ["symbol", "ts"]) == n - half.count()
    assert base.load(made, "BARS", ["symbol", "ts"]) == 0  # a rerun adds nothing
    back = base.read("BARS", by="trade_count", parts=4)
    assert back.rdd.getNumPartitions() > 1
    rows = lambda df: sorted((r.symbol, r.ts, r.close, r.bid) for r in df.collect())
    assert str(rows(back)) == str(rows(made))
    checked = {r.table: (r.source_rows, r.target_rows, r.same) for r in base.verify({"BARS": made, "MISSING": half}).collect()}
    assert checked == {"BARS": (n, n, True), "MISSING": (half.count(), 0, False)}
