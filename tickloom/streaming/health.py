"""Heartbeat of a stream: metrics observed in its plan, collected by a listener, told as JSON and Markdown."""

from __future__ import annotations

import json
import threading
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from tickloom.plans.reports import table, write_text

#: The name of the observed metrics.
NAME = "tickloom_health"


def metrics() -> list:
    """What is measured of ticks: counts, last time, latency of receipt in milliseconds; aggregates without a shuffle of their own."""
    latency = F.when(F.col("ts_recv").isNotNull() & F.col("ts_event").isNotNull(), F.col("ts_recv") - F.col("ts_event"))
    return [
        F.count("*").alias("ticks"),
        F.count_if(F.col("stream") == "trade").alias("trades"),
        F.max("ts_event").alias("last_ms"),
        F.count(latency).alias("timed"),
        F.percentile_approx(latency, 0.5).alias("latency_p50_ms"),
        F.percentile_approx(latency, 0.95).alias("latency_p95_ms"),
        F.max(latency).alias("latency_max_ms"),
    ]


def observed(ticks: DataFrame) -> DataFrame:
    """The same ticks; each batch of a stream reports their metrics on the way."""
    return ticks.observe(NAME, *metrics())


def profile(ticks: DataFrame) -> dict:
    """The metrics of a finite frame."""
    return ticks.agg(*metrics()).first().asDict()


class Heartbeat(StreamingQueryListener):
    """Adds up what the batches of the observed queries report; ``payload`` tells the state at any time.

    Counts and maxima are of all batches, percentiles of the newest batch with ticks, as the
    state of a service is.
    """

    def __init__(self, mode: str = "PRODUCTION") -> None:
        self.lock = threading.Lock()
        self.mode, self.status, self.error = mode, "stopped", None
        self.batches = self.ticks = self.trades = 0
        self.last_ms = self.latency = None
        self.rate = 0.0

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.status = "running"

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(NAME)
        if row is None:
            return
        with self.lock:
            self.batches += 1
            self.ticks += row["ticks"]
            self.trades += row["trades"]
            if row["last_ms"] is not None:
                self.last_ms = max(self.last_ms or row["last_ms"], row["last_ms"])
            if row["timed"]:
                worst = row["latency_max_ms"] if self.latency is None else max(self.latency["max"], row["latency_max_ms"])
                self.latency = {"p50": row["latency_p50_ms"], "p95": row["latency_p95_ms"], "max": worst}
            self.rate = float(event.progress.processedRowsPerSecond or 0.0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.error = event.exception
            self.status = "error" if event.exception else "stopped"

    def payload(self, connections: DataFrame | None = None, now: datetime | None = None) -> dict:
        """The heartbeat: collector, connection gaps (see ``profiles.connection_gaps``, a row an exchange), time and mode."""
        with self.lock:
            latency = self.latency or {"p50": None, "p95": None, "max": None}
            last = None if self.last_ms is None else datetime.fromtimestamp(self.last_ms / 1000, UTC).isoformat()
            collector = {
                "status": self.status, "last_seen_ts": last, "ticks": self.ticks, "trades": self.trades, "batches": self.batches, "rows_per_second": round(self.rate, 1),
                "latency_p50_ms": latency["p50"], "latency_p95_ms": latency["p95"], "latency_max_ms": latency["max"], "last_error": self.error,
            }
        gaps = {} if connections is None else {r["exchange"]: {k: (v.isoformat() if isinstance(v, datetime) else v) for k, v in r.asDict().items() if k != "exchange"} for r in connections.collect()}
        return {"ts_utc": (now or datetime.now(UTC)).isoformat(), "mode": self.mode, "collector": collector, "connection_events": gaps}


def overall(collector: str, macro: str = "idle") -> str:
    """The service's state from its parts' states."""
    if "error" in (collector, macro):
        return "ERROR"
    if collector == "running" and macro in ("idle", "running"):
        return "HEALTHY"
    return "STOPPED" if collector == "stopped" else "UNKNOWN"


def markdown(payload: dict) -> str:
    """The heartbeat as a page."""
    c = payload["collector"]
    rows = [[k.replace("_", " "), v] for k, v in c.items()]
    gaps = [[name, *facts.values()] for name, facts in payload["connection_events"].items()]
    names = next(iter(payload["connection_events"].values()), {})
    parts = [f"# Health\n\nMode: {payload['mode']}. Time: {payload['ts_utc']}. State: {overall(c['status'])}\n\n## Collector\n", table(["metric", "value"], rows), "\n## Connections\n", table(["exchange", *names], gaps) if gaps else "No events."]
    return "\n".join(parts) + "\n"


def write_heartbeat(spark: SparkSession, payload: dict, json_path: str, page_path: str) -> None:
    """Both forms, each replaced."""
    write_text(spark, json_path, json.dumps(payload, indent=2))
    write_text(spark, page_path, markdown(payload))
