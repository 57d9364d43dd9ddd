"""Profiles: counts, gaps, completeness, nulls, latency, connection gaps, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import gap_label, seconds_between
from tickloom.operators.ordered import with_neighbour
from tickloom.operators.quality import PRICES


def span(df: DataFrame, ts: str = "ts", by: tuple[str, ...] = (), distinct: str | None = None) -> DataFrame:
    """Rows, first and last time, days between, and distinct values of a column."""
    extra = [F.countDistinct(distinct).alias("distinct_values")] if distinct else []
    made = df.groupBy(*by) if by else df.groupBy()
    return made.agg(F.count("*").alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), (seconds_between(F.min(ts), F.max(ts)) / 86400).alias("days"), *extra)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and their difference; keys are hashed out in two partial steps."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("distinct_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def gap_rows(df: DataFrame, by: list[str], ts: str = "ts", longer_than: float = 1.0) -> DataFrame:
    """Rows whose next row comes later than that many seconds, with the gap."""
    near = with_neighbour(df, by, [ts], ts, after=True)
    return near.withColumn("gap_seconds", seconds_between(ts, f"next_{ts}")).where(F.col("gap_seconds") > longer_than).drop(f"next_{ts}")


def gap_profile(df: DataFrame, by: list[str], ts: str = "ts", large: float = 120.0) -> DataFrame:
    """Mean and largest gap and the number of large ones, with the continuity status."""
    gaps = with_neighbour(df.select(*by, ts), by, [ts], ts).withColumn("gap", seconds_between(f"prev_{ts}", ts))
    made = gaps.groupBy(*by).agg(F.avg("gap").alias("avg_gap"), F.max("gap").alias("max_gap"), F.count_if(F.col("gap") > large).alias("large_gaps"))
    steady = F.col("avg_gap").between(55, 120) & (F.col("large_gaps") < 10)
    return made.withColumn("status", F.when(F.coalesce(steady, F.lit(False)), "PASS").otherwise("WARN"))


def continuity(df: DataFrame, by: list[str], step: float, ts: str = "ts") -> DataFrame:
    """Rows, expected rows, gaps over one and a half steps, completeness in percent."""
    gaps = with_neighbour(df.select(*by, ts), by, [ts], ts).withColumn("gap", seconds_between(f"prev_{ts}", ts))
    made = gaps.groupBy(*by).agg(F.count("*").alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count_if(F.col("gap") > 1.5 * step).alias("gaps"))
    made = made.withColumn("expected", (F.floor(seconds_between("first_ts", "last_ts") / step) + 1).cast("bigint"))
    return made.withColumn("completeness", F.col("n_rows") / F.col("expected") * 100)


def gap_markers(df: DataFrame, by: list[str], step: float, ts: str = "ts") -> DataFrame:
    """Rows after a gap of over one and a half steps, labelled with its length."""
    gaps = with_neighbour(df, by, [ts], ts).withColumn("gap_seconds", seconds_between(f"prev_{ts}", ts)).where(F.col("gap_seconds") > 1.5 * step)
    return gaps.drop(f"prev_{ts}").withColumn("marker", F.concat(F.lit("GAP "), gap_label(F.col("gap_seconds"))))


def ohlc_sanity(bars: DataFrame) -> DataFrame:
    """Counts of bars with high below low, open or close outside, or a price not above zero."""
    outside = lambda c: (F.col(c) < F.col("low")) | (F.col(c) > F.col("high"))
    return bars.agg(
        F.count("*").alias("bars"), F.count_if(F.col("high") < F.col("low")).alias("high_below_low"), F.count_if(outside("open") | outside("close")).alias("outside"),
        F.count_if(F.least(*PRICES) <= 0).alias("not_positive"), F.avg(F.when(F.col("volume_base") > 0, 1.0).otherwise(0.0)).alias("share_with_volume"),
    )


def summary_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Least, largest and mean value of each column, one row for each."""
    wide = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi"), F.avg(c).alias("mean")).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c)["lo"].alias("min"), F.col(c)["hi"].alias("max"), F.col(c)["mean"].alias("mean")) for c in columns])
    return wide.select(F.inline(rows))


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls in each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def latency(df: DataFrame, by: list[str], value: str, order: str, last: int = 1000) -> DataFrame:
    """Nearest-rank median, 95th percentile and maximum of each key's last rows, with the warning flag."""
    newest = Window.partitionBy(*by).orderBy(F.desc(order))
    kept = df.withColumn("place", F.row_number().over(newest)).where(F.col("place") <= last)
    made = kept.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("v"))
    at = lambda share: F.element_at("v", (F.floor(F.size("v") * share) + 1).cast("int"))
    made = made.select(*by, F.size("v").cast("bigint").alias("n"), F.element_at("v", (F.floor(F.size("v") / 2) + 1).cast("int")).alias("p50"), at(0.95).alias("p95"), F.element_at("v", -1).alias("max"))
    return made.withColumn("warn", (F.col("p95") > 2000) | (F.col("max") > 5000))


def connection_gaps(events: DataFrame) -> DataFrame:
    """Per exchange: disconnects, reconnects, seconds lost, last event."""
    of = lambda name: F.count_if(F.col("event") == name)
    return events.groupBy("exchange").agg(of("disconnected").alias("disconnected"), of("reconnecting").alias("reconnecting"), F.coalesce(F.sum("gap_seconds"), F.lit(0.0)).alias("gap_seconds"), F.max_by("event", "ts").alias("last_event"), F.max("ts").alias("last_ts"))


def system_status(checks: DataFrame, status: str = "status") -> DataFrame:
    """FAIL if any check failed, PASS_WITH_WARNINGS if any warned, else PASS; SKIP passes."""
    bad, warn = F.count_if(F.col(status).isin("FAIL", "ERROR")), F.count_if(F.col(status) == "WARN")
    return checks.agg(F.when(bad > 0, "FAIL").when(warn > 0, "PASS_WITH_WARNINGS").otherwise("PASS").alias("status"))


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of a row's columns as text, each after its length; a null is a dash, which no length begins with."""
    text = [F.col(c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def content_hash(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """One hash of all rows (of each group ``by``) whatever their order, and their number.

    Four 60-bit parts of the row hashes are summed, which partial aggregation combines,
    so no row list is gathered.
    """
    part = lambda k: F.conv(F.substring("__h", 15 * k + 1, 15), 16, 10).cast("decimal(19,0)")
    sums = [F.coalesce(F.sum(part(k)), F.lit(0)).cast("decimal(38,0)").cast("string") for k in range(4)]
    return df.withColumn("__h", row_hash(columns)).groupBy(*by).agg(F.count("*").alias("n_rows"), F.sha2(F.concat_ws(",", *sums), 256).alias("content_sha256"))
