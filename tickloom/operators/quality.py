"""Bar rules R1 to R7 and NEG_VOL, their records and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import row_sample, seconds_between
from tickloom.operators.ordered import series_keys, with_neighbour

PRICES = ("open", "high", "low", "close")
#: Severity of each rule.
SEVERITY = {"R1": "critical", "R2": "critical", "R3": "major", "R4": "critical", "R5": "critical", "R6": "major", "R7": "minor", "NEG_VOL": "major"}
#: What each rule reports.
DETAIL = {
    "R1": "OHLC ordering violation",
    "R2": "Non-positive price",
    "R3": "Ask below bid",
    "R4": "Null in OHLC",
    "R5": "Timestamp discontinuity",
    "R6": "Abnormal spread",
    "R7": "Kline parity mismatch",
    "NEG_VOL": "Negative volume",
}
#: Basis points of the mid price from which a spread is excessive; price tolerance of R7.
EXCESSIVE_BPS, PARITY_TOLERANCE = 500.0, 1e-4


def _fails(holds: Column) -> Column:
    """A condition that must hold; unknown counts as a violation."""
    return ~F.coalesce(holds, F.lit(False))


def _hits(condition: Column) -> Column:
    """A condition that must not hold; unknown is no violation."""
    return F.coalesce(condition, F.lit(False))


def spread_kind(limit: float = EXCESSIVE_BPS) -> Column:
    """``negative``, ``excessive`` (also any positive spread at a mid of zero) or null."""
    mid = (F.col("bid") + F.col("ask")) / 2
    known = F.col("spread").isNotNull() & F.col("bid").isNotNull() & F.col("ask").isNotNull()
    share = F.col("spread") / F.nullif(mid, F.lit(0.0)) * 10_000
    return F.when(known & (F.col("spread") < 0), "negative").when(known & F.when(mid == 0, F.col("spread") > 0).otherwise(share >= limit), "excessive")


def rule(name: str) -> Column:
    """Whether a bar breaks a rule; R5 at one second needs ``gap_seconds``, see ``with_gaps``."""
    if name == "R1":
        low, high, open_, close = (F.col(c) for c in ("low", "high", "open", "close"))
        return _fails((low <= open_) & (low <= close) & (open_ <= high) & (close <= high))
    if name == "R2":
        return _fails(reduce(lambda a, b: a & b, [F.col(c) > 0 for c in PRICES]))
    if name == "R3":
        return _hits(F.col("ask") < F.col("bid"))
    if name == "R4":
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in PRICES])
    if name == "R5":
        return _hits(F.col("gap_seconds") > F.col("step_seconds"))
    if name == "R5_minute":
        return F.second("ts") != 0
    if name == "R6":
        return spread_kind().isNotNull()
    if name == "NEG_VOL":
        return _hits((F.col("volume_base") < 0) | (F.col("volume_quote") < 0))
    raise ValueError(f"unknown rule {name!r}")


def with_gaps(bars: DataFrame, step_seconds: float = 1, keys: tuple[str, ...] | None = None) -> DataFrame:
    """Seconds since the bar before of the same key, by default the exchange's symbol; duplicates give 0."""
    near = with_neighbour(bars, keys or series_keys(bars), ["ts"])
    return near.withColumn("gap_seconds", seconds_between("prev_ts", "ts")).withColumn("step_seconds", F.lit(float(step_seconds))).drop("prev_ts")


def flagged(bars: DataFrame, timeframe_seconds: int = 1) -> DataFrame:
    """Every bar with the array ``rules`` of those it breaks; one window inside each day."""
    gaps = with_gaps(bars, timeframe_seconds)
    names = {n: rule("R5_minute" if n == "R5" and timeframe_seconds == 60 else n) for n in ("R1", "R2", "R3", "R4", "R5", "R6", "NEG_VOL")}
    held = F.array(*[F.when(c, n) for n, c in names.items()])
    return gaps.withColumn("rules", F.filter(held, lambda x: x.isNotNull()))


def severity(name: Column) -> Column:
    """Severity of a rule; ``major`` where it is not listed."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair]), name), F.lit("major"))


def violations(bars: DataFrame, timeframe_seconds: int = 1, max_rows: int | None = 25) -> DataFrame:
    """Violation records; of each rule at most ``max_rows``, the earliest by (symbol, ts).

    Bars that have ``rules`` already, see ``flagged``, are not judged again.
    """
    broken = (bars if "rules" in bars.columns else flagged(bars, timeframe_seconds)).withColumn("rule", F.explode("rules"))
    series = series_keys(bars)
    if max_rows is not None:
        order = Window.partitionBy("rule").orderBy("symbol", "ts", *series)
        broken = broken.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max_rows)
    detail = F.element_at(F.create_map(*[F.lit(x) for pair in DETAIL.items() for x in pair]), F.col("rule"))
    own = [c for c in bars.columns if c not in ("rules", "gap_seconds", "step_seconds")]
    return broken.select(*series, "ts", "rule", severity(F.col("rule")).alias("severity"), detail.alias("detail"), row_sample(own).alias("row_sample"))


def critical(records: DataFrame) -> DataFrame:
    """The violations of critical rules."""
    return records.where(F.col("severity") == "critical")


def rule_summary(bars: DataFrame, timeframe_seconds: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts for the whole rule pack from one scan: one row, or one for each ``by``."""
    held = bars if "rules" in bars.columns else flagged(bars, timeframe_seconds)
    counts = [F.count_if(F.array_contains("rules", n)).alias(n.lower()) for n in ("R1", "R2", "R3", "R4", "R5", "R6", "NEG_VOL")]
    kind = spread_kind()
    held = held.withColumn("r6_known", F.col("spread") + F.col("bid") + F.col("ask"))  # null where one is
    all_ = [F.count("*").alias("bars"), *counts, F.count_if(kind == "negative").alias("r6_negative"), F.count_if(kind == "excessive").alias("r6_excessive"), F.count("r6_known").alias("r6_checked")]
    return held.groupBy(*by).agg(*all_) if by else held.agg(*all_)


def report_verdict(summary: DataFrame, most_percent: float = 0.1) -> DataFrame:
    """PASS, INVESTIGATE (under ``most_percent`` of the spreads with quotes are excessive) or FAIL; R5 and R7 do not count."""
    hard = (F.col("r1") + F.col("r2") + F.col("r3") + F.col("r4")) == 0
    share = 100.0 * F.col("r6_excessive") / F.nullif("r6_checked", F.lit(0))
    return summary.withColumn("verdict", F.when(hard & (F.col("r6") == 0), "PASS").when(hard & (F.coalesce(share, F.lit(0.0)) < most_percent), "INVESTIGATE").otherwise("FAIL"))


def violation_counts(records: DataFrame) -> DataFrame:
    """Violations by rule and severity, severe and frequent ones first."""
    rank = F.when(F.col("severity") == "critical", 0).when(F.col("severity") == "major", 1).otherwise(2)
    return records.groupBy("rule", "severity").agg(F.count("*").alias("violations")).orderBy(rank, F.desc("violations"), "rule")
