"""The quality chain: rules, detectors, labels, bursts, fused verdict, daily report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import detect, fusion, quality
from tickloom.operators.keys import union_all
from tickloom.operators.ordered import series_keys
from tickloom.plans.reports import grouped, section
from tickloom.session import materialise


@dataclass(frozen=True)
class QaConfig:
    """Detector and report settings; unknown names and values out of range are errors."""

    zscore_window: int | str = 3600
    zscore_k: float = 5.0
    jump_k_sigma: float = 6.0
    jump_stable_bps: float = 50.0
    jump_min_trades: int = 0
    forest_contamination: float = 0.005
    forest_trees: int = 200
    cooldown_seconds: int = 5
    max_rows: int | None = 25
    labeler: str = "rules"
    detectors: tuple[str, ...] = field(default=("zscore", "jump"))

    def __post_init__(self) -> None:
        if self.zscore_k <= 0 or self.jump_k_sigma <= 0:
            raise ValueError("thresholds must be positive")
        if not 0 < self.forest_contamination < 0.5:
            raise ValueError("contamination must lie between 0 and 0.5")
        if self.labeler not in ("rules", "none"):
            raise ValueError(f"unknown labeler {self.labeler!r}")
        if unknown := set(self.detectors) - set(DETECTORS):
            raise ValueError(f"unknown detectors {sorted(unknown)}")

    @classmethod
    def of(cls, settings: dict) -> QaConfig:
        known = {f.name for f in fields(cls)}
        if unknown := set(settings) - known:
            raise ValueError(f"unknown settings {sorted(unknown)}")
        return cls(**settings)


#: Detectors by name, to be extended: (clean bars, all bars with ``is_clean``, config) to rows of a series' keys, ts, detector, z and what else it tells.
DETECTORS: dict[str, Callable[[DataFrame, DataFrame, QaConfig], DataFrame]] = {
    "zscore": lambda clean, masked, config: detect.zscores(clean, config.zscore_window, config.zscore_k),
    "jump": lambda clean, masked, config: detect.jumps(clean, config.jump_k_sigma, config.jump_stable_bps, config.jump_min_trades),
    "iforest": lambda clean, masked, config: detect.isolation_forest(masked, config.forest_contamination, config.forest_trees).withColumnRenamed("score", "z"),
}


def anomalies(judged: DataFrame, config: QaConfig) -> DataFrame:
    """Labelled anomalies of all configured detectors, with ``features`` and ``rationale``.

    ``judged`` are bars with the array ``rules`` of those they break.  Rows that break a rule
    are no anomalies: z-scores and jumps are those of the clean rows, and the forest learns
    from them.
    """
    is_clean = F.size("rules") == 0
    clean, masked = judged.where(is_clean), judged.withColumn("is_clean", is_clean)
    series = series_keys(judged)
    none = judged.limit(0).select(*series, "ts", F.lit("").alias("detector"), F.lit(0.0).alias("z"))
    rows = union_all([none, *(DETECTORS[name](clean, masked, config) for name in config.detectors)])
    for c in ("value", "ret", "spread_bp", "mean"):  # what only some detectors tell
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("double"))
    told = detect.evidence(rows, config.zscore_k, config.jump_k_sigma).select(*series, "ts", "detector", "z", "spread_bp", "features", "rationale")
    return detect.label(told) if config.labeler == "rules" else detect.label_without_model(told)


def bursts(labelled: DataFrame, config: QaConfig) -> DataFrame:
    """Jumps merged into bursts, other anomalies by themselves."""
    jump = F.col("detector") == "JUMP"
    return detect.clusters(labelled.where(jump), config.cooldown_seconds).unionByName(detect.clusters(labelled.where(~jump), 0))


def chain(bars: DataFrame, timeframe_seconds: int, config: QaConfig | None = None) -> dict[str, DataFrame]:
    """All stages: judged, violations, violation_counts, anomalies, bursts, records, fused.

    Bars are made and judged once and written to the shared folder; all stages read those.
    ``max_rows`` bounds only the listed violations; masks, counts and verdicts use all.
    """
    config = config or QaConfig()
    judged = materialise(quality.flagged(bars, timeframe_seconds))
    broken = quality.violations(judged, timeframe_seconds, None)
    found = anomalies(judged, config)
    grouped = bursts(found, config)
    fused = fusion.fuse(judged.select("symbol").distinct(), broken, found)
    listed = quality.violations(judged, timeframe_seconds, config.max_rows)
    return {"judged": judged, "violations": listed, "violation_counts": quality.violation_counts(broken), "anomalies": found, "bursts": grouped, "records": detect.records(grouped), "fused": fused}


def report(stages: dict[str, DataFrame], day: str, top: int = 10) -> str:
    """The day's Markdown report; every table in it is small by construction."""
    fused = stages["fused"]
    parts = [
        f"# Data quality, {day}\n",
        section("Summary", fusion.fusion_summary(fused)),
        section("Verdicts", fused.select("symbol", "verdict", "score", "critical", "major", "minor", "anomalies").orderBy("score", "symbol")),
        section("Violations", stages["violation_counts"]),
        grouped("Violations by rule", detect.examples(stages["violations"], top, "rule"), "rule", ["symbol", "ts", "detail"]),
        section("Anomalies by detector", detect.counts(stages["anomalies"]).orderBy(F.desc("anomalies"), "detector")),
        grouped("Examples by detector", detect.examples(stages["anomalies"], top), "detector", ["symbol", "ts", "rationale"]),
        section("Busiest symbols", detect.weighted_counts(stages["bursts"]).limit(top)),
    ]
    return "\n".join(parts) + "\n"
