"""Fused quality score and verdict of each symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Weights of the component scores, and the score below which a verdict falls.
WEIGHTS = {"schema": 0.7, "detector": 0.2, "ai": 0.1}
FAIL_BELOW, REVIEW_BELOW = 0.65, 0.85


def fuse(symbols: DataFrame, violations: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Component scores, score and verdict of every listed symbol, also of those without records."""
    of = lambda level: F.count_if(F.col("severity") == level).alias(level)
    broken = violations.groupBy("symbol").agg(of("critical"), of("major"), of("minor"))
    found = anomalies.groupBy("symbol").agg(F.count("*").alias("anomalies"), F.avg(F.coalesce("confidence", F.lit(0.5))).alias("confidence"))
    rows = symbols.join(broken, "symbol", "left").join(found, "symbol", "left").fillna(0, ["critical", "major", "minor", "anomalies"])
    rows = rows.withColumns(
        {
            "schema_score": F.greatest(F.lit(0.0), 1 - 0.5 * F.col("critical") - 0.2 * F.col("major") - 0.05 * F.col("minor")),
            "detector_score": 1 / (1 + F.col("anomalies") / 10),
            "ai_score": F.when(F.col("anomalies") == 0, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - F.col("confidence")))),
        }
    )
    score = WEIGHTS["schema"] * F.col("schema_score") + WEIGHTS["detector"] * F.col("detector_score") + WEIGHTS["ai"] * F.col("ai_score")
    verdict = F.when((F.col("critical") > 0) | (F.col("raw") < FAIL_BELOW), "FAIL").when((F.col("major") > 0) | (F.col("raw") < REVIEW_BELOW), "REVIEW").otherwise("PASS")
    rows = rows.withColumn("raw", score).withColumn("verdict", verdict).withColumn("score", F.round("raw", 4))
    meta = F.to_json(F.struct("critical", "major", "minor", "anomalies"))
    return rows.select("symbol", "verdict", "score", "schema_score", "detector_score", "ai_score", "critical", "major", "minor", "anomalies", meta.alias("metadata"))


def fusion_summary(fused: DataFrame) -> DataFrame:
    """Symbols by verdict, mean, least and largest score."""
    of = lambda v: F.count_if(F.col("verdict") == v).alias(v.lower())
    return fused.agg(F.count("*").alias("symbols"), of("PASS"), of("REVIEW"), of("FAIL"), F.avg("score").alias("avg_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"))
