"""Deduplication, incremental joins and unions by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.ordered import series_keys


def dedup(df: DataFrame, keys: list[str], order: list[Column | str], keep: str = "last") -> DataFrame:
    """One row for each key: the first or last in ``order``, which should leave no ties."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    by = Window.partitionBy(*keys).orderBy(*([c.desc() for c in columns] if keep == "last" else columns))
    return df.withColumn("__place", F.row_number().over(by)).where("__place = 1").drop("__place")


def only_new(fresh: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet; only keys of the stored side are read."""
    return fresh.join(existing.select(*keys).distinct(), keys, "left_anti")


def clean_rows(df: DataFrame, violations: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
    """All rows with ``is_clean``: whether no violation has their key, by default the series and time of the violations."""
    keys = keys or (*series_keys(violations), "ts")
    bad = violations.select(*keys).distinct().withColumn("__bad", F.lit(True))
    return df.join(bad, list(keys), "left").withColumn("is_clean", F.col("__bad").isNull()).drop("__bad")


def upsert(existing: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides by name, the fresh row winning on equal keys."""
    both = existing.withColumn("__seq", F.lit(0)).unionByName(fresh.withColumn("__seq", F.lit(1)), allowMissingColumns=True)
    return dedup(both, keys, ["__seq"]).drop("__seq")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def count_difference(left: dict[str, DataFrame], right: dict[str, DataFrame]) -> DataFrame:
    """Row counts of equally named tables on two sides: table, source_rows, target_rows, same."""
    def counts(side: dict[str, DataFrame], name: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias(name)).select(F.lit(k).alias("table"), name) for k, df in sorted(side.items())])

    both = counts(left, "source_rows").join(counts(right, "target_rows"), "table", "full_outer")
    return both.withColumn("same", F.col("source_rows").eqNullSafe(F.col("target_rows")))
