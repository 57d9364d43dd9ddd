"""Own bars against official ones: joins, differences, tolerance flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.quality import PARITY_TOLERANCE, PRICES


def compare(own: DataFrame, official: DataFrame) -> DataFrame:
    """Both sides and signed differences on equal (symbol, ts); the exchange is not a key."""
    both = own.alias("b").join(official.alias("k"), ["symbol", "ts"])
    prices = [c for p in PRICES for c in (F.col(f"b.{p}").alias(f"our_{p}"), F.col(f"k.{p}").alias(f"kline_{p}"), (F.col(f"b.{p}") - F.col(f"k.{p}")).alias(f"{p}_diff"))]
    volume, base = F.col("b.volume_base"), F.col("k.volume_base")
    return both.select(
        F.col("b.exchange").alias("exchange"), "symbol", "ts", *prices,
        volume.alias("our_volume"), base.alias("kline_volume"), (volume - base).alias("volume_diff_abs"),
        F.when(base > 0, F.abs(volume - base) / F.nullif(base, F.lit(0.0)) * 10_000).alias("volume_diff_bps"),
    )


def export_compare(compared: DataFrame) -> DataFrame:
    """The relational shape of the comparison, with the largest absolute price difference."""
    diffs = [F.col(f"{p}_diff").alias(f"diff_{p}") for p in PRICES]
    return compared.select("symbol", "ts", *diffs, F.greatest(*[F.abs(f"{p}_diff") for p in PRICES]).alias("abs_error"))


def r7(compared: DataFrame, tolerance: float = PARITY_TOLERANCE) -> DataFrame:
    """Bars where any price differs by more than the tolerance."""
    return compared.where(reduce(lambda a, b: a | b, [F.abs(f"{p}_diff") > tolerance for p in PRICES]))


def r7_summary(compared: DataFrame, tolerance: float = PARITY_TOLERANCE) -> DataFrame:
    """Bars compared, mismatches, mean and largest volume difference."""
    off = reduce(lambda a, b: a | b, [F.abs(f"{p}_diff") > tolerance for p in PRICES])
    return compared.agg(F.count("*").alias("bars"), F.count_if(off).alias("mismatches"), F.avg("volume_diff_bps").alias("avg_volume_bps"), F.max("volume_diff_bps").alias("max_volume_bps"))


def flag(own: DataFrame, reference: DataFrame, ticks: float = 0.001, volume_bps: float = 50.0) -> DataFrame:
    """Aligned rows with ``ohlc_mismatch``, ``volume_mismatch`` and ``mismatch``; reference volume 0 is 0 bps."""
    side = lambda df, s: df.select("symbol", "ts", *[F.col(c).alias(f"{c}_{s}") for c in (*PRICES, "volume_base")])
    both = side(own, "our").join(side(reference, "ref"), ["symbol", "ts"])
    worst = F.greatest(*[F.abs(F.col(f"{p}_our") - F.col(f"{p}_ref")) for p in PRICES])
    bps = F.coalesce(F.abs(F.col("volume_base_our") - F.col("volume_base_ref")) / F.nullif("volume_base_ref", F.lit(0.0)) * 10_000, F.lit(0.0))
    both = both.withColumn("max_diff", worst).withColumn("volume_bps", bps).withColumn("ohlc_mismatch", F.col("max_diff") > ticks).withColumn("volume_mismatch", F.col("volume_bps") > volume_bps)
    return both.withColumn("mismatch", F.col("ohlc_mismatch") | F.col("volume_mismatch"))


def parity_summary(flags: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Aligned minutes, mismatches and their shares by symbol."""
    share = lambda c: (100.0 * F.count_if(F.col(c)) / F.count("*"))
    return flags.groupBy(*keys).agg(
        F.count("*").alias("aligned"), F.count_if("mismatch").alias("mismatch_rows"), share("ohlc_mismatch").alias("ohlc_pct"),
        share("volume_mismatch").alias("volume_pct"), F.max("max_diff").alias("max_diff"), F.max("volume_bps").alias("max_volume_bps"),
    )
