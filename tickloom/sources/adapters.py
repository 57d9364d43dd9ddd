"""The driver's event and order-line tables as ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ticks(events: DataFrame) -> DataFrame:
    """Events as ticks: the type is the symbol, even users trade, odd users quote."""
    k = F.get_json_object("props", "$.k").try_cast("double")
    trade = F.col("user_id") % 2 == 0
    return events.select(
        F.lit("driver").alias("exchange"),
        F.col("event_type").alias("symbol"),
        "ts",
        F.col("event_id").alias("trade_id"),
        F.when(trade, "trade").otherwise("bookTicker").alias("stream"),
        F.when(trade, F.col("value")).alias("price"),
        F.when(trade, k).alias("qty"),
        F.when(~trade, F.col("value")).alias("bid"),
        F.when(~trade, F.col("value") + k / 100).alias("ask"),
        "user_id",
    )


def line_trades(lineitem: DataFrame) -> DataFrame:
    """Order lines as trades at day grain, one symbol for each flag and status.

    Order and line do not name one row here, so part and supplier order the rest; the four keys
    do not fit one number, and such bars are sorted.
    """
    none = F.lit(None).cast("double")
    return lineitem.select(
        F.lit("driver").alias("exchange"),
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        F.col("l_shipdate").alias("ts"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("trade_id"),
        F.lit("trade").alias("stream"),
        (F.col("l_extendedprice") / F.nullif("l_quantity", F.lit(0.0))).alias("price"),
        F.col("l_quantity").alias("qty"),
        none.alias("bid"),
        none.alias("ask"),
    )
