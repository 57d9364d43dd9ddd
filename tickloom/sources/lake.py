"""Reading the lake: bars, ticks, quality records, with predicates that prune partitions."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators.ordered import as_of


def partition_range(start: datetime, end: datetime) -> Column:
    """A predicate on year, month and day for [start, end), so a scan opens only those days."""
    key = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    number = lambda t: t.year * 10_000 + t.month * 100 + t.day
    years = F.col("year").between(start.year, end.year)
    return years & (key >= number(start)) & (key <= number(end))


def read_or_empty(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """The files under a path with a fixed schema; none at all give an empty frame."""
    try:
        return spark.read.schema(schema).format(kind).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def bars(spark: SparkSession, root: str, exchange: str | None = None, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Stored bars under ``root`` (exchange=/symbol=/year=/month=/day=), null times dropped."""
    df = spark.read.parquet(root)
    if exchange is not None:
        df = df.where(F.col("exchange") == exchange)
    if start is not None and end is not None:
        df = df.where(partition_range(start, end)).where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))
    return df.where(F.col("ts").isNotNull())


def day_or_daily(spark: SparkSession, compacted_root: str, root: str, day: datetime) -> DataFrame:
    """The compacted bars of a day where they exist, else those in partitions."""
    try:
        return spark.read.parquet(f"{compacted_root}/date={day:%Y-%m-%d}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(root).where(partition_range(day, day)).drop("year", "month", "day")


def recent(df: DataFrame, days: int, now: datetime | Column | None = None, ts: str = "ts") -> DataFrame:
    """Rows of the last ``days`` days."""
    end = F.current_timestamp() if now is None else F.lit(now)
    return df.where(F.col(ts) >= end - F.make_dt_interval(F.lit(days)))


#: JSON as the standard has it.
STRICT = {"allowSingleQuotes": "false", "allowUnquotedFieldNames": "false"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of raw files that are not blank: file, value, and whether they are a JSON object."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").where(F.trim("value") != "")
    return lines.withColumn("is_object", F.from_json("value", "map<string,string>", STRICT).isNotNull())


def bad_files(spark: SparkSession, path: str) -> DataFrame:
    """Raw files with a line that is no JSON object, and how many: file, bad_lines."""
    return _lines(spark, path).where(~F.col("is_object")).groupBy("file").agg(F.count("*").alias("bad_lines"))


def ticks(spark: SparkSession, path: str, reject: str = "line") -> DataFrame:
    """Raw JSON lines with the tick schema; a value of the wrong type is null.

    ``reject``: "line" drops malformed lines, "file" every file that has one (see
    ``bad_files``); the list of such files is joined, never collected.
    """
    if reject not in ("line", "file"):
        raise ValueError(f"unknown rejection {reject!r}")
    lines = _lines(spark, path)
    kept = lines.where("is_object") if reject == "line" else lines.join(bad_files(spark, path), "file", "left_anti")
    return kept.select(F.inline(F.array(F.from_json("value", schemas.TICK, STRICT))))


def derivatives(spark: SparkSession, root: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Funding rates and open interest under ``root`` (year=/month=/day=), null times dropped: exchange, symbol, ts, funding_rate, open_interest, oi_usd."""
    df = spark.read.parquet(root)
    if start is not None and end is not None:
        if {"year", "month", "day"} <= set(df.columns):
            df = df.where(partition_range(start, end))
        df = df.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))
    return df.where(F.col("ts").isNotNull()).select(F.lit("binance_futures").alias("exchange"), "symbol", "ts", "funding_rate", "open_interest", "oi_usd")


def with_derivatives(bars: DataFrame, derived: DataFrame) -> DataFrame:
    """Bars with the last funding rate and open interest of their symbol at or before their time.

    Of derivative rows with equal symbol and time the one with the largest values stays.
    """
    values = ["funding_rate", "open_interest", "oi_usd"]
    one = derived.groupBy("symbol", "ts").agg(*[F.max(v).alias(v) for v in values])
    return as_of(bars, one, ["symbol"], values)


def quality_records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Violations or anomalies; a missing file is no records."""
    return read_or_empty(spark, path, {"violations": schemas.VIOLATION, "anomalies": schemas.ANOMALY}[kind], "json")


def connection_events(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.CONNECTION, "json")


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and time of the files under a path, without reading their content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
