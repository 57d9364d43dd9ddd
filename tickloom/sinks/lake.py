"""Idempotent lake writes: partitions, upserts, compaction, exports, retention plans."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.keys import dedup, union_all, upsert
from tickloom.operators.profiles import content_hash, gap_rows
from tickloom.schemas import EXPORTS

PARTITIONS = ["exchange", "symbol", "year", "month", "day"]


def with_day_columns(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def write_bars(bars: DataFrame, root: str, partitions: list[str] = PARTITIONS, sort: list[str] | None = None) -> None:
    """Replace the partitions that occur in ``bars``; other days stay, a rerun changes nothing.

    Rows are dealt by partition and some of their time, so a heavy day is several files,
    each in order, for narrow statistics.
    """
    made = with_day_columns(bars)
    keys = [c for c in partitions if c in made.columns]
    dealt = made.repartition(*keys, F.hour("ts")).sortWithinPartitions(*keys, *(sort or ["ts"]))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(root)


def upsert_days(spark: SparkSession, fresh: DataFrame, root: str, staging: str, keys: list[str], partitions: list[str]) -> None:
    """Merge rows into the partitions they touch, the fresh row winning on equal keys.

    Only those partitions are read.  The merged rows are written to ``staging`` first,
    because a partition cannot be replaced while it is read.
    """
    made = with_day_columns(fresh)
    touched = made.select(*partitions).distinct()
    merged = made
    if spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root).select("path").take(1):
        merged = upsert(spark.read.parquet(root).join(F.broadcast(touched), partitions, "left_semi"), made, keys)
    merged.write.mode("overwrite").parquet(staging)
    spark.read.parquet(staging).repartition(*partitions).sortWithinPartitions(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(root)


def compact(bars: DataFrame, root: str, columns: list[str], keys: tuple[str, ...] = ("exchange", "symbol", "ts")) -> DataFrame:
    """One sorted file for each day and symbol under its own root, and a summary of each.

    The first of equal keys stays.  The summary, read from what was written, has date,
    n_rows, gaps over a second inside each symbol's series (a day's first row looks back to
    the day before), and content_sha256, which does not depend on the writer.
    """
    first = dedup(bars, list(keys), ["trade_count"], keep="first").withColumn("date", F.to_date("ts"))
    first.select("date", *columns).repartition("date", "exchange", "symbol").sortWithinPartitions("date", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(root)
    written = bars.sparkSession.read.parquet(root).join(bars.select(F.to_date("ts").alias("date")).distinct(), "date", "left_semi")
    late = gap_rows(written.select("exchange", "symbol", "ts", "date"), ["exchange", "symbol"], longer_than=1.0)
    gaps = late.groupBy(F.to_date(F.col("ts") + F.make_dt_interval(secs=F.col("gap_seconds"))).alias("date")).agg(F.count("*").alias("gaps"))
    return content_hash(written, columns, ("date",)).join(gaps, "date", "left").fillna(0, ["gaps"])


def export(df: DataFrame, path: str, kind: str = "parquet", table: str | None = None) -> None:
    """A slice as Parquet (snappy) or CSV with a header, in the columns of a relational table if one is named."""
    made = projected(df, table) if table else df
    if kind == "csv":
        made.write.mode("overwrite").option("header", "true").csv(path)
    elif kind == "parquet":
        made.write.mode("overwrite").option("compression", "snappy").parquet(path)
    else:
        raise ValueError(f"unknown format {kind!r}")


def projected(df: DataFrame, table: str) -> DataFrame:
    """The columns of a relational table in its order; one that the frame lacks is an error."""
    if table not in EXPORTS:
        raise ValueError(f"unknown table {table!r}")
    if missing := [c for c in EXPORTS[table] if c not in df.columns]:
        raise ValueError(f"{table} needs {missing}")
    return df.select(*EXPORTS[table])


class Database:
    """Tables of a relational database, read and written in partitions through JDBC."""

    def __init__(self, spark: SparkSession, url: str, **options: str) -> None:
        self.spark, self.options = spark, {"url": url, **options}

    def _reader(self, query: str):
        return self.spark.read.format("jdbc").options(**self.options).option("dbtable", f"({query}) q")

    def _quoted(self, name: str) -> str:
        """A name as the database writes it, in the case that it has."""
        return self.spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.options["url"]).quoteIdentifier(name)

    def exists(self, table: str) -> bool:
        try:
            self._reader(f"SELECT * FROM {table} WHERE 1 = 0").load()
            return True
        except Exception as error:  # drivers have no error in common
            if re.search(r"does not exist|not found|no such table|doesn't exist|unknown table", str(error), re.IGNORECASE):
                return False
            raise

    def rows(self, table: str) -> int:
        """The database counts, not Spark."""
        return int(self._reader(f"SELECT COUNT(*) AS N FROM {table}").load().first()[0])

    def read(self, table: str, by: str | None = None, parts: int = 8) -> DataFrame:
        """A table; with ``by``, a numeric or time column, in as many ranges of it that are read side by side."""
        reader = self.spark.read.format("jdbc").options(**self.options).option("dbtable", table)
        if by is not None:
            low, high = self._reader(f"SELECT MIN({self._quoted(by)}) AS LO, MAX({self._quoted(by)}) AS HI FROM {table}").load().first()
            if low is not None:
                reader = reader.options(partitionColumn=by, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
        return reader.load()

    def load(self, df: DataFrame, table: str, keys: list[str], batch: int = 10_000, parts: int = 8) -> int:
        """Add the rows whose key the table lacks, in batches over ``parts`` connections; a rerun adds none.

        Of rows with equal keys one is added.  Returns the number of rows added.
        """
        fresh = df.dropDuplicates(keys)
        before = 0
        if self.exists(table):
            before = self.rows(table)
            fresh = fresh.join(self.read(table).select(*keys), keys, "left_anti")  # only the keys are read
        fresh.coalesce(parts).write.format("jdbc").options(**self.options, dbtable=table, batchsize=batch).mode("append").save()
        return self.rows(table) - before

    def verify(self, sources: dict[str, DataFrame]) -> DataFrame:
        """Row counts of the source frames against the tables of the same names: table, source_rows, target_rows, same."""
        side = lambda name, n: self.spark.range(1).select(F.lit(name).alias("table"), F.lit(n).cast("bigint").alias("target_rows"))
        targets = union_all([side(name, self.rows(name) if self.exists(name) else 0) for name in sorted(sources)])
        counts = union_all([df.agg(F.count("*").alias("source_rows")).select(F.lit(name).alias("table"), "source_rows") for name, df in sorted(sources.items())])
        return counts.join(targets, "table").withColumn("same", F.col("source_rows") == F.col("target_rows"))


def to_upload(local: DataFrame, remote: DataFrame, today: str | None = None) -> DataFrame:
    """Files (path, length) that the remote listing lacks or holds at another size, without the current day's."""
    day = F.lit(today) if today else F.date_format(F.current_date(), "yyyy-MM-dd")
    return local.where(~F.col("path").contains(day)).join(remote.select("path", "length"), ["path", "length"], "left_anti")


def to_delete(files: DataFrame, days: int, now=None) -> DataFrame:
    """Raw files (path, length, modificationTime) older than the retention."""
    end = F.lit(now) if now else F.current_timestamp()
    return files.where(F.col("path").endswith(".jsonl") & (F.col("modificationTime") < end - F.make_dt_interval(F.lit(days))))
