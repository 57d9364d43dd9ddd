"""Every registered query of the engine against its SQL."""

import pytest

from tests.conftest import SF
from tests.oracle import same
from tickloom.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    same(catalog.QUERIES[name](spark, SF), SF, catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() >= 0


def test_entry_has_rows_and_all_queries_are_callable(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_filters_and_columns_reach_the_scan(spark):
    from pyspark.sql import functions as F

    events = spark.read.parquet(f"{SF}/events.parquet").where(F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz")).groupBy("event_type").agg(F.sum("value").alias("v"))
    plan = events._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in plan and "props" not in plan.split("ReadSchema")[-1]
