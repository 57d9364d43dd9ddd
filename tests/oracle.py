"""Compare a Spark result with DuckDB's."""

import datetime
import glob
import math
import os

import duckdb


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def duck(sf_dir, sql):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got = con.execute(sql)
    columns = [d[0] for d in got.description]
    return sorted(columns), rows_of(columns, got.fetchall())


def same(df, sf_dir, sql):
    columns, wanted = duck(sf_dir, sql)
    assert sorted(df.columns) == columns
    found = rows_of(df.columns, df.collect())
    assert len(found) == len(wanted)
    assert found == wanted
