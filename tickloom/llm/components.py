"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialise


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return row[0], row[1]


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of one partition, joined as far as they are known there: every node with its smallest."""
    up: dict[int, int] = {}
    for batch in batches:
        for x, y in zip(batch["u"].tolist(), batch["v"].tolist(), strict=True):
            for n in (x, y):
                up.setdefault(n, n)
            while up[x] != x:
                up[x] = x = up[up[x]]
            while up[y] != y:
                up[y] = y = up[up[y]]
            up[max(x, y)] = min(x, y)
    for x in sorted(up):  # smaller ones first, so one step leads to the root
        up[x] = up[up[x]]
    yield pd.DataFrame({"u": list(up), "v": list(up.values())}, dtype="int64").query("u != v")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge; component is its smallest node.

    Each round links all greater neighbours of a node to the smallest one (large star),
    then all smaller neighbours (small star), until nothing changes; rounds grow with the
    logarithm of the number of nodes.  What a partition of edges connects is joined there
    first.  Only a count and a hash reach the driver.  Edges with a null end and loops are
    left out, repeated ones count once, an empty table gives no rows, and other columns are
    not read.
    """
    named = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    now = materialise(named.mapInPandas(_stars, "u long, v long").distinct())
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = materialise(small.where("u <> v").distinct())
        after = _state(now)
        if after == state:
            break
        state = after
    member = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return member.union(now.select("v", "v")).distinct()
