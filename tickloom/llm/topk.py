"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are cut into ``lists`` slices; each slice scores every query against
every candidate on its own, as a local score list.  (1) The best entries of every local
list are gathered and scored exactly; the k-th best of them is a cutoff that no result
can lie below.  (2) The cutoff goes out with the queries: a total of at least ``t``
needs one slice of at least ``t / lists``, so each slice sends just those entries.
(3) Entries whose upper bound still reaches the cutoff are scored exactly.

Equal vectors are merged first, and keep only the smallest ids that a result can name,
so a vector that a third of all rows share costs no more than any other.  Scores are
computed block against block: a task holds one block of queries and one of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import materialise
from tickloom.llm.hardneg import as_key, digest, matrix, of_key, products, told, whole

#: Vectors in one block of candidates and of queries.
CANDIDATES, QUERIES = 4096, 2048


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, components v) of the usable rows: floor(scale * x), x as double, held exactly in doubles.

    Rows with a null id or vector, or a component that is null or not finite (also after
    scaling), take no part.
    """
    v, usable = whole(vectors, vector_col, scale)
    own = vectors.where(vectors[id_col].isNotNull() & usable)
    return own.select(own[id_col].cast("bigint").alias("id"), v.alias("v"))


def _classes(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """One row for each distinct vector: key, print, v, its k+1 smallest ids, whether a query has it."""

    def smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.sort_values("id").drop_duplicates(["print", "id"])
            yield batch.groupby("print", sort=False).agg(v=("v", "first"), ids=("id", lambda x: x.head(k + 1).tolist()), asked=("asked", "max")).reset_index()

    keyed = rows.select(digest().alias("print"), "v", "id", is_query.alias("asked"))
    partial = keyed.mapInPandas(smallest, "print string, v array<double>, ids array<bigint>, asked boolean")
    merged = partial.groupBy("print").agg(
        F.first("v").alias("v"),
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"),
        F.max("asked").alias("asked"),
    )
    return merged.withColumn("key", F.monotonically_increasing_id())


def _sliced(rows: DataFrame, lists: int) -> DataFrame:
    """One row for each slice of a vector's dimensions; list 0 to ``lists`` - 1."""
    width = F.ceil(F.size("v") / F.lit(lists)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.lit(lists - 1)), lambda b: F.struct(b.alias("list"), F.slice(F.col("v"), b * width + 1, F.greatest(width, F.lit(1))).alias("part")))
    return rows.withColumn("s", F.explode(parts)).select(*[c for c in rows.columns if c != "v"], "s.list", "s.part", F.size("v").alias("dim"))


def _blocks(classes: DataFrame, asked: DataFrame, lists: int, n_cand: int, n_ask: int, scan, schema: str) -> DataFrame:
    """Run ``scan(queries, candidates)`` on every pair of blocks of each local list."""
    block = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")  # noqa: E731  the type of the other side, or equal blocks would be dealt apart
    # new names, for the two sides can come from one table
    cand = _sliced(classes.select(F.col("key").alias("ckey"), F.col("v").alias("v")), lists).withColumn("cb", block("ckey", n_cand)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_ask - 1))))
    ask = _sliced(asked, lists).withColumn("qb", block("key", n_ask)).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_cand - 1))))
    keys = ["list", "dim", "cb", "qb"]
    return ask.groupBy(*keys).cogroup(cand.groupBy(*keys)).applyInPandas(scan, schema)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    lists: int = 2,
) -> DataFrame:
    """The ``k`` best candidates of every query: query_id, rank, vec_id, score.

    ``is_query`` is a condition on the column ``id``.  A query's candidates are all rows
    of the same dimension with another id; ties go to the smaller id; fewer candidates
    give fewer rows.  Repeated rows of one id and vector count once.  Unusable rows
    (see ``quantised``) take no part, an empty table gives no rows, and columns other
    than the two named ones are not read.  Scores are ranked exactly; one outside the range
    of a long is told as the nearest long.
    """
    rows = quantised(vectors, id_col, vector_col, scale).select("id", "v")
    classes = materialise(_classes(rows, is_query, k))
    size = F.transform("v", lambda x: F.abs(x))
    n, n_asked, largest, widest = classes.agg(F.count("*"), F.count_if("asked"), F.max(F.array_max(size)), F.max(F.size("v"))).first()
    small = (largest or 0.0) < 2.0**31 and (largest or 0.0) ** 2 * (widest or 0) < 2**62
    # scores and their parts: longs, or keys that sort like numbers of any size
    kind, number = ("bigint", lambda x: x.astype(np.int64)) if small else ("binary", lambda x: [as_key(int(v)) for v in x])
    lists = lists if small else 1
    n_cand, n_ask = max(1, -(-n // CANDIDATES)), max(1, -(-n_asked // QUERIES))
    asked = classes.where("asked").select("key", "v")
    full = classes.select(F.col("key").alias("ckey"), F.col("v").alias("cv"))

    terms = F.zip_with("qv", "cv", lambda a, b: a.cast("bigint") * b.cast("bigint"))

    @F.pandas_udf("binary")
    def large(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([as_key(sum(int(x) * int(y) for x, y in zip(p, q, strict=True))) for p, q in zip(a, b, strict=True)])

    dot = F.aggregate(terms, F.lit(0).cast("bigint"), lambda a, b: a + b) if small else large("qv", "cv")

    def exact(pairs: DataFrame) -> DataFrame:
        """Add the exact score to (qkey, ckey) rows."""
        both = pairs.join(full, "ckey").join(asked.select(F.col("key").alias("qkey"), F.col("v").alias("qv")), "qkey")
        return both.withColumn("score", dot).drop("qv", "cv")

    best = k + 1  # the query's own class may be one of them

    def gather(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"qkey": [], "ckey": [], "list": [], "part": []})
        s = products(matrix(q["part"].tolist()), matrix(c["part"].tolist()))
        top = np.argpartition(-s, best, axis=1)[:, :best] if s.shape[1] > best else np.tile(np.arange(s.shape[1]), (len(q), 1))
        at = np.repeat(np.arange(len(q)), top.shape[1])
        return pd.DataFrame({"qkey": q["key"].to_numpy()[at], "ckey": c["ckey"].to_numpy()[top.ravel()], "list": q["list"].iloc[0], "part": number(s[at, top.ravel()])})

    local = _blocks(classes, asked, lists, n_cand, n_ask, gather, f"qkey long, ckey long, list int, part {kind}")
    per_list = Window.partitionBy("qkey", "list").orderBy(F.desc("part"), "ckey")
    first = local.withColumn("r", F.row_number().over(per_list)).where(F.col("r") <= best).select("qkey", "ckey").distinct()
    per_query = Window.partitionBy("qkey").orderBy(F.desc("score"), "ckey")
    cutoffs = exact(first).withColumn("r", F.row_number().over(per_query)).where(F.col("r") == best).select(F.col("qkey").alias("key"), F.col("score").alias("cutoff"))
    # fewer classes than that: everything is wanted
    informed = materialise(asked.join(cutoffs, "key", "left"))

    def send(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"qkey": [], "ckey": [], "part": [], "cutoff": []})
        s = products(matrix(q["part"].tolist()), matrix(c["part"].tolist()))
        cut = [None if pd.isna(x) else of_key(x) for x in q["cutoff"]]
        least = np.array([-np.inf if x is None else -(-x // lists) for x in cut], s.dtype if s.dtype == object else float)
        i, j = np.nonzero(s >= least[:, None])
        return pd.DataFrame({"qkey": q["key"].to_numpy()[i], "ckey": c["ckey"].to_numpy()[j], "part": number(s[i, j]), "cutoff": q["cutoff"].astype("Int64" if small else object).iloc[i].array})

    sent = _blocks(classes, informed, lists, n_cand, n_ask, send, f"qkey long, ckey long, part {kind}, cutoff {kind}")
    if small:
        held = sent.groupBy("qkey", "ckey").agg(F.sum("part").alias("seen"), F.count("*").alias("n"), F.first("cutoff").alias("cutoff"))
        upper = F.col("seen") + (lists - F.col("n")) * F.ceil(F.col("cutoff") / F.lit(lists)).cast("bigint")
        open_ = held.where(F.col("cutoff").isNull() | (upper >= F.col("cutoff")))
    else:  # one list: what is sent reaches the cutoff
        open_ = sent
    scored = exact(open_.select("qkey", "ckey"))
    members = scored.join(classes.select(F.col("key").alias("ckey"), "ids"), "ckey").select("qkey", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    named = members.withColumn("r", F.row_number().over(order)).where(F.col("r") <= best).drop("r")
    askers = rows.where(is_query).select(digest().alias("print"), F.col("id").alias("query_id")).distinct()
    askers = askers.join(classes.select("print", F.col("key").alias("qkey")), "print").drop("print")
    each = askers.join(named, "qkey").where(F.col("query_id") != F.col("vec_id"))
    clamped = F.col("score") if small else F.pandas_udf(lambda keys: pd.Series([told(of_key(k)) for k in keys], dtype="int64"), "bigint")("score")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", clamped.alias("score"))
