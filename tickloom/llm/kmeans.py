"""Centroid clustering with Drake's adaptive bounds.

Exact rounds of assigning and averaging, in which most vectors need no distances.  Every
vector keeps its centroid, an upper bound of the distance to it, the few next nearest
centroids with a lower bound each, and one remainder bound below its distance to all
others.  When centroids move, bounds give way by how far; while the upper bound stays below
all lower ones nothing is computed, while it stays below the remainder bound only the listed
centroids are, and all of them are rescanned where the order cannot be certified otherwise.
How many centroids are listed adapts to how deep the vectors had to look the round before.

Each round is one pass without a shuffle over the vectors and their bounds, which are
written to the shared folder, so a lost executor costs its own part of one round.  What
leaves a task are sums: one row for each centroid.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import lean, shared_folder
from tickloom.llm.hardneg import matrix, told, whole

#: What rounding may add to a distance, as a share of it.
UP, DOWN = 1 + 1e-12, 1 - 1e-12
#: Of the vectors, so many shall find the centroids they need listed.
SERVED = 0.99
STATE = "id bigint, v array<double>, own int, upper double, near array<int>, lower array<double>, rest double, depth int"


def numbers(rows, small: bool) -> np.ndarray:
    """Arrays of whole doubles as a matrix; of Python's integers where doubles cannot hold squared distances."""
    m = matrix(rows)
    return m if small else np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)


def paired(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to the row of the same number."""
    return ((x - c) ** 2).sum(axis=1)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    if x.dtype == object:
        return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)
    return (x**2).sum(1)[:, None] - 2 * (x @ c.T) + (c**2).sum(1)[None, :]


def root(d: np.ndarray) -> np.ndarray:
    """Square roots; infinite beyond what doubles hold."""
    if d.dtype != object:
        return np.sqrt(d)
    return np.array([float(v) ** 0.5 if v < 2**1000 else float("inf") for v in d.ravel().tolist()], float).reshape(d.shape)


def by_distance(ids: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's centroids, nearest first and the smaller number first of equal ones, with their distances."""
    rank = d if d.dtype != object else np.unique(d.ravel(), return_inverse=True)[1].reshape(d.shape)
    order = np.lexsort((ids, rank), axis=1)
    return np.take_along_axis(ids, order, 1), root(np.take_along_axis(d, order, 1))


class Bounds:
    """The centroid and the bounds of a batch of vectors."""

    def __init__(self, x: np.ndarray, listed: int) -> None:
        n = len(x)
        self.x, self.own, self.upper = x, np.zeros(n, np.int32), np.full(n, np.inf)
        self.near, self.lower, self.rest = np.zeros((n, listed), np.int32), np.full((n, listed), -np.inf), np.full(n, -np.inf)
        self.depth = np.zeros(n, np.int32)

    def scan(self, rows: np.ndarray, c: np.ndarray) -> None:
        """Compare some vectors with all centroids and set their bounds anew."""
        listed = self.near.shape[1]
        ids, far = by_distance(np.broadcast_to(np.arange(len(c), dtype=np.int32), (len(rows), len(c))), distances(self.x[rows], c))
        self.own[rows], self.upper[rows] = ids[:, 0], far[:, 0] * UP
        self.near[rows], self.lower[rows] = ids[:, 1 : listed + 1], far[:, 1 : listed + 1] * DOWN
        self.rest[rows] = far[:, listed + 1] * DOWN if len(c) > listed + 1 else np.inf

    def reorder(self, rows: np.ndarray, c: np.ndarray) -> None:
        """Compare some vectors with their own and their listed centroids; no other can be as near."""
        listed = np.concatenate([self.own[rows, None], self.near[rows]], axis=1)
        d = np.stack([paired(self.x[rows], c[listed[:, q]]) for q in range(listed.shape[1])], axis=1)
        ids, far = by_distance(listed, d)
        self.own[rows], self.upper[rows] = ids[:, 0], far[:, 0] * UP
        self.near[rows], self.lower[rows] = ids[:, 1:], far[:, 1:] * DOWN

    def move(self, c: np.ndarray, drift: np.ndarray) -> None:
        """Let the bounds give way to centroids that moved by ``drift``, and mend what they no longer certify.

        ``depth`` tells how many listed bounds a vector had to look behind; one more than all for a rescan.
        """
        with np.errstate(invalid="ignore", over="ignore"):  # infinite less infinite certifies nothing
            self.upper = np.nan_to_num((self.upper + drift[self.own]) * UP, nan=np.inf, posinf=np.inf)
            lower = (self.lower - drift[self.near]) - np.abs(self.lower) * (UP - 1)
            rest = (self.rest - drift.max(initial=0)) - np.abs(self.rest) * (UP - 1)
            self.lower, self.rest = (np.nan_to_num(b, nan=-np.inf, posinf=np.inf, neginf=-np.inf) for b in (lower, rest))
        least = np.minimum(self.lower.min(axis=1, initial=np.inf), self.rest)
        open_ = np.flatnonzero(~(self.upper < least))
        self.upper[open_] = root(paired(self.x[open_], c[self.own[open_]])) * UP
        open_ = open_[~(self.upper[open_] < least[open_])]
        certain = self.upper[open_] < self.rest[open_]
        inside, beyond = open_[certain], open_[~certain]
        self.depth[inside] = (~(self.upper[inside, None] < self.lower[inside])).sum(axis=1)
        self.depth[beyond] = self.near.shape[1] + 1
        if len(inside):
            self.reorder(inside, c)
        if len(beyond):
            self.scan(beyond, c)

    def narrow(self, listed: int) -> None:
        """List fewer centroids; the bounds that go fall into the remainder."""
        if listed < self.near.shape[1]:
            order = np.argsort(self.lower, axis=1, kind="stable")
            near, lower = np.take_along_axis(self.near, order, 1), np.take_along_axis(self.lower, order, 1)
            self.rest = np.minimum(self.rest, lower[:, listed])
            self.near, self.lower = near[:, :listed], lower[:, :listed]

    def frame(self, batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": batch["id"], "v": batch["v"], "own": self.own, "upper": self.upper, "near": list(self.near), "lower": list(self.lower), "rest": self.rest, "depth": self.depth})

    @classmethod
    def of(cls, batch: pd.DataFrame, small: bool) -> Bounds:
        near = np.stack(batch["near"].tolist())
        b = cls(numbers(batch["v"].tolist(), small), near.shape[1])
        b.own, b.upper, b.rest = (batch[c].to_numpy(copy=True) for c in ("own", "upper", "rest"))
        b.near, b.lower = near, np.stack(batch["lower"].tolist())
        return b


def totals(rows: DataFrame, values: str) -> dict[int, tuple[int, list[int]]]:
    """Number of rows and exact componentwise sums of each ``own``, from an array of whole numbers as doubles or text.

    A task gives one row for each centroid, and so does the result.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter = Counter()
        sums: dict[int, list[int]] = {}
        for batch in batches:
            for own, part in batch.groupby("own"):
                if isinstance(part[values].iloc[0][0], str):
                    m = np.array([[int(x) for x in row] for row in part[values]], object)
                else:
                    m = matrix(part[values].tolist())
                    m = m if np.abs(m).max(initial=0) * len(m) < 2**53 else numbers(m, False)
                own, more = int(own), [int(x) for x in m.sum(axis=0)]
                n[own] += len(part)
                sums[own] = [a + b for a, b in zip(sums[own], more, strict=True)] if own in sums else more
        if n:
            yield frame(n, sums)

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        return frame({int(part["own"].iloc[0]): int(part["n"].sum())}, {int(part["own"].iloc[0]): [sum(map(int, column)) for column in zip(*part["sums"], strict=True)]})

    def frame(n: dict[int, int], sums: dict[int, list[int]]) -> pd.DataFrame:
        return pd.DataFrame({"own": list(n), "n": list(n.values()), "sums": [[str(x) for x in sums[k]] for k in n]})

    schema = "own int, n bigint, sums array<string>"
    got = rows.select("own", values).mapInPandas(lean(partial), schema).groupBy("own").applyInPandas(merge, schema).collect()
    return {r["own"]: (r["n"], [int(x) for x in r["sums"]]) for r in got}


def _forget(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cluster(
    vectors: DataFrame,
    order: Column,
    k: int = 40,
    rounds: int = 5,
    dim: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """Cluster of every vector: the id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid (as decimal text).

    Vectors of exactly ``dim`` components, each finite (also after scaling), are kept, as
    whole numbers floor(scale * x).  The first ``k`` of them by ``order`` (nulls last, then
    by id and components) are the centroids 0, 1, ...; fewer vectors give fewer.  Each round
    assigns every vector to the nearest centroid, the smaller number of equally near ones,
    and moves every centroid that has vectors to the floor of their mean; then vectors are
    assigned once more.

    Rows with a null id and repeated rows are vectors like others; an empty table gives no
    rows; other columns are not read.  Assignment is exact for all finite components;
    a distance or inertia beyond a long is told as the largest long.
    """
    spark = vectors.sparkSession
    v, usable = whole(vectors, vector_col, scale)
    kept = vectors.where(usable & (F.size(vectors[vector_col]) == dim))
    rows = kept.select(kept[id_col].cast("bigint").alias("id"), v.alias("v"), order.alias("order"))
    first = rows.orderBy(F.asc_nulls_last("order"), F.asc_nulls_last("id"), "v").limit(k).collect()
    schema = f"{id_col} bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<string>"
    if not first:
        return spark.createDataFrame([], schema)
    largest = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0.0
    small = largest < 2.0**500 and 4 * largest * largest * max(dim, 1) < 2**53
    centroids = numbers([r["v"] for r in first], small)
    listed, least = min(len(first) - 1, max(1, len(first) // 4)), min(len(first) - 1, max(1, len(first) // 8))
    folder = f"{shared_folder(spark)}/kmeans-{uuid.uuid4().hex}"

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            b = Bounds(numbers(batch["v"].tolist(), small), listed)
            b.scan(np.arange(len(batch)), centroids)
            yield b.frame(batch)

    state = rows.select("id", "v").mapInPandas(lean(begin), STATE)
    for n in range(rounds):
        path = f"{folder}/{n}"
        state.write.parquet(path)
        if n:
            _forget(spark, f"{folder}/{n - 1}")
        written = spark.read.schema(STATE).parquet(path)
        sums = totals(written, "v")
        looked = sorted((r["depth"], r["count"]) for r in written.groupBy("depth").count().collect())  # a row for each listed centroid at most
        means = [[s // sums[j][0] for s in sums[j][1]] if j in sums else centroids[j].tolist() for j in range(len(first))]
        moved = np.array(means, float if small else object)
        drift = root(paired(moved, centroids)) * UP
        narrower = _listed(looked, listed, least) if n else listed
        state = written.mapInPandas(lean(_mover(moved, drift, narrower, small)), STATE)
        centroids, listed = moved, narrower

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["own"].to_numpy()
            d = [int(x) for x in paired(numbers(batch["v"].tolist(), small), centroids[own])]
            yield pd.DataFrame({"id": batch["id"], "own": own, "distance": [told(x) for x in d], "exact": [[str(x)] for x in d]})

    state.mapInPandas(lean(measure), "id bigint, own int, distance bigint, exact array<string>").write.parquet(f"{folder}/end")
    if rounds:
        _forget(spark, f"{folder}/{rounds - 1}")
    written = spark.read.schema("id bigint, own int, distance bigint, exact array<string>").parquet(f"{folder}/end")
    inertia = {j: s[0] for j, (_, s) in totals(written, "exact").items()}
    text = {j: [str(int(x)) for x in centroids[j]] for j in inertia}
    facts = [(j, told(inertia[j]), told(sum(inertia.values())), hashlib.sha256(",".join(text[j]).encode()).hexdigest(), text[j]) for j in sorted(inertia)]
    about = spark.createDataFrame(facts, "own int, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<string>")
    # as many rows as centroids
    return written.join(F.broadcast(about), "own").select(F.col("id").alias(id_col), F.col("own").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def _listed(looked: list[tuple[int, int]], listed: int, least: int) -> int:
    """How many centroids to list so that ``SERVED`` of the vectors need no rescan for want of listed ones."""
    total, seen = sum(n for _, n in looked), 0
    for depth, n in looked:
        seen += n
        if seen >= SERVED * total:
            return max(least, min(listed, depth))
    return listed


def _mover(centroids: np.ndarray, drift: np.ndarray, listed: int, small: bool):
    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            b = Bounds.of(batch, small)
            b.move(centroids, drift)
            b.narrow(listed)
            yield b.frame(batch)

    return move
