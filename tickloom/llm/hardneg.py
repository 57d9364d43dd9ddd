"""Hard negatives by product quantisation with stored residual norms.

Vectors are cut into sub-vectors; each is coded by its nearest entry of a codebook, which a
bounded sample of rows trains, and beside the codes every vector stores the length of
what each code leaves out.  An anchor's inner products with all codebook entries make a
lookup table; summed over a row's codes they give its score up to the residual bound
``sum |anchor part| * |residual part|``.  So a block of rows is filtered by the table and
the bound alone: what cannot be among the best is left out rigorously, and all that may be
is scored by whole numbers.

Two passes pair blocks of anchors with blocks of rows.  The first finds every anchor's best
rows of its own label, which set the score windows; the second the best rows of other labels
inside each window.  Both give a bounded number of rows for each anchor and block.

Equal vectors of one label are merged first and keep only the smallest ids that a result
can name, so a vector that a third of all rows share costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import materialise

#: Rows in one block of candidates and of anchors; anchors scored at once inside a block.
CANDIDATES, ANCHORS, AT_ONCE = 4096, 1024, 256
#: Rows that train the codebooks, about and at most; sub-vectors; codebook entries; rounds of training.
SAMPLE, PARTS, ENTRIES, ROUNDS = 4096, 16, 256, 8
#: What rounding may add to a bound, as a share of the lengths involved.
ROUNDING = 1e-9
#: Bytes of a score beyond 2**53 as a key that sorts like the number: enough for any finite components.
KEY_BYTES = 280


def whole(vectors: DataFrame, vector_col: str, scale: int) -> tuple[Column, Column]:
    """floor(scale * x) of all components, held exactly in doubles, and whether the vector can be used.

    Unusable: null, a null component, or one that is not finite, also after scaling.
    """
    x = F.transform(vectors[vector_col].cast("array<double>"), lambda c: c * F.lit(float(scale)))
    usable = F.coalesce(F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False))), F.lit(False))
    return F.transform(x, lambda c: F.when(F.abs(c) < F.lit(2.0**53), F.floor(c).cast("double")).otherwise(c)), usable


def digest(v: str = "v") -> Column:
    """A digest of the components in a column."""
    return F.md5(F.array_join(F.col(v).cast("array<string>"), ","))


def matrix(rows) -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    return np.stack([np.asarray(r, float) for r in rows]) if len(rows) else np.zeros((0, 0))


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly: as doubles where these hold them, else as Python's integers."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, a.shape[1]) < 2**53:
        return a @ x.T
    ints = [np.array([[int(v) for v in row] for row in m], object).reshape(m.shape) for m in (a, x)]
    return ints[0] @ ints[1].T if a.shape[1] else np.zeros((len(a), len(x)), object)


def as_key(score: int) -> bytes:
    """A score as bytes that compare like the numbers do."""
    return (score + (1 << (8 * KEY_BYTES - 1))).to_bytes(KEY_BYTES, "big")


def of_key(key) -> int:
    return int.from_bytes(bytes(key), "big") - (1 << (8 * KEY_BYTES - 1)) if isinstance(key, (bytes, bytearray, memoryview)) else int(key)


def told(score: int) -> int:
    """The score, or the nearest long."""
    return max(-(2**63), min(2**63 - 1, score))


def slices(dim: int) -> list[slice]:
    """The sub-vectors of a vector."""
    parts = min(PARTS, dim)
    edges = [dim * p // parts for p in range(parts + 1)] if parts else [0]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def nearest(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The number of each row's nearest entry."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nan_to_num((entries**2).sum(1) - 2 * (x @ entries.T)).argmin(1)


def codebooks(sample: np.ndarray) -> list[np.ndarray]:
    """Entries of each sub-vector, by Lloyd's rounds from evenly spaced distinct rows."""
    books = []
    for part in slices(sample.shape[1]):
        x = sample[:, part]
        distinct = np.unique(x, axis=0)
        entries = distinct[np.linspace(0, len(distinct) - 1, min(ENTRIES, len(distinct))).astype(int)]
        for _ in range(ROUNDS):
            own = nearest(x, entries)
            n = np.bincount(own, minlength=len(entries))
            total = np.stack([np.bincount(own, weights=x[:, d], minlength=len(entries)) for d in range(x.shape[1])], 1)
            entries = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], entries)
        books.append(entries)
    return books


def train(rows: DataFrame) -> dict[int, list[np.ndarray]]:
    """Codebooks of each dimension in a sample of about ``SAMPLE`` rows, chosen by a hash."""
    n = rows.count()
    drawn = F.pmod(F.xxhash64("id", F.lit("codebook")), F.lit(1_000_000)) / 1e6 < min(1.0, SAMPLE / max(n, 1))
    sample = [tuple(r["v"]) for r in rows.where(drawn).select("v").limit(2 * SAMPLE).collect()]
    by_dim: dict[int, list] = {}
    for v in sorted(sample):
        by_dim.setdefault(len(v), []).append(v)
    return {d: codebooks(np.array(v, float).reshape(len(v), d)) for d, v in by_dim.items()}


def encode(x: np.ndarray, books: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes, and the lengths of what they leave out; without codebooks everything is left out."""
    parts = slices(x.shape[1])
    codes, rest = np.zeros((len(x), len(parts)), np.uint8), np.zeros((len(x), len(parts)))
    with np.errstate(over="ignore", invalid="ignore"):
        for p, part in enumerate(parts):
            y = x[:, part]
            if books is not None:
                codes[:, p] = nearest(y, books[p])
                y = y - books[p][codes[:, p]]
            rest[:, p] = np.sqrt((y**2).sum(1)) * (1 + ROUNDING)
    return codes, rest


def classes(rows: DataFrame, is_anchor: Column, keep: int, books: dict[int, list[np.ndarray]]) -> DataFrame:
    """Written once: one row for each vector and label, with its smallest ids, whether an anchor has it, its codes."""

    def smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.sort_values("id").drop_duplicates(["print", "label", "id"])
            yield batch.groupby(["print", "label"], sort=False).agg(v=("v", "first"), ids=("id", lambda x: x.head(keep).tolist()), asked=("asked", "max")).reset_index()

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len)):
                codes, rest = encode(matrix(part["v"].tolist()).reshape(len(part), dim), books.get(dim))
                yield part.assign(dim=dim, codes=[c.tobytes() for c in codes], rest=rest.tolist())

    partial = rows.select("print", "label", "v", "id", is_anchor.alias("asked")).mapInPandas(smallest, "print string, label string, v array<double>, ids array<bigint>, asked boolean")
    merged = partial.groupBy("print", "label").agg(F.first("v").alias("v"), F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"), F.max("asked").alias("asked"))
    keyed = merged.withColumn("key", F.monotonically_increasing_id())
    schema = "print string, label string, v array<double>, ids array<bigint>, asked boolean, key bigint, dim int, codes binary, rest array<double>"
    return materialise(keyed.mapInPandas(coded, schema))


def bounds(anchors: np.ndarray, codes: np.ndarray, rest: np.ndarray, books: list[np.ndarray] | None, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible score of every anchor and coded row, from lookup tables and residual lengths."""
    total, lengths = np.zeros((len(anchors), len(codes))), np.zeros((len(anchors), codes.shape[1]))
    with np.errstate(over="ignore", invalid="ignore"):
        for p, part in enumerate(slices(anchors.shape[1])):
            a = anchors[:, part]
            lengths[:, p] = np.sqrt((a**2).sum(1))
            if books is not None:
                total += (a @ books[p].T)[:, codes[:, p]]  # the anchor's table of this part, read by the rows' codes
        off = lengths @ rest.T * (1 + ROUNDING) + ROUNDING * (np.sqrt((anchors**2).sum(1)) * longest)[:, None]
        return np.nan_to_num(total - off, nan=-np.inf, posinf=np.inf, neginf=-np.inf), np.nan_to_num(total + off, nan=np.inf, posinf=np.inf, neginf=-np.inf)


def kth(values: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th largest of each row; minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return -np.partition(-values, k - 1, axis=1)[:, k - 1]


def best(scores: np.ndarray, wanted: np.ndarray, first_ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row its ``k`` first wanted columns, by score and then by smallest id."""
    for i in np.flatnonzero(wanted.any(axis=1)):
        at = np.flatnonzero(wanted[i])
        if len(at) > k and scores.dtype != object:
            at = at[scores[i, at] >= kth(scores[i : i + 1, at], k)[0]]
        yield int(i), np.array(sorted(at, key=lambda j: (-scores[i, j], first_ids[j]))[:k], int)


def paired(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, scan: Callable, schema: str) -> DataFrame:
    """Run ``scan`` on every block of anchors with every block of rows of their dimension."""
    blocks_a, blocks_r = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // CANDIDATES))
    block = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")  # noqa: E731  the type of the other side, or equal blocks would be dealt apart
    left = anchors.withColumn("ab", block("key", blocks_a)).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(blocks_r - 1))))
    right = rows.select(F.col("dim").alias("rdim"), F.col("key").alias("rkey"), F.col("label").alias("rlabel"), F.col("v").alias("rv"), "ids", "codes", "rest")
    right = right.withColumn("rrb", block("rkey", blocks_r)).withColumn("rab", F.explode(F.sequence(F.lit(0), F.lit(blocks_a - 1))))
    # other names on the right, for both sides can come from one table
    return left.groupBy("dim", "ab", "rb").cogroup(right.groupBy("rdim", "rab", "rrb")).applyInPandas(scan, schema)


class Block:
    """A block of rows, unpacked once: vectors, codes, residual lengths, labels, ids."""

    def __init__(self, r: pd.DataFrame, books: dict[int, list[np.ndarray]]) -> None:
        self.x = matrix(r["rv"].tolist())
        self.dim = self.x.shape[1]
        self.codes = np.stack([np.frombuffer(c, np.uint8) for c in r["codes"]])
        self.rest = matrix(r["rest"].tolist())
        self.labels, self.ids = r["rlabel"].to_numpy(), [np.asarray(i).tolist() for i in r["ids"]]
        self.first = np.array([i[0] for i in self.ids], object)
        self.books = books.get(self.dim)
        with np.errstate(over="ignore"):
            self.longest = float(np.sqrt((self.x**2).sum(1)).max(initial=0))

    def parts(self, a: pd.DataFrame) -> Iterator[tuple]:
        """Anchors in parts: their rows, vectors, bounds, and which rows have their label."""
        for at in range(0, len(a), AT_ONCE):
            own = a.iloc[at : at + AT_ONCE]
            v = matrix(own["v"].tolist()).reshape(len(own), self.dim)
            yield own, v, *bounds(v, self.codes, self.rest, self.books, self.longest), own["label"].to_numpy()[:, None] == self.labels[None, :]

    def exact(self, v: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whole scores of the rows that any anchor wants, which of them each wants, and their places."""
        columns = np.flatnonzero(wanted.any(axis=0))
        return products(v, self.x[columns]), wanted[:, columns], columns


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the column ``id``.  An anchor's positives are its
    ``positives`` best other rows of the same label and dimension; a positive's negatives the
    ``negatives`` best rows of other labels with ``low * p <= 100 * s <= high * p``.  Ties go
    to the smaller id, fewer rows give fewer, and a positive without any negative gives none.

    Rows with a null id, label, vector or component, or a component that is not finite, take
    no part.  An id should name one row: equal rows count once, and no row is paired with
    its own id.  An empty table gives no rows; other columns are not read.  Scores are exact
    for all finite components; one outside the range of a long is told as the nearest long.
    """
    spark: SparkSession = vectors.sparkSession
    v, usable = whole(vectors, vector_col, scale)
    own = vectors.where(vectors[id_col].isNotNull() & vectors[label_col].isNotNull() & usable)
    rows = own.select(own[id_col].cast("bigint").alias("id"), own[label_col].cast("string").alias("label"), v.alias("v"))
    rows = rows.withColumn("print", digest())
    books = train(rows)
    all_ = classes(rows, is_anchor, max(positives, negatives) + 1, books)
    n, n_asked, largest, widest = all_.agg(F.count("*"), F.count_if("asked"), F.max(F.array_max(F.transform("v", F.abs))), F.max("dim")).first()
    small = (largest or 0.0) ** 2 * max(widest or 0, 1) < 2**53 if (largest or 0.0) < 2.0**500 else False
    kind = "bigint" if small else "binary"
    key = int if small else as_key
    shared = spark.sparkContext.broadcast(books)  # as large as the sample at most

    def same_label(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(r):
            block = Block(r, shared.value)
            for own_, v_, least, most, same in block.parts(a):
                k = positives + 1  # the anchor itself may be one of them
                cut = kth(np.where(same, least, -np.inf), k)
                s, wanted, at = block.exact(v_, same & (most >= cut[:, None]))
                keys_ = own_["key"].to_numpy()
                for i, columns in best(s, wanted, block.first[at], k):
                    out += [(int(keys_[i]), key(int(s[i, j])), told(int(s[i, j])), block.ids[at[j]]) for j in columns]
        return pd.DataFrame(out, columns=["key", "at", "score", "ids"])

    def other_labels(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(r):
            block = Block(r, shared.value)
            for own_, v_, least, most, same in block.parts(a):
                k = negatives + 1
                keys_, windows = own_["key"].to_numpy(), [[of_key(p) for p in w] for w in own_["windows"]]
                for nth in range(max(map(len, windows), default=0)):
                    p = [w[nth] if nth < len(w) else None for w in windows]
                    lo = [0 if q is None else -((-low * q) // 100) for q in p]
                    hi = [-1 if q is None else high * q // 100 for q in p]
                    open_ = np.array([b >= a_ for a_, b in zip(lo, hi, strict=True)])
                    # rounded towards the outside for what may be in, towards the inside for what must be
                    lo_f, hi_f = (np.array([_double(q) for q in side]) for side in (lo, hi))
                    slack = ROUNDING * np.maximum(np.abs(lo_f), np.abs(hi_f))
                    with np.errstate(invalid="ignore"):  # beyond doubles nothing is left out, and nothing certain
                        edges = [np.nan_to_num(e, nan=n, posinf=np.inf, neginf=-np.inf)[:, None] for e, n in ((lo_f - slack, -np.inf), (hi_f + slack, np.inf), (lo_f + slack, np.inf), (hi_f - slack, -np.inf))]
                    may = ~same & open_[:, None] & (most >= edges[0]) & (least <= edges[1])
                    must = may & (least >= edges[2]) & (most <= edges[3])
                    cut = kth(np.where(must, least, -np.inf), k)
                    s, wanted, at = block.exact(v_, may & (most >= cut[:, None]))
                    if not len(at):
                        continue
                    inside = wanted & (s >= np.array(lo, s.dtype)[:, None]) & (s <= np.array(hi, s.dtype)[:, None])
                    for i, columns in best(s, inside, block.first[at], k):
                        out += [(int(keys_[i]), key(p[i]), key(int(s[i, j])), told(int(s[i, j])), block.ids[at[j]]) for j in columns]
        return pd.DataFrame(out, columns=["key", "p", "at", "score", "ids"])

    def ranked(found: DataFrame, by: list[str], most: int) -> DataFrame:
        """The first ``most`` ids of each key, as an array ``list`` in order."""
        each = found.select(*by, "at", "score", F.explode("ids").alias("id"))
        order = Window.partitionBy(*by).orderBy(F.desc("at"), "id")
        first = each.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most)
        return first.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("r", "id", "at", "score"))).alias("list"))

    asked = all_.where("asked").select("key", "label", "dim", "v")
    near = paired(asked, all_, n_asked, n, same_label, f"key bigint, at {kind}, score bigint, ids array<bigint>")
    best_own = materialise(ranked(near, ["key"], positives + 1))
    windows = asked.join(best_own.select("key", F.array_distinct(F.transform("list", lambda x: x["at"])).alias("windows")), "key")
    far = paired(windows, all_, n_asked, n, other_labels, f"key bigint, p {kind}, at {kind}, score bigint, ids array<bigint>")
    best_other = ranked(far, ["key", "p"], negatives + 1).groupBy("key").agg(F.collect_list(F.struct("p", "list")).alias("others"))
    results = all_.where("asked").select("key", "print", "label").join(best_own, "key").join(best_other, "key")

    anchors = rows.where(is_anchor).select(F.col("id").alias("anchor_id"), "print", "label").distinct()
    each = anchors.join(results, ["print", "label"])
    partners = F.slice(F.filter("list", lambda x: x["id"] != F.col("anchor_id")), 1, positives)
    each = each.select("anchor_id", "others", F.explode(partners).alias("pos"))
    of_window = F.get(F.filter("others", lambda x: x["p"] == F.col("pos")["at"]), F.lit(0))["list"]  # null without any
    each = each.withColumn("negs", F.slice(F.filter(of_window, lambda x: x["id"] != F.col("anchor_id")), 1, negatives))
    each = each.select("anchor_id", "pos", F.posexplode("negs").alias("r", "neg"))
    return each.select("anchor_id", F.col("pos")["id"].alias("positive_id"), (F.col("r") + 1).cast("int").alias("rank"), F.col("neg")["id"].alias("negative_id"), F.col("pos")["score"].alias("positive_score"), F.col("neg")["score"].alias("negative_score"))


def _double(n: int) -> float:
    """The nearest double, infinite beyond them."""
    try:
        return float(n)
    except OverflowError:
        return float("inf") if n > 0 else float("-inf")
