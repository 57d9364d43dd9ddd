"""Benchmark decontamination by latent semantic retrieval.

Benchmark items and overlapping passages of documents are TF-IDF vectors over the items'
words, with document frequencies counted over all documents.  A randomised singular value
decomposition of the passages of all documents and all items, its products computed by
Spark, gives the latent space.  Every passage of every whole document
is projected into it and compared with all items by cosine; what comes close is checked
word by word: the longest common subsequence with the whole item, and for looser matches
whether the item's answer (its last sentence) stands there too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import lean, materialise, settle, small_batches
from tickloom.llm.omh import SPACELESS

#: In scripts without spaces each character is a word; elsewhere letters and digits in a row are.
SOME, UNIT, WORD = re.compile(f"[{SPACELESS}]"), re.compile(f"[{SPACELESS}]|[^\\W_{SPACELESS}]+"), re.compile(r"[^\W_]+")
#: What is neither ASCII nor a Latin letter; texts without it are split by fast whole-text operations.
OTHER = re.compile("[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]")
#: ASCII punctuation and control characters become blanks.
APART = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))
SENTENCE = re.compile(r"(?<=[.!?])\s+")
#: Words from one passage to the next; a passage is two of these.
STEP = 24
#: Items searched in one pass over the documents; more take several, with the same words and the same space.
ITEMS = 8192
#: Bytes of word vectors that are broadcast at most: a benchmark of more words is an error, for it must be split.
LARGEST = 2 << 30
#: Dimensions of the latent space at most, and extra directions and rounds of the decomposition.
RANK, EXTRA, ROUNDS = 256, 16, 2
#: Weight of an item among the passages of so many documents; with more documents items weigh more, so that the space keeps them.
WEIGHT, AMONG = 8.0, 4000
#: Partitions of the products' matrix, whose size the vocabulary bounds, so partial sums of the decomposition to add up.
SUMS = 8
#: Products of word pairs that a task holds before it hands them on; rows of the product matrix that are added up at once.
HELD, ROWS = 1 << 20, 64
#: Words in a larger share of all documents carry no weight, unless an item has little else.
COMMON = 0.2
#: Least cosine of a candidate, and of a paraphrase; share of an item that must stand in order; the same where its answer stands too.
COSINE, CLOSE, VERBATIM, PARAPHRASE, ANSWER = 0.4, 0.6, 0.8, 0.5, 0.8
#: Share of an item's length that a passage must have along it.
MASS = 0.35
#: What rounding may take from a passage's bound; word vectors whose bounds are made at once; an item's least length, as a share of the longest, for which there is one.
SLACK, BOUNDS, TINY = 0.01, 1024, 1e-6
#: Words of a text handled at once.
CHUNK = 100_000

FOUND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("common", T.DoubleType()), T.StructField("answer", T.DoubleType()), T.StructField("text_hash", T.LongType())])


def words_of(text: str | None) -> list[str]:
    """Lower-case words; white space and punctuation of any script part them."""
    if not text:
        return []
    low = text.lower()
    if low.isascii() or not OTHER.search(low):
        return low.encode().translate(APART).decode().split()
    return UNIT.findall(low) if SOME.search(low) else WORD.findall(low)


def answer_of(text: str | None) -> list[str]:
    """Words of the last sentence that has three; else the last quarter of all words."""
    for sentence in reversed(SENTENCE.split(text or "")):
        if len(words_of(sentence)) >= 3:
            return words_of(sentence)
    every = words_of(text)
    return every[-max(1, len(every) // 4) :]


def parts_of(words: list[str]) -> list[list[str]]:
    """The passages by which an item is searched: all of it, or windows of a passage's length."""
    if len(words) <= 3 * STEP:
        return [words]
    return [words[k : k + 2 * STEP] for k in range(0, max(1, len(words) - STEP), 2 * STEP)]


def common_subsequence(item: list[str], region: list[str]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    at: dict[str, int] = {}
    for i, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in region:
        if match := at.get(w):
            up = row & match
            row = ((row + up) | (row - up)) & full
    return len(item) - row.bit_count()


COUNTED = "n long, word binary, held binary, first binary, at binary, tf binary"


def counted(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """Words of the vocabulary in all passages of all documents, a row for each batch of documents.

    ``n`` documents; of them ``held`` hold each ``word``; each passage's words ``at`` and their
    counts ``tf`` begin at ``first``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            own, keys, passages = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
            for text in batch["text"]:
                words = words_of(text)
                ids = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
                place = np.flatnonzero(ids >= 0)
                ids = ids[place]
                own.append(np.unique(ids))
                keys.append((passages + place // (2 * STEP)) * len(known) + ids)
                passages += -(-len(words) // (2 * STEP))
            word, held = np.unique(np.concatenate(own), return_counts=True)
            key, tf = np.unique(np.concatenate(keys), return_counts=True)
            row, at = key // len(known), key % len(known)
            first = np.flatnonzero(np.diff(row, prepend=-1))
            packed = [x.astype(kind).tobytes() for x, kind in ((word, "i4"), (held, "i4"), (first, "i4"), (at, "i4"), (tf, "u1"))]
            yield pd.DataFrame([(len(batch), *packed)], columns=["n", "word", "held", "first", "at", "tf"])

    return docs.select("text").mapInPandas(lean(run), COUNTED)


def document_frequencies(counts: DataFrame, features: int) -> tuple[int, np.ndarray]:
    """Documents, and how many of them hold each word; over all documents."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(features, np.int64), 0
        for batch in batches:
            n += int(batch["n"].sum())
            for word, held in zip(batch["word"], batch["held"], strict=True):
                total[np.frombuffer(word, "i4")] += np.frombuffer(held, "i4")
        some = np.flatnonzero(total)
        yield pd.DataFrame({"word": [-1, *some], "n": [n, *total[some]]})

    rows = counts.select("n", "word", "held").mapInPandas(lean(add), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(features), 0
    for r in rows:
        if r["word"] < 0:
            n = r["n"]
        else:
            df[r["word"]] = r["n"]
    return n, df


def unit_rows(first: np.ndarray, at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors of the passages that hold two words of weight: where each begins, words, values."""
    row = np.repeat(np.arange(len(first)), np.diff(first, append=len(at)))
    value = (1 + np.log(tf.astype(float))) * idf[at]
    kept = value > 0
    kept &= (np.bincount(row[kept], minlength=len(first)) >= 2)[row]
    row, at, value = row[kept], at[kept], value[kept]
    value /= np.sqrt(np.bincount(row, value**2, len(first)))[row]
    return np.flatnonzero(np.diff(row, prepend=-1)), at, value


def summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of equal keys added up, by key."""
    order = np.argsort(key)
    key, value = key[order], value[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(value, first) if len(first) else value


def pair_products(first: np.ndarray, at: np.ndarray, value: np.ndarray, features: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each two words of a vector, and each with itself, the smaller's number times ``features`` and the larger's, and the product of their values."""
    left = np.repeat(np.append(first[1:], len(at))[: len(first)], np.diff(first, append=len(at))) - np.arange(len(at))  # words from this one to the vector's last
    begun = np.concatenate([[0], np.cumsum(left)])
    start = 0
    while start < len(at):
        end = max(start + 1, int(np.searchsorted(begun, begun[start] + HELD, "right")) - 1)
        n = left[start:end]
        a = np.repeat(np.arange(start, end), n)
        b = a + np.arange(len(a)) - np.repeat(begun[start:end] - begun[start], n)
        yield summed(at[a].astype(np.int64) * features + at[b], value[a] * value[b])
        start = end


def products(vectors: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], features: int) -> Iterator[pd.DataFrame]:
    """The upper half of A'A by ranges ``k`` of ``ROWS`` rows, as far as a task's vectors go; a task hands on what it holds now and then."""

    def handed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        key, value = summed(np.concatenate([k for k, _ in parts]), np.concatenate([v for _, v in parts]))
        edge = np.flatnonzero(np.diff(key // (features * ROWS), prepend=-1))
        ends = np.append(edge[1:], len(key))
        made = [(int(key[s] // (features * ROWS)), key[s:e].tobytes(), value[s:e].tobytes()) for s, e in zip(edge, ends, strict=True)]
        return pd.DataFrame(made, columns=["k", "key", "value"])

    parts, held = [], 0
    for first, at, value in vectors:
        for part in pair_products(first, at, value, features):
            parts.append(part)
            held += len(part[0])
            if held > 2 * HELD:
                yield handed(parts)
                parts, held = [], 0
    if parts:
        yield handed(parts)


PRODUCTS = "k int, key binary, value binary"


def gram(parts: DataFrame, features: int) -> DataFrame:
    """The parts of ``products`` added up: one row for each range of rows, one range at a time."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, total = None, np.zeros(0)

        def told() -> pd.DataFrame:
            some = np.flatnonzero(total)
            return pd.DataFrame([(now, (some + now * ROWS * features).tobytes(), total[some].tobytes())], columns=["k", "key", "value"])

        for batch in batches:
            for k, key, value in zip(batch["k"], batch["key"], batch["value"], strict=True):
                if k != now:
                    if now is not None:
                        yield told()
                    now, total = k, np.zeros(ROWS * features)
                total[np.frombuffer(key, np.int64) - k * ROWS * features] += np.frombuffer(value)
        if now is not None:
            yield told()

    return parts.repartition("k").sortWithinPartitions("k").mapInPandas(lean(add), PRODUCTS)


def latent_space(matrix: DataFrame, features: int, rank: int, seed: int = 17) -> np.ndarray:
    """Leading right singular directions (features x rank) of vectors A, from ``gram``'s A'A; values are 0 for none.

    Randomised subspace iteration: Spark computes A'A Q by partitions and sums it by
    blocks of features; the driver keeps only Q, whose size the vocabulary bounds.
    """
    width, chunk = rank + EXTRA, 256  # blocks of a sum, under a megabyte each
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((features, min(width, features))))[0]
    for _ in range(ROUNDS + 1):
        now = matrix.sparkSession.sparkContext.broadcast(q)

        def multiply(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            basis, total = now.value, np.zeros_like(now.value)
            for batch in batches:
                for k, key, value in zip(batch["k"], batch["key"], batch["value"], strict=True):
                    key, value = np.frombuffer(key, np.int64), np.frombuffer(value)
                    i, j = key // features, key % features
                    columns, place = np.unique(j, return_inverse=True)
                    rows = np.zeros((ROWS, len(columns)))
                    rows[i - k * ROWS, place] = value
                    end = min((k + 1) * ROWS, features)
                    total[k * ROWS : end] += (rows @ basis[columns])[: end - k * ROWS]
                    rows[i[i == j] - k * ROWS, place[i == j]] = 0  # the other half, without the diagonal
                    total[columns] += rows[: end - k * ROWS].T @ basis[k * ROWS : end]
            for k in range(0, features, chunk):
                yield pd.DataFrame({"k": [k], "part": [total[k : k + chunk].astype(np.float32).tobytes()]})

        def add(group: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(p, np.float32).astype(float) for p in group["part"])
            return pd.DataFrame({"k": group["k"].iloc[:1], "part": [total.tobytes()]})

        rows = matrix.mapInPandas(lean(multiply), "k int, part binary").groupBy("k").applyInPandas(add, "k int, part binary").collect()
        product = np.concatenate([np.frombuffer(r["part"]).reshape(-1, q.shape[1]) for r in sorted(rows, key=lambda r: r["k"])])
        q, size, _ = np.linalg.svd(product, full_matrices=False)
    keep = size > size.max(initial=0) * 1e-9
    return q[:, keep][:, :rank]


class Words:
    """The words of all items that carry weight, with their vectors; the same for every block of items."""

    def __init__(self, vocabulary: dict[str, int], idf: np.ndarray, basis: np.ndarray) -> None:
        kept = sorted(w for w, k in vocabulary.items() if idf[k] > 0)
        at = [vocabulary[w] for w in kept]
        self.vocabulary, self.weighted = {w: k for k, w in enumerate(kept)}, (idf[at, None] * basis[at]).astype(np.float32)
        if self.weighted.nbytes > LARGEST:
            raise ValueError(f"word vectors of {self.weighted.nbytes >> 20} MB: split the benchmark")


class Space:
    """A block of items, searched in passages: the items' words and latent parts.

    ``most`` is the largest share of any part's length that one occurrence of a word can add along it.
    Shares add up, so a passage whose words together have less than ``MASS`` is near no part and
    need not be projected.
    """

    def __init__(self, items: list[tuple[int, list[str], list[str]]], of: list[int], latent: np.ndarray, norms: np.ndarray, weighted: np.ndarray) -> None:
        self.items, self.of = items, of
        self.latent, self.norms = latent.astype(np.float32), norms.astype(np.float32)
        self.most = np.full(len(weighted), np.inf)
        if self.norms.min() > TINY * self.norms.max():  # a part that the space does not hold is near everything
            for k in range(0, len(weighted), BOUNDS):
                self.most[k : k + BOUNDS] = (weighted[k : k + BOUNDS] @ self.latent.T / self.norms).max(1)
        self.distinct = [set(item) for _, item, _ in items]
        self.longest = max(len(item) for _, item, _ in items)

    def search(self, words: list[str], known: Words) -> dict[int, tuple[float, float, float]]:
        """Items found among the words: cosine, share in common, share of the answer."""
        ids = np.fromiter(map(known.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return {}
        ids, step = ids[at], at // STEP
        most = np.bincount(step, self.most[ids], -(-len(words) // STEP) + 1)
        live = np.flatnonzero(most[:-1] + most[1:] >= (1 - SLACK) * MASS)
        if not len(live):
            return {}
        needed = np.zeros(len(most), bool)
        needed[live] = needed[live + 1] = True
        row = np.cumsum(needed) - 1
        ids, step = ids[needed[step]], row[step[needed[step]]]
        first = np.flatnonzero(np.diff(step, prepend=-1))
        sums = np.zeros((row[-1] + 1, known.weighted.shape[1]), np.float32)
        sums[step[first]] = np.add.reduceat(known.weighted[ids], first)
        passage = sums[row[live]] + sums[row[live + 1]]
        size = np.sqrt((passage**2).sum(1))
        along = passage @ self.latent.T
        cosine = along / np.maximum(size, 1e-9)[:, None]
        found: dict[int, tuple[float, float, float]] = {}
        # a whole copy reaches the part's full length whatever stands around it
        near, which = np.nonzero((along >= MASS * self.norms) & ((cosine >= COSINE) | (along >= VERBATIM * self.norms)))
        last, region, held, done = -1, [], set(), set()
        for p, part in zip(near.tolist(), which.tolist(), strict=True):
            i = self.of[part]
            item_id, item, answer = self.items[i]
            if p != last:
                start, last = int(live[p]) * STEP, p
                region = words[max(0, start - self.longest) : start + 2 * STEP + self.longest]
                held, done = set(region), set()
            if i in done:
                continue
            done.add(i)
            distinct = self.distinct[i]
            if len(distinct & held) < PARAPHRASE * len(distinct):  # a subsequence cannot be longer
                continue
            near_it = words[max(0, start - len(item)) : start + 2 * STEP + len(item)]
            common = common_subsequence(item, near_it) / len(item)
            stands = common_subsequence(answer, near_it) / len(answer)
            if common >= VERBATIM or (common >= PARAPHRASE and stands >= ANSWER and cosine[p, part] >= CLOSE):
                found[item_id] = max(found.get(item_id, (0.0, 0.0, 0.0)), (float(cosine[p, part]), common, stands), key=lambda x: x[1])
        return found


def _of_passages(counts: DataFrame, idf: np.ndarray) -> DataFrame:
    """``products`` of the passages of all documents."""
    shared = counts.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = lambda packed: [np.frombuffer(x, kind) for x, kind in zip(packed, ("i4", "i4", "u1"), strict=True)]
        rows = (unit_rows(*of(r), shared.value) for batch in batches for r in zip(batch["first"], batch["at"], batch["tf"], strict=True))
        yield from products(rows, len(shared.value))

    return counts.select("first", "at", "tf").coalesce(counts.sparkSession.sparkContext.defaultParallelism).mapInPandas(lean(run), PRODUCTS)


def _of_items(spark: SparkSession, rows: list[tuple[list[int], list[float]]], weight: float, features: int) -> DataFrame:
    """``products`` of the items' vectors, each taken ``weight`` times; tasks make them, so that the driver holds no more than the vectors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = ((np.zeros(1, int), np.frombuffer(at, "i4"), weight * np.frombuffer(v)) for batch in batches for at, v in zip(batch["at"], batch["value"], strict=True))
        yield from products(vectors, features)

    packed = [(np.array(at, "i4").tobytes(), np.array(v, float).tobytes()) for at, v in rows]
    return spark.createDataFrame(packed, "at binary, value binary").mapInPandas(lean(run), PRODUCTS)


def _spaces(docs: DataFrame, items: list[tuple[int, str]]) -> Iterator[tuple[Broadcast, Space]]:
    """One latent space for all items: the words of all, with up to ``ITEMS`` items at a time."""
    spark = docs.sparkSession
    known = [(i, words, answer_of(t)) for i, t in items if (words := words_of(t))]
    vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws, _ in known for w in ws}))}
    if not vocabulary:
        return
    counts = materialise(counted(docs, vocabulary))
    n, df = document_frequencies(counts, len(vocabulary))
    if not n:
        return
    idf = np.log((n + 1) / (df + 0.5))
    drop = df > COMMON * n
    for _, ws, _ in known:  # an item that stands in many documents keeps its words
        own = [vocabulary[w] for w in set(ws)]
        if drop[own].mean() > 0.5:
            drop[own] = False
    idf[drop] = 0
    rows, norms, of = [], [], []
    for k, (_, ws, _) in enumerate(known):
        for part in parts_of(ws):
            tf = Counter(map(vocabulary.__getitem__, part))
            at = np.array(sorted(tf))
            value = np.array([1 + np.log(tf[a]) for a in at]) * idf[at]
            norms.append(np.linalg.norm(value))
            rows.append((at.tolist(), (value / max(norms[-1], 1e-9)).tolist()))
            of.append(k)
    weight = WEIGHT * max(1.0, n / AMONG) ** 0.5
    parts = _of_items(spark, rows, weight, len(vocabulary))
    matrix = materialise(gram(_of_passages(counts, idf).unionByName(parts), len(vocabulary))).coalesce(SUMS)
    settle(spark)
    basis = latent_space(matrix, len(vocabulary), RANK)
    latent = np.stack([np.asarray(v) @ basis[a] for a, v in rows])
    seen = np.linalg.norm(latent, axis=1)  # the share of a part that the space holds
    latent /= np.maximum(seen, 1e-9)[:, None]
    norms, of = np.array(norms) * seen, np.array(of)
    known_words = Words(vocabulary, idf, basis)
    words = spark.sparkContext.broadcast(known_words)
    for first in range(0, len(known), ITEMS):
        some = np.flatnonzero((of >= first) & (of < first + ITEMS))
        yield words, Space(known[first : first + ITEMS], (of[some] - first).tolist(), latent[some], norms[some], known_words.weighted)


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, common, answer, text_hash): the items that each document holds.

    ``common`` is the share of the whole item's words that stand in the passage in order,
    ``answer`` the same for its last sentence; the rule is the same for items of any
    length.  Whole texts are searched.  The space is fitted on the passages of all
    documents and on all items; every passage is projected.  Whatever the number of items, one space and the words of all decide; their
    vectors are held by every task, and above ``LARGEST`` bytes of them the benchmark must
    be split.  Items without a word and null texts match nothing; equal items with several ids are
    found under each; a repeated row is found as often as it stands; rows with a null id
    are searched too, and ``text_hash`` (xxhash64) tells the texts of a repeated id
    apart; empty tables give no rows, and other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    items = benchmark.select(benchmark[item_id].cast("long").alias("item_id"), benchmark[item_text].alias("text")).where(F.col("text").isNotNull())
    known = items.distinct().orderBy("item_id", "text").collect()  # a benchmark's items, some hundred bytes each
    out = spark.createDataFrame([], FOUND)
    for words, space in _spaces(rows, [(r["item_id"], r["text"]) for r in known]):
        shared = spark.sparkContext.broadcast(space)

        def search(batches: Iterator[pd.DataFrame], shared=shared, words=words) -> Iterator[pd.DataFrame]:
            overlap = 4 * STEP + 2 * shared.value.longest
            for batch in batches:
                made = []
                for d, t, h in zip(batch["doc_id"], batch["text"], batch["text_hash"], strict=True):
                    ws, found = words_of(t), {}
                    for at in range(0, max(1, len(ws)), CHUNK):
                        for i, v in shared.value.search(ws[max(0, at - overlap) : at + CHUNK], words.value).items():
                            found[i] = max(found.get(i, (0.0, 0.0, 0.0)), v, key=lambda x: x[1])
                    made += [(d, i, *v, h) for i, v in found.items()]
                yield pd.DataFrame(made, columns=FOUND.names).astype({"doc_id": "Int64", "item_id": "Int64"})

        out = out.unionByName(rows.withColumn("text_hash", F.xxhash64("text")).mapInPandas(lean(search), FOUND))
    return out
