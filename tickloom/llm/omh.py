"""Near-duplicates by Order MinHash with a banded alignment of the candidates.

A text is a sequence of words (characters in scripts without spaces).  Its five-word
shingles are labelled with their occurrence number, so that labels are unique in a text.
A sketch takes the few labels that are smallest under a random order and keeps them in
text order; equal sketches make a bucket.  Texts with high edit similarity share
sketches, texts with the same shingles in another order do not.  Short texts have
sketches of two-word shingles too, because one edit breaks most of their five-word ones.

In a bucket every member is paired with two hubs (the one found in the
most and fullest buckets, and the smallest), and small buckets are paired in full, so work stays linear in a bucket's
size.  A banded alignment of the two word sequences decides.  Large buckets whose texts
this leaves in different classes are then searched exactly: texts that reach the
similarity share a word among the rarest few of each, so only texts of different classes
that share such a word are aligned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Memo, lean, materialise, small_batches
from tickloom.llm.components import components

#: Thai to Myanmar, Khmer, Kana and Han: scripts without spaces, where each character counts as a word.
SPACELESS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
SOME, UNIT, WORD = re.compile(f"[{SPACELESS}]"), re.compile(f"[{SPACELESS}]|[^\\W{SPACELESS}]+"), re.compile(r"\w+")
#: Sketches of a text, labels in a sketch, words in a shingle, least similarity.
SKETCHES, LABELS, WORDS, SIMILARITY = 20, 2, 5, 0.8
#: Texts of fewer words than this, or with such a partner, have sketches of two-word shingles too.
SHORT = 30
#: Buckets of at most so many texts are paired in full.
SMALL = 8
#: Counters that order words by frequency in the exact search; collisions only change the order.
COUNTERS = 1 << 18
#: Names of texts whose id has other texts begin here; ids lie below.
APART = 1 << 62
#: Bits of a text's parity signature in the exact search.
BITS = 1024

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_words = Memo(lambda w: xxhash.xxh3_64_intdigest(w.encode()), 100_000)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the lower-case words of a whole text, in order."""
    low = (text or "").lower()
    found = UNIT.findall(low) if SOME.search(low) else WORD.findall(low)
    return np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))


def shingle_labels(w: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Occurrence-labelled hashes of the shingles of a word sequence; a shorter one is one shingle."""
    if not len(w):
        return w
    size = min(words, len(w))
    h = np.zeros(len(w) - size + 1, np.uint64)
    for k in range(size):
        h = _mix(h + w[k : k + len(h)] + np.uint64(k + 1))
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    nth = np.arange(len(h)) - np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
    occurrence = np.empty(len(h), np.uint64)
    occurrence[order] = nth.astype(np.uint64)
    return _mix(h + occurrence * _GOLDEN)


def orders(count: int) -> np.ndarray:
    """Odd multipliers; each puts labels in a random order."""
    return _mix(np.arange(1, count + 1, dtype=np.uint64) * _GOLDEN) | np.uint64(1)


def sketches(labels: np.ndarray, odd: np.ndarray, size: int = LABELS) -> list[int]:
    """For each random order the smallest labels, in text order, hashed to one number."""
    values = labels[None, :] * odd[:, None]
    row = np.arange(len(odd))
    at = np.empty((len(odd), min(size, len(labels))), np.int64)
    for k in range(at.shape[1]):
        at[:, k] = values.argmin(axis=1)
        values[row, at[:, k]] = np.iinfo(np.uint64).max
    at.sort(axis=1)
    out = odd.copy()
    for k in range(at.shape[1]):
        out = _mix(out + labels[at[:, k]])
    return out.view(np.int64).tolist()


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Words that the best alignment of two sequences pairs, inside a band of so many places.

    Bit-parallel: a zero in ``row`` stands for one more common word up to that place of
    ``a``; only the places of ``a`` inside the band are kept, those behind it are counted.
    """
    at: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    row, low, high, passed = 0, 0, 0, 0
    for j, w in enumerate(b.tolist()):
        top = min(len(a), j + band + 1)
        if top > high:
            row |= ((1 << top - high) - 1) << high - low
            high = top
        gone = min(j - band - low, high - low)
        if gone > 0:
            passed += gone - (row & (1 << gone) - 1).bit_count()
            row >>= gone
            low += gone
        match = at.get(w)
        if match is not None:
            whole = (1 << high - low) - 1
            up = row & match >> low & whole
            row = (row + up | row - up) & whole
    return passed + high - low - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned words over all words of either text; 0 where it cannot reach ``least``."""
    n = len(a) + len(b)
    need, band = least / (1 + least) * n - 1e-9, int(n * (1 - least) / (1 + least)) + 1
    if min(len(a), len(b)) < need:
        return 0.0
    size = min(len(a), len(b))
    apart = np.flatnonzero(a[:size] != b[:size])
    head = int(apart[0]) if len(apart) else size
    apart = np.flatnonzero(a[::-1][: size - head] != b[::-1][: size - head])
    tail = int(apart[0]) if len(apart) else size - head
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    common = head + tail
    if len(x) and len(y):
        u, nu = np.unique(x, return_counts=True)
        v, nv = np.unique(y, return_counts=True)
        _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
        if common + np.minimum(nu[i], nv[j]).sum() < need:  # words in common in any order
            return 0.0
        common += aligned(x, y, band)
    return common / (n - common) if common >= need else 0.0


def _fingerprints(docs: DataFrame, count: int, size: int, words: int) -> DataFrame:
    """(doc_id, text_hash, fp, n, sigs): hash of the text, of the word sequence, words, sketches."""
    odd, other = orders(2 * count)[:count], orders(2 * count)[count:]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps, ns, sigs = [], [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                w = word_hashes(text)
                raw = w.tobytes() if len(w) else (f"null {doc_id}" if text is None else f"text {text}").encode()
                fps.append(hashlib.blake2b(raw, digest_size=16).digest())
                ns.append(len(w))
                own = sketches(shingle_labels(w, words), odd, size) if len(w) >= words else []
                if 1 < len(w) < SHORT / SIMILARITY + 1:
                    own += sketches(shingle_labels(w, 2), other, size)
                sigs.append(own)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "fp": fps, "n": ns, "sigs": sigs})
        _words.forget()

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInPandas(lean(run), "doc_id long, text_hash long, fp binary, n int, sigs array<long>")


def entries(texts: DataFrame) -> DataFrame:
    """(sig, rep, n, size, low, hub) of texts (rep, n, sigs) in every bucket that holds more than one.

    ``low`` is the bucket's text with the smallest id, ``hub`` the one in the most and
    fullest buckets, which stands nearest to the centre of a group of copies.
    """
    entry = texts.select(F.explode("sigs").alias("sig"), "rep", "n")
    held = entry.groupBy("sig").agg(F.count("*").alias("size")).where("size > 1")
    entry = materialise(entry.join(held, "sig"))
    fame = entry.groupBy("rep").agg(F.sum("size").alias("fame"))
    first = F.struct((-F.col("fame")).alias("f"), "rep", "n")
    bucket = entry.join(fame, "rep").groupBy("sig").agg(F.min(F.struct("rep", "n")).alias("low"), F.min(first).alias("hub"))
    return materialise(entry.join(bucket, "sig"))


def candidate_pairs(entry: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Distinct pairs a < b of texts that share a bucket and could be similar: with two hubs, or all of few."""
    one, other = F.struct("rep", "n").alias("one"), F.explode(F.array("low", F.struct("hub.rep", "hub.n"))).alias("other")
    pair = entry.select(one, other)
    few = entry.where((F.col("size") <= SMALL) & (F.col("size") > 2)).groupBy("sig").agg(F.collect_list(F.struct("rep", "n")).alias("all"))
    pair = pair.union(few.select("all", F.explode("all").alias("one")).select("one", F.explode("all").alias("other")))
    close = F.least("one.n", "other.n") >= F.greatest("one.n", "other.n") * F.lit(least - 1e-9)
    ends = pair.where((F.col("one.rep") != F.col("other.rep")) & close).select(F.least("one.rep", "other.rep").alias("a"), F.greatest("one.rep", "other.rep").alias("b"))
    return ends.distinct()


def remaining_pairs(entry: DataFrame, linked: DataFrame, docs: DataFrame, least: float = SIMILARITY) -> DataFrame | None:
    """The pairs that ``candidate_pairs`` left out and that could still join two components.

    Texts of large buckets that hold several components take part, with their words,
    labelled by occurrence, in order of frequency among them.  Similar texts of n words
    together have least / (1 + least) * n in common, so at the first of these in that
    order both must have as many words left.  In each word's group all but the largest
    component are paired with the members of other components.  Each text also has the
    parities of how many of its words fall on each of ``BITS`` places: where two texts'
    parities differ, at least one word is not common, so pairs with too many such places
    are left out.  None if no text is left.
    """
    part = entry.where(F.col("size") > SMALL).join(linked, F.col("rep") == F.col("node"), "left").select("sig", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = part.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    left = materialise(part.join(mixed, "sig", "left_semi").select("rep", "component").distinct())
    if left.isEmpty():
        return None

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"rep": batch["doc_id"], "component": batch["component"], "words": [shingle_labels(word_hashes(t), 1).tobytes() for t in batch["text"]]})
        _words.forget()

    asked = docs.join(left.withColumnRenamed("rep", "doc_id"), "doc_id").select("doc_id", "component", "text")
    held = materialise(asked.mapInPandas(lean(label), "rep long, component long, words binary").dropDuplicates(["rep"]))

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for w in batch["words"]:
                np.add.at(seen, (np.frombuffer(w, np.uint64) % np.uint64(COUNTERS)).astype(np.int64), 1)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"at": at, "n": seen[at]})

    texts = np.zeros(COUNTERS, np.int64)
    for r in held.mapInPandas(tally, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():
        texts[r["at"]] = r["n"]
    shared, share = held.sparkSession.sparkContext.broadcast(texts), least / (1 + least)

    def lead(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = shared.value
        for batch in batches:
            rows = []
            for rep, component, raw in zip(batch["rep"], batch["component"], batch["words"], strict=True):
                w = np.frombuffer(raw, np.uint64)
                times = often[(w % np.uint64(COUNTERS)).astype(np.int64)]
                order = np.lexsort((w, times))
                after = len(w) - np.arange(len(w))  # a word and those behind it
                keep = (after >= share * len(w) * (1 + least) - 1e-6) & (times[order] > 1)
                if not keep.any():
                    continue
                odd = np.packbits(np.bincount((w >> np.uint64(20)) % np.uint64(BITS), minlength=BITS) & 1 == 1).view(np.int64)
                rows.append(pd.DataFrame({"label": w[order][keep].view(np.int64), "rep": rep, "n": len(w), "component": component, "after": after[keep], "odd": pd.Series([odd] * int(keep.sum()), dtype=object)}))
            if rows:
                yield pd.concat(rows)

    first = materialise(held.mapInPandas(lead, "label long, rep long, n int, component long, after int, odd array<long>"))
    sizes = first.groupBy("label", "component").agg(F.count("*").alias("members"))
    largest = sizes.groupBy("label").agg(F.max_by("component", "members").alias("largest"), F.count("*").alias("components")).where("components > 1")
    # of each word's texts, those outside its largest component look for partners among all
    other = largest.select(F.col("label").alias("l"), "largest")
    one = first.join(other, (F.col("label") == F.col("l")) & (F.col("component") != F.col("largest")))
    one = one.select("label", F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("component").alias("cx"), F.col("after").alias("ax"), F.col("odd").alias("ox"))
    apart = F.aggregate(F.zip_with("odd", "ox", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    could = (apart <= (F.col("n") + F.col("nx")) * F.lit(1 - 2 * share) + 1e-6) & (F.least("after", "ax") >= (F.col("n") + F.col("nx")) * F.lit(share) - 1e-6) & (F.least("n", "nx") >= F.greatest("n", "nx") * F.lit(least - 1e-9))
    pair = one.join(first, "label").where((F.col("cx") != F.col("component")) & could)
    return pair.select(F.least("x", "rep").alias("a"), F.greatest("x", "rep").alias("b")).distinct()


#: Bytes of a word's hash that travel for the alignment.
KEPT = 6


def verified(pairs: DataFrame, docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs whose whole texts align to at least ``least``: a, b, similarity."""

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"rep": batch["doc_id"], "words": [word_hashes(t).view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes() for t in batch["text"]]})
        _words.forget()

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    words = materialise(docs.join(wanted, "doc_id", "left_semi").select("doc_id", "text").mapInPandas(lean(label), "rep long, words binary"))

    def back(raw: bytes) -> np.ndarray:
        whole = np.zeros((len(raw) // KEPT, 8), np.uint8)
        whole[:, :KEPT] = np.frombuffer(raw, np.uint8).reshape(-1, KEPT)
        return whole.view(np.uint64).ravel()

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            value = [similarity(back(x), back(y), least) for x, y in zip(batch["la"], batch["lb"], strict=True)]
            out = pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": value})
            yield out[out["similarity"] >= least]

    sides = pairs.join(words.select(F.col("rep").alias("a"), F.col("words").alias("la")), "a").join(words.select(F.col("rep").alias("b"), F.col("words").alias("lb")), "b")
    return sides.select("a", "b", "la", "lb").mapInPandas(lean(align), "a long, b long, similarity double")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY, count: int = SKETCHES, size: int = LABELS, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, class_id) of every row: the smallest id among all texts that links connect.

    Two texts are linked if the words that an alignment pairs are at least ``least`` of all
    words of either.  Texts with the same words in the same order are one class without
    comparing them; texts without a word are compared as they are; a null text is like no
    other.  A row with a null id has a null class and takes no part.  Repeated rows stay.
    Where an id repeats with another text, each row has its own text's class and
    ``text_hash`` (xxhash64) tells them apart.  An empty table gives no rows, and other
    columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    named = rows.where(F.col("doc_id").isNotNull())
    prints = materialise(_fingerprints(named, count, size, words))
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    texts = prints.groupBy("fp").agg(first, F.first("n").alias("n"), F.first("sigs").alias("sigs"))
    several = prints.groupBy("doc_id").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high")).where("low < high")
    several = materialise(several.select("doc_id"))
    repeats = not several.isEmpty()
    if repeats:  # a text of an id that has others goes by a name of its own, above all ids
        odd = several.select(F.col("doc_id").alias("__odd"))
        own = F.xxhash64("fp").bitwiseAND(F.lit(APART - 1)).bitwiseOR(F.lit(APART))
        texts = texts.join(odd, F.col("first.doc_id") == F.col("__odd"), "left").withColumn("rep", F.when(F.col("__odd").isNull(), F.col("first.doc_id")).otherwise(own)).drop("__odd")
        texts = materialise(texts)
        of = texts.select("rep", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"))
        named = named.withColumn("text_hash", F.xxhash64("text")).join(of, ["doc_id", "text_hash"]).select(F.col("rep").alias("doc_id"), "text")
    else:
        texts = materialise(texts.withColumn("rep", F.col("first.doc_id")))
    entry = entries(texts)
    links = materialise(verified(materialise(candidate_pairs(entry, least)), named, least).select("a", "b"))
    joined = components(links)
    rest = remaining_pairs(entry, joined, named, least)
    if rest is not None:
        more = materialise(verified(materialise(rest), named, least).select("a", "b"))
        if not more.isEmpty():
            joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    of_text = texts.join(joined, texts["rep"] == joined["node"], "left").select("fp", F.col("first.doc_id").alias("least"), F.coalesce("component", "rep").alias("class_id"))
    if repeats:
        named_by = of_text.groupBy("class_id").agg(F.min("least").alias("id"))
        of_text = of_text.join(named_by, "class_id").select("fp", F.col("id").alias("class_id"))
    of_text = of_text.select("fp", "class_id")
    classes = prints.select("doc_id", "text_hash", "fp").join(of_text, "fp").select("doc_id", "text_hash", "class_id")
    none = F.lit(None).cast("long")
    return classes.unionByName(rows.where(F.col("doc_id").isNull()).select("doc_id", F.xxhash64("text").alias("text_hash"), none.alias("class_id")))
