"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of one fixed public vocabulary.  The
probability of a word is the sum over all its segmentations into pieces, computed by
the forward algorithm; a text's is the product over its words.  Piece probabilities
are learned by expectation-maximisation: expected piece counts over all segmentations
are summed by Spark, and only the table of piece probabilities (vocabulary times
languages) returns to the driver between rounds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import lean, materialise, small_batches

UNDETERMINED = "und"
#: A letter with what follows it.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Pieces longer than this are not used; words summed at once, and places of all of them times languages.
WIDEST, AT_ONCE, CELLS = 24, 4096, 1_200_000
#: Sums below this are scaled up; over the longest piece they stay doubles then.
TINY = 1e-60
#: Languages learned at most, the most frequent ones.
LANGUAGES = 256
#: Probability of a character for which the vocabulary has no piece.
UNSEEN = 1e-6
#: Words remembered with their probabilities in each Python worker, and words handled at once.
MEMO_WORDS, CHUNK = 400_000, 200_000


def vocabulary(model_path: str) -> list[str]:
    """Pieces that stand for text: no control or byte pieces; the word mark only in front."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [p for p in map(model.id_to_piece, ids) if "▁" not in p[1:] and len(p) <= WIDEST]


def words_of(text: str | None) -> Iterator[list[str]]:
    """Lower-case words of the whole text, a bounded number at a time."""
    if not text:
        return
    low = text.lower()
    parts = iter([WORD.findall(low)]) if len(low) < 8 * CHUNK else iter(lambda m=WORD.finditer(low): [x.group() for x in islice(m, CHUNK)], [])
    for part in parts:
        if part:
            yield part


class Lattice:
    """All pieces at all places of many words at once."""

    def __init__(self, pieces: list[str]) -> None:
        self.automaton = ahocorasick.Automaton()
        for k, p in enumerate(pieces):
            self.automaton.add_word(p, k * 64 + len(p))
        self.unseen = len(pieces)
        self.automaton.make_automaton()

    def edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """(word, start, end, piece) of every match in the marked words, and a fall-back edge where a character has none."""
        words = ["▁" + w for w in words]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        hits = np.array(list(self.automaton.iter("".join(words))), dtype=np.int64).reshape(-1, 2)
        piece, size = hits[:, 1] // 64, hits[:, 1] % 64
        word = np.searchsorted(starts, hits[:, 0], side="right") - 1
        end = hits[:, 0] + 1 - starts[word]
        every = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(sizes.sum()) - starts[every]
        lone = size == 1  # a character that is a piece needs no fall-back
        known = np.zeros(len(place), bool)
        known[hits[lone, 0]] = True
        every, place = every[~known], place[~known]
        return (
            np.concatenate([word, every]),
            np.concatenate([end - size, place]),
            np.concatenate([end, place + 1]),
            np.concatenate([piece, np.full(len(every), self.unseen)]),
            sizes,
        )

    @staticmethod
    def forward(n: int, edges: tuple[np.ndarray, ...], weight: np.ndarray) -> np.ndarray:
        """Log of alpha[word, place, language]; ``weight`` has a row of probabilities for each edge.

        Sums are scaled up where they become tiny: a word's next places need no more of those
        before than the longest edge reaches, so these are scaled alike and the factor is kept
        as a log.
        Words of any length go this way.
        """
        word, start, end, _, sizes = edges
        places, languages = int(sizes.max(initial=0)) + 1, weight.shape[1]
        alpha, logs, scale = np.zeros((n, places, languages)), np.full((n, places, languages), -np.inf), np.zeros((n, languages))
        alpha[:, 0], logs[:, 0] = 1, 0
        reach = int((end - start).max(initial=1))
        order = np.lexsort((word, end))
        bounds = np.searchsorted(end[order], np.arange(places + 1))
        for e in range(1, places):
            at = order[bounds[e] : bounds[e + 1]]
            if len(at):
                w = word[at]
                first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                now, own = np.add.reduceat(alpha[w, start[at]] * weight[at], first), w[first]
                alpha[own, e], logs[own, e] = now, np.log(now) + scale[own]
                row, k = np.nonzero(now < TINY)
                if len(row):
                    factor = now[row, k]
                    alpha[own[row], max(0, e - reach) : e + 1, k] /= factor[:, None]
                    scale[own[row], k] += np.log(factor)
        return logs

    @classmethod
    def backward(cls, n: int, edges: tuple[np.ndarray, ...], weight: np.ndarray) -> np.ndarray:
        """Log of beta[word, place, language]: the forward pass over mirrored edges."""
        word, start, end, piece, sizes = edges
        mirrored = cls.forward(n, (word, sizes[word] - end, sizes[word] - start, piece, sizes), weight)
        place = sizes[:, None] - np.arange(mirrored.shape[1])
        return np.where((place >= 0)[:, :, None], np.take_along_axis(mirrored, np.maximum(place, 0)[:, :, None], 1), -np.inf)


def together(sizes: list[int], languages: int = 1) -> Iterator[slice]:
    """Runs of words to sum at once: so many, and so many places when all are as long as the longest."""
    at = longest = 0
    for i, size in enumerate(sizes):
        longest = max(longest, size + 2)
        if i > at and (i - at >= AT_ONCE or (i + 1 - at) * longest * languages > CELLS):
            yield slice(at, i)
            at, longest = i, size + 2
    if at < len(sizes):
        yield slice(at, len(sizes))


class Model:
    """Piece probabilities of each language, and the scoring of texts with them."""

    def __init__(self, pieces: list[str], languages: list[str], table: np.ndarray) -> None:
        self.pieces, self.languages, self.table = pieces, languages, table
        self.lattice: Lattice | None = None

    def __getstate__(self):
        return self.pieces, self.languages, self.table

    def __setstate__(self, state):
        self.__init__(*state)

    def _learn(self, words: list[str]) -> None:
        words = sorted(words, key=len)
        made = [self.logs]
        for part in together(list(map(len, words)), len(self.languages)):
            edges = self.lattice.edges(words[part])
            logs = self.lattice.forward(len(edges[4]), edges, self.table[edges[3]])
            made.append(logs[np.arange(len(edges[4])), edges[4]])
        base = len(self.logs)
        self.known.update({w: base + i for i, w in enumerate(words)})
        self.logs = np.concatenate(made)

    def forget(self) -> None:
        """Give the memory of words back."""
        self.known, self.logs = {}, np.zeros((0, len(self.languages)))

    def _sums(self, words: list[str], starts: list[int]) -> np.ndarray:
        """Log probabilities summed over the runs of words that begin at ``starts``."""
        asked = dict.fromkeys(words)
        new = [w for w in asked if w not in self.known]
        if new and len(self.known) + len(new) > MEMO_WORDS:
            self.known, self.logs, new = {}, np.zeros((0, len(self.languages))), list(asked)
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return np.add.reduceat(self.logs[at], starts)

    def predict(self, texts) -> tuple[list[str], list[float]]:
        """Language and its posterior probability under equal priors for each whole text."""
        if self.lattice is None:
            self.lattice, self.known, self.logs = Lattice(self.pieces), {}, np.zeros((0, len(self.languages)))
        total = np.zeros((len(texts), len(self.languages)))
        seen = np.zeros(len(texts), bool)
        words: list[str] = []
        starts: list[int] = []
        rows: list[int] = []

        def flush() -> None:
            if words and self.languages:
                np.add.at(total, rows, self._sums(words, starts))
            words.clear(), starts.clear(), rows.clear()

        for i, text in enumerate(texts):
            for part in words_of(text):
                seen[i] = True
                starts.append(len(words))
                rows.append(i)
                words.extend(part)
                if len(words) >= CHUNK:
                    flush()
        flush()
        if not self.languages or not len(texts):
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        return (
            [self.languages[b] if s else UNDETERMINED for b, s in zip(best, seen, strict=True)],
            [float(share[i, b]) if s else 0.0 for i, (b, s) in enumerate(zip(best, seen, strict=True))],
        )


def train(
    labelled: DataFrame,
    model_path: str,
    text: str = "text",
    lang: str = "lang",
    sample_key: str = "doc_id",
    rows_per_language: int = 1500,
    rounds: int = 3,
) -> Model:
    """Learn piece probabilities from whole texts with a non-null language.

    At most about ``rows_per_language`` rows of each of the ``LANGUAGES`` most frequent
    languages are used, chosen by a hash of ``sample_key``: the documented bounds of the
    training sample; words of any length teach.  Rows with a null text or language are left out, null keys draw alike, empty texts teach nothing, repeated
    rows count as often as they stand; no rows give a model without a language.  Other
    columns are not read.
    """
    small_batches(labelled.sparkSession)
    pieces = vocabulary(model_path)
    rows = labelled.select(labelled[text].alias("text"), labelled[lang].alias("lang"), labelled[sample_key].alias("key"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    languages = sorted(counts)
    if not languages:
        return Model(pieces, [], np.zeros((len(pieces) + 1, 0)))
    share = [min(1.0, rows_per_language / counts[x]) for x in languages]
    place = F.array_position(F.lit(languages), F.col("lang")).cast("int") - 1
    draw = F.pmod(F.xxhash64("key", F.lit("language sample")), F.lit(1_000_000)) / 1e6
    sample = rows.withColumn("k", place).where(F.col("k") >= 0).where(draw < F.element_at(F.lit(share), F.col("k") + 1))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, part in batch.groupby("k"):
                seen: Counter = Counter()
                for t in part["text"]:
                    for found in words_of(t):
                        seen.update(found)
                yield pd.DataFrame({"k": np.int32(k), "word": list(seen), "n": list(seen.values())})

    words = materialise(sample.select("k", "text").mapInPandas(lean(count), "k int, word string, n long").groupBy("k", "word").agg(F.sum("n").alias("n")))
    table = np.full((len(pieces) + 1, len(languages)), 1.0 / len(pieces))
    table[-1] = UNSEEN
    for _ in range(rounds):
        now = words.sparkSession.sparkContext.broadcast((pieces, table))

        def expect(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            known, prob = now.value
            lattice, total = Lattice(known), np.zeros_like(prob)
            for whole in batches:
                whole = whole.iloc[whole["word"].map(len).argsort(kind="stable")]
                for part in together(whole["word"].map(len).tolist()):
                    batch = whole.iloc[part]
                    edges = lattice.edges(batch["word"].tolist())
                    word, start, end, piece, sizes = edges
                    k = batch["k"].to_numpy()[word]
                    weight = prob[piece, k][:, None]
                    alpha, beta = lattice.forward(len(batch), edges, weight), lattice.backward(len(batch), edges, weight)
                    share = np.exp(alpha[word, start, 0] + np.log(weight[:, 0]) + beta[word, end, 0] - alpha[word, sizes[word], 0])
                    gain = batch["n"].to_numpy()[word] * share
                    np.add.at(total, (piece, k), gain)
            at, lang_at = np.nonzero(total)
            yield pd.DataFrame({"piece": at, "k": lang_at, "n": total[at, lang_at]})

        got = words.mapInPandas(lean(expect), "piece int, k int, n double").groupBy("piece", "k").agg(F.sum("n").alias("n")).toPandas()
        fresh = np.full_like(table, 0.01)
        fresh[got["piece"], got["k"]] += got["n"]
        fresh[-1] = 0
        table = fresh / fresh.sum(axis=0)
        table[-1] = UNSEEN
    return Model(pieces, languages, table)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[Column | str, ...] = ("doc_id",)) -> DataFrame:
    """Add lang_pred and score to ``keep`` for every row, from the whole text alone.

    ``und`` with score 0 for null texts, texts without a letter, and models without a
    language; equal posteriors go to the first language in order.  Repeated rows and
    rows with null ids stay, an empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, docs[text].alias("__text"))
    schema = T.StructType([*[f for f in rows.schema if f.name != "__text"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lang, score = shared.value.predict(batch["__text"].tolist())
            yield batch.drop(columns="__text").assign(lang_pred=pd.Series(lang, index=batch.index, dtype=object), score=score)
        shared.value.forget()

    return rows.mapInPandas(lean(run), schema)
