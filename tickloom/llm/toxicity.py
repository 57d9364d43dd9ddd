"""Toxicity by weak supervision.

Many voters look at a text: lexicons written by hand, lexicons of words and word beginnings
induced from a bounded labelled sample, at several strictness levels, and patterns
(one entry twice within a few words, repeated hits, hits close together, shouting, none of
any lexicon).  Each votes toxic, clean, or abstains on a bounded sample of rows whose labels
are not looked at, and on the labelled one.  A
generative label model explains these votes by a hidden class: each voter has its own
rates in either class, and depends on the one other voter it is most correlated with
there, so that the dependencies form a tree; expectation-maximisation starts from the
labelled sample, or without one from the voters' majority.  A linear classifier on lexicon
and density features is trained on the model's posterior labels alone and scores every text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import Memo, lean, small_batches

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Word beginnings of these lengths are lexicon candidates beside whole words.
STEMS = range(4, 9)
#: Words of a text handled at once.
CHUNK = 200_000
#: Lexicons dealt from the induced entries, entries in all, labelled rows used at most, and rows that are voted on.
LEXICONS, ENTRIES, LABELLED, VOTED = 12, 600, 12_000, 12_000
#: Toxic labelled texts that must hold an induced entry, and how much likelier it must be in them than in clean ones.
LEAST, LIKELIER = 3, 25
#: An entry that ends in ``+`` counts only where it stands twice within so many words.
NEAR = 100
#: Insults, each list one voter; ``*`` marks a word beginning.
WRITTEN = {
    "wit": "idiot* moron* stupid* imbecil* dumb dumbass* dimwit* halfwit* brainless dummkopf* dumm blöd* trottel* estúpid* tont* tarad* débile* abruti* crétin*",
    "worth": "loser* pathetic worthless disgusting trash scum clown garbage filth* vermin abschaum dreck* versager* widerlich* wertlos* basura escoria asqueros* patétic* inútil ordure* déchet* minable* pathétique*",
    "abuse": "bastard* bitch* asshole* jerk* creep* shithead* arschloch* wichser* miststück* hurensohn* cabrón* gilipollas* hijoputa* pendej* connard* salaud* salope* enculé*",
    "threat": "kys hate verrecke* muérete crève",
}


def terms(word: str) -> list[str]:
    """A word with its beginnings; ``*`` marks a beginning."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


def terms_of(text: str | None) -> set[str]:
    """All terms of a text, and those that stand twice within ``NEAR`` words with a ``+``."""
    last: dict[str, int] = {}
    found: set[str] = set()
    at = 0
    for part in words_of(text):
        for word in part:
            for term in terms(word):
                if at - last.get(term, -NEAR - 1) <= NEAR:
                    found.add(term + "+")
                last[term] = at
            at += 1
    return found | last.keys()


def words_of(text: str | None) -> Iterator[list[str]]:
    """Lower-case words of the whole text, a bounded number at a time."""
    if not text:
        return
    if len(text) < 4 * CHUNK:
        yield WORD.findall(text.lower())
        return
    part: list[str] = []
    for m in WORD.finditer(text):
        part.append(m.group().lower())
        if len(part) >= CHUNK:
            yield part
            part = []
    yield part


def written() -> list[str]:
    """Entries of the lexicons written by hand, in order."""
    return [e for line in WRITTEN.values() for e in line.split()]


class Lexicon:
    """Entries with a number each; a word hits every entry that it is or begins with."""

    def __init__(self, entries: list[str]) -> None:
        self.entries = entries
        self.rank: dict[str, tuple[int, ...]] = {}
        for k, e in enumerate(entries):
            self.rank[e] = (*self.rank.get(e, ()), k)
        self.hit = None

    def __getstate__(self):
        return self.entries

    def __setstate__(self, state):
        self.__init__(state)

    def _find(self, word: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """Entries that the word hits at once, and those that it hits where they stand twice."""
        own = terms(word)
        return tuple(k for t in own for k in self.rank.get(t, ())), tuple(k for t in own for k in self.rank.get(t + "+", ()))

    def measure(self, text: str | None) -> tuple[list[int], np.ndarray]:
        """Entries found, and numbers on the whole text: words, hits, closest hits, marks, length."""
        if self.hit is None:
            self.hit = Memo(self._find, 150_000)
        found: set[int] = set()
        hits: set[int] = set()  # places of words that hit an entry
        last: dict[int, int] = {}
        words = 0
        for part in words_of(text):
            for i, (once, twice) in enumerate(map(self.hit.__getitem__, part), words):
                if once:
                    found.update(once)
                    hits.add(i)
                for k in twice:
                    if k in last and i - last[k] <= NEAR:
                        found.add(k)
                        hits.update((last[k], i))
                    last[k] = i
            words += len(part)
        text = text or ""
        places = np.sort(np.fromiter(hits, np.int64, len(hits)))
        gap = int(np.diff(places).min()) if len(places) > 1 else 1 << 30
        return sorted(found), np.array([words, len(hits), gap, text.count("!!"), len(text)], float)


def votes(found: list[list[int]], numbers: np.ndarray, entries: int) -> np.ndarray:
    """One column for each voter: 1 toxic, -1 clean, 0 no vote.

    The first ``entries`` entries are induced, strongest first; those after them are written.
    """
    columns = []
    words, hits, gap = numbers[:, 0], numbers[:, 1], numbers[:, 2]
    any_hit = hits > 0
    for k in range(LEXICONS):  # each lexicon: every LEXICONS-th entry, strongest first
        columns.append(np.array([1 if any(x % LEXICONS == k for x in f if x < entries) else 0 for f in found]))
    at = entries
    for line in WRITTEN.values():
        size = len(line.split())
        columns.append(np.array([1 if any(at <= x < at + size for x in f) else 0 for f in found]))
        at += size
    for level in (0.1, 0.3, 1.0):  # the strongest entries only, then more
        own = np.array([any(x < level * entries for x in f) for f in found], bool)
        columns.append(np.where(own, 1, -1))
    for least in (2, 3, 5):
        columns.append(np.where(hits >= least, 1, np.where(any_hit, 0, -1)))
    for share in (0.002, 0.005, 0.02):
        columns.append(np.where(hits >= share * np.maximum(words, 1), np.where(any_hit, 1, -1), -1))
    columns.append(np.where(gap <= 20, 1, 0))
    columns.append(np.where((gap > 400) & (words > 400), -1, 0))
    columns.append(np.where(words < 5, np.where(any_hit, 0, -1), 0))
    columns.append(np.where(numbers[:, 3] > 0.02 * np.maximum(words, 1), np.where(any_hit, 1, 0), 0))
    return np.stack(columns, axis=1) if len(found) else np.zeros((0, LEXICONS + len(WRITTEN) + 13), int)


class LabelModel:
    """A hidden class behind all votes, with a tree of dependencies among the voters.

    p(votes | class) is the product over the voters of p(vote | class, vote of the voter's
    parent): accuracies and pairwise correlations of one generative model.  The tree joins
    the voters whose votes tell most about each other within a class.
    """

    def fit(self, v: np.ndarray, share: float, rounds: int = 15, known: tuple[np.ndarray, np.ndarray] | None = None) -> LabelModel:
        """Fit to votes; ``share`` is the class balance, ``known`` votes on a sample whose classes are known.

        Votes alone may take another hidden class for the wanted one, such as the language of
        most lexicons; the known sample says which is meant: the first round sees it alone,
        the others as so many more rows.
        """
        voters = v.shape[1]

        def kinds_of(m: np.ndarray) -> np.ndarray:
            return np.concatenate([m == x for x in (-1, 0, 1)], axis=1).astype(float)  # row, kind * voters + voter

        kinds, sure = kinds_of(v), 0.0
        self.prior = float(np.clip(share, 1e-3, 1 - 1e-3))
        p = self._majority(v, share)
        if known is not None and len(known[1]):
            told, y = kinds_of(known[0]), np.asarray(known[1], float)
            sure = np.stack([told.T @ (told * q[:, None]) for q in (1 - y, y)])
        for n in range(rounds):
            pair = sure + (np.stack([kinds.T @ (kinds * q[:, None]) for q in (1 - p, p)]) if n or isinstance(sure, float) else 0.0)
            pair = pair.reshape(2, 3, voters, 3, voters) + 0.1
            joint = pair / pair.sum(axis=(1, 3), keepdims=True)  # class, kind, voter, kind, voter
            one = joint.sum(axis=3)
            other = joint.sum(axis=1)
            told = (joint * (np.log(joint) - np.log(one[:, :, :, None, :]) - np.log(other[:, None, :, :, :]))).sum(axis=(1, 3))
            self.information = np.tensordot([1 - self.prior, self.prior], told, 1)
            self.parent = self._tree(self.information)
            self.first = np.log(joint[:, :, 0, :, 0].sum(axis=2))  # class, kind of the root
            self.table = np.stack([np.log(joint[:, :, a, :, b] / joint[:, :, a, :, b].sum(axis=2, keepdims=True)) for b, a in self.parent]) if voters > 1 else np.zeros((0, 2, 3, 3))
            p = self.posterior(v)
        return self

    @staticmethod
    def _majority(v: np.ndarray, share: float) -> np.ndarray:
        """A first posterior: the rows with the most toxic votes, as many as the class balance asks for."""
        total = v.sum(axis=1)
        limit = np.quantile(total, 1 - share) if len(total) else 0
        return np.where((total >= limit) & (total > total.min(initial=0)), 0.9, 0.05)

    @staticmethod
    def _tree(weight: np.ndarray) -> list[tuple[int, int]]:
        """(voter, parent) for all but voter 0: the spanning tree of greatest weight, from voter 0 on."""
        near = weight[0].copy()
        parent, out, edges = np.zeros(len(weight), int), np.ones(len(weight), bool), []
        out[0] = False
        while out.any():
            b = int(np.where(out, near, -np.inf).argmax())
            edges.append((b, int(parent[b])))
            out[b] = False
            closer = weight[b] > near
            parent[closer], near[closer] = b, weight[b][closer]
        return edges

    def posterior(self, v: np.ndarray) -> np.ndarray:
        k = v + 1
        logs = self.first[:, k[:, 0]] + np.log([[1 - self.prior], [self.prior]])
        for (b, a), table in zip(self.parent, self.table, strict=True):
            logs = logs + table[:, k[:, a], k[:, b]]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -30, 30)))


def features(found: list[list[int]], numbers: np.ndarray, entries: int) -> np.ndarray:
    """Classifier inputs: steps of hits and of hits for each word, entry groups, vote columns."""
    words, hits = numbers[:, 0], numbers[:, 1]
    density = hits / np.maximum(words, 1)
    steps = [hits >= x for x in (1, 2, 3, 5, 8)] + [(hits > 0) & (density >= x) for x in (0.0005, 0.001, 0.002, 0.004, 0.008, 0.016, 0.04)]
    kinds = np.array([len(set(f)) for f in found], float) if len(found) else np.zeros(0)
    plain = [np.log1p(hits), np.log1p(100 * density), np.log1p(kinds), np.log1p(words) * (hits > 0)]
    return np.concatenate([np.ones((len(hits), 1)), np.stack(steps + plain, 1).astype(float), votes(found, numbers, entries).astype(float)], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels, by Newton's steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """The lexicon and the linear classifier."""

    def __init__(self, entries: list[str], weights: np.ndarray | None, constant: float) -> None:
        self.lexicon, self.weights, self.constant, self.entries = Lexicon(entries + written()), weights, constant, len(entries)

    def forget(self) -> None:
        """Give the memory of words back."""
        self.lexicon.hit = None

    def scores(self, texts) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.constant)
        measured = [self.lexicon.measure(t) for t in texts]
        if not measured:
            return np.zeros(0)
        x = features([f for f, _ in measured], np.stack([n for _, n in measured]), self.entries)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _drawn(key: str, salt: str, share: float) -> Column:
    """Whether a row is drawn, by a hash of its key."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1_000_000)) / 1e6 < share


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", rows: int = LABELLED, entries: int = ENTRIES, voted: int = VOTED
) -> Model:
    """Fit lexicons, label model and classifier on whole texts with labels 0 and 1.

    About ``rows`` labelled rows are used at most, chosen by a hash of ``key``: the
    documented bound, which also bounds what is broadcast to find their texts.  They serve
    to induce lexicons, to tell the class balance, and to tell the label model which hidden
    class is meant.  The label model and the classifier see the votes on about ``voted`` rows
    of ``docs``, chosen by another hash, without their labels.  Equal labelled texts count once; where their labels differ the larger
    one holds.  Null texts and rows with a null key are not drawn.  Without both classes
    every score is the share of toxic rows, or 0 without labels.  Other columns are not read.
    """
    small_batches(docs.sparkSession)
    known = labels.select(labels[key].alias("key"), labels[label].cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("key").isNotNull())
    n, toxic = known.agg(F.count("*"), F.count_if(F.col("y") == 1)).first()
    if not n or toxic in (0, n):
        return Model([], None, toxic / n if n else 0.0)
    chosen = F.broadcast(known.where(_drawn("key", "toxicity sample", min(1.0, rows / n))))
    texts = docs.select(docs[key].alias("key"), docs[text].alias("text")).where(F.col("text").isNotNull() & F.col("key").isNotNull())
    sample = texts.join(chosen, "key").groupBy("text").agg(F.max("y").alias("y")).persist()
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if toxic in (0, n):
        return Model([], None, toxic / n if n else 0.0)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for t, y in zip(batch["text"], batch["y"], strict=True):
                for term in terms_of(t):
                    seen[term] += (1 << 32) if y else 1
            yield pd.DataFrame({"term": list(seen), "toxic": [v >> 32 for v in seen.values()], "clean": [v & 0xFFFFFFFF for v in seen.values()]})

    table = sample.mapInPandas(lean(count), "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    # a term must be far likelier in toxic texts; those in most of them come first
    ratio = (F.col("t") + 0.1) / toxic / ((F.col("c") + 0.3) / (n - toxic))
    best = table.where((F.col("t") >= LEAST) & (ratio > LIKELIER)).withColumn("r", F.col("t") * F.log(ratio)).orderBy(F.desc("r"), F.length("term"), "term").limit(entries).collect()
    induced = [r["term"] for r in best]
    lexicon = Lexicon(induced + written())

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            m = [lexicon.measure(t) for t in batch["text"]]
            yield pd.DataFrame({"y": batch["y"], "found": [f for f, _ in m], "numbers": [x.tolist() for _, x in m]})
        lexicon.hit = None

    def looked_at(frame: DataFrame) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
        """Entries found, numbers and class of a bounded sample."""
        got = frame.select("text", "y").mapInPandas(lean(look), "y int, found array<int>, numbers array<double>").toPandas()
        numbers = np.stack(got["numbers"].tolist()) if len(got) else np.zeros((0, 5))
        return [list(f) for f in got["found"]], numbers, got["y"].to_numpy()

    of_docs = texts.count()
    drawn = texts.where(_drawn("key", "toxicity votes", min(1.0, voted / max(of_docs, 1))))
    found, numbers, _ = looked_at(drawn.withColumn("y", F.lit(0)))
    if not len(found):
        return Model([], None, toxic / n)
    of_known, numbers_known, y = looked_at(sample)
    sample.unpersist()
    v = votes(found, numbers, len(induced))
    posterior = LabelModel().fit(v, toxic / n, known=(votes(of_known, numbers_known, len(induced)), y)).posterior(v)
    return Model(induced, logistic(features(found, numbers, len(induced)), posterior), toxic / n)


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[Column | str, ...] = ("doc_id",), threshold: float = 0.7) -> DataFrame:
    """Add score (0 to 1) and predicted (1 from ``threshold`` on) to ``keep`` for every row.

    Only the whole text decides; null counts as empty, and empty texts get the score of
    a text without hits.  Repeated rows and null ids stay, an empty table gives no rows;
    ``keep`` may be all columns, and others are not read.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = any(isinstance(k, str) and k == text for k in keep)  # then it need not travel twice
    rows, read = (docs.select(*keep), text) if kept else (docs.select(*keep, docs[text].alias("__text")), "__text")
    schema = T.StructType([*[f for f in rows.schema if f.name != "__text"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = shared.value.scores(batch[read].tolist())
            yield batch.drop(columns="__text", errors="ignore").assign(score=p, predicted=(p >= threshold).astype("int32"))
        shared.value.forget()

    return rows.mapInPandas(lean(run), schema)
