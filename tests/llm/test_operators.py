"""The training-data operators against brute force, round trips and held-out accuracy."""

import base64
import hashlib
import os
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.oracle import same
from tickloom.llm import bpe, chat, components, decontam, langid, omh, queries, suffix, tokcount, topk, toxicity, urlrules

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(bpe.rank_file(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), SF, queries.ORACLE_SQL[name])


# 4


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab the'sé漢😀ß \n\t\x00!=1I "), max_size=40) | st.text(max_size=30))
def test_bpe_is_exact(codec, reference, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = codec.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert codec.decode(ids).decode() == text


def test_bpe_of_very_long_pieces(codec, reference):
    for text in ("a" * 30_000, "the" * 9000, " " * 5000, "x y " * 60_000):
        assert codec.encode(text) == reference.encode_ordinary(text)


def test_bpe_query(spark, reference):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op4_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# 8


def brute_removal(docs):
    first = {}
    for i, b in sorted(docs):
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    out = {}
    for i, b in docs:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        out[i] = bytes(x for x, g in zip(b, gone, strict=False) if not g), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
    return out


def test_suffix_query(spark):
    docs = [(r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    wanted = brute_removal(docs)
    for r in queries.op8_suffix_dedup(spark, SF).collect():
        kept, runs = wanted[r.doc_id]
        assert (r.n_spans, r.kept_sha256, r.n_bytes - r.n_removed) == (runs, hashlib.sha256(kept).hexdigest(), len(kept))


def test_suffix_on_hard_texts(spark, monkeypatch):
    rnd = random.Random(3)
    passage = "".join(rnd.choice("abcdeé ") for _ in range(70))
    texts = ["ab" * 90, "ab" * 70 + "c", "x" * 49, "x" * 50, "x" * 51, passage, "q" + passage, passage[:49], passage[3:55] + passage[5:60], None, ""]
    texts += ["".join(rnd.choice("ab") for _ in range(30)) + passage[rnd.randint(0, 15) :] for _ in range(30)]
    texts += ["".join(rnd.choice("xyz ") for _ in range(700)) + passage + "z" * 600]
    monkeypatch.setattr(suffix, "BLOCK", 256)  # long texts are cut into segments
    rows = [(i, t) for i, t in enumerate(texts)]
    wanted = brute_removal([(i, (t or "").encode()) for i, t in rows])
    got = suffix.strip_repeats(spark.createDataFrame(rows, "doc_id long, text string"), ("kept", "n_spans")).collect()
    assert {r.doc_id: (bytes(r.kept), r.n_spans) for r in got} == wanted


@pytest.mark.parametrize("hot", [5, 1 << 15])
def test_suffix_of_a_passage_that_all_hold(spark, monkeypatch, hot):
    rnd = random.Random(4)
    made = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    line, passage = made(60), made(400)
    rows = [(i, f"{made(80)}{line}{made(80)}{passage}{made(60)}") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    monkeypatch.setattr(suffix, "HOT", hot, raising=False)
    got = suffix.strip_repeats(frame, ("kept", "n_spans")).collect()
    assert {r.doc_id: (bytes(r.kept), r.n_spans) for r in got} == brute_removal([(i, t.encode()) for i, t in rows])
    pieces = suffix._cut(frame.withColumn("nth", F.lit(0)), suffix._shared_minimizers(frame, 16), 16, 1 << 16).where("deal >= 0").collect()
    sizes = {}
    for r in pieces:
        sizes[r.deal] = sizes.get(r.deal, 0) + len(suffix._unpack(r.owners))
    # of equal pieces only a batch's smallest document's travel; a hot minimizer's windows spread too
    assert sum(n >= 150 for n in sizes.values()) <= (0 if hot == 5 else 6)


@pytest.mark.parametrize("rows", [7, 64, 1 << 16])
def test_columns_sort_suffixes(rows):
    rng = np.random.default_rng(1)
    matrix = rng.integers(97, 100, (60, suffix.COLUMNS), dtype=np.uint8)
    matrix[30:45, 20:] = matrix[0, 20:]
    for c, order, common in suffix.insert_columns(matrix.copy(), rows):
        tails = [matrix[i, c:].tobytes() for i in order]
        assert tails == sorted(tails)
        for k in range(1, len(order)):
            shared = next((n for n, (a, b) in enumerate(zip(tails[k - 1], tails[k], strict=True)) if a != b), len(tails[k]))
            assert common[k] == min(shared, suffix.LENGTH)


def test_suffix_where_ids_repeat(spark):
    """Rows of one id do not shorten each other, and each keeps what only its own text has."""
    rnd = random.Random(8)
    made = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    a, b = made(200), made(200)
    rows = [(1, a + b), (2, b + made(100)), (2, made(300)), (2, made(20) + a), (3, a + b), (3, made(80)), (3, made(80) + b), (3, made(80) + b)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text, bytes(r.kept)) for r in suffix.strip_repeats(frame, ("kept",), keep=("doc_id", "text")).collect())
    first = {}
    for i, t in rows:
        for k in range(len(t) - 49):
            first[t[k : k + 50]] = min(first.get(t[k : k + 50], i), i)
    wanted = []
    for i, t in rows:
        gone = [False] * len(t)
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < i:
                gone[k : k + 50] = [True] * 50
        wanted.append((i, t, "".join(x for x, g in zip(t, gone, strict=True) if not g).encode()))
    assert got == sorted(wanted)


# 2


def _classes(texts, least=omh.SIMILARITY):
    """All pairs of texts, aligned by the textbook table."""
    words = [omh.UNIT.findall(t.lower()) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            a, b = words[i], words[j]
            if min(len(a), len(b)) < least * max(len(a), len(b)) or len(set(a) & set(b)) < 0.3 * len(set(a)):
                continue
            row = [0] * (len(b) + 1)
            for x in a:
                before = row
                row = [0]
                for k, y in enumerate(b):
                    row.append(before[k] + 1 if x == y else max(before[k + 1], row[-1]))
            if row[-1] >= least * (len(a) + len(b) - row[-1]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in range(len(texts))}


def test_order_minhash_finds_edited_copies(spark):
    """At 2 to 10 % of words replaced, at least 0.9 of each kind of copies is linked."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    base = [[word() for _ in range(n)] for n in (30, 60, 120, 200, 300) for _ in range(10)]
    texts, kind = [" ".join(b) for b in base], {}
    for i, b in enumerate(base):
        for share in (0.02, 0.04, 0.06, 0.08, 0.1):
            c = list(b)
            for k in rnd.sample(range(len(b)), round(share * len(b))):
                c[k] = word()
            kind[len(texts)] = share, i
            texts.append(" ".join(c))
        texts.append(" ".join(b[len(b) // 2 :] + b[: len(b) // 2]))  # the same words in another order
        texts.append(" ".join(b).upper())
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for share in (0.02, 0.04, 0.06, 0.08, 0.1):
        copies = [(d, i) for d, (s, i) in kind.items() if s == share]
        assert sum(got[d] == got[i] for d, i in copies) >= 0.9 * len(copies), share
    wanted = _classes(texts)
    assert all(wanted[d] == c or got[d] == d for d, c in got.items())  # no link too many
    assert sum(wanted[d] == c for d, c in got.items()) >= 0.98 * len(got)


def test_texts_without_spaces_are_compared_by_characters(spark):
    rnd = random.Random(9)
    text = "".join(chr(rnd.randrange(0x4E00, 0x5E00)) for _ in range(1000))
    rows = [(1, text), (2, text[:500] + "字" + text[500:]), (3, text[500:] + text[:500])]
    got = omh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 2: 1, 3: 3}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
def test_alignment_is_the_longest_common_subsequence(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    x, y = np.asarray(a, np.uint64), np.asarray(b, np.uint64)
    best = int(table[-1, -1])
    assert omh.aligned(x, y, 20) == best
    if a or b:
        share = best / (len(a) + len(b) - best)
        assert omh.similarity(x, y, 0.5) == pytest.approx(share if share >= 0.5 else 0)


def test_near_duplicate_query(spark):
    """The registered query against all pairs; sketches may miss a few links, never add one."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r.class_id for r in queries.op2_order_minhash(spark, SF).collect()}
    ids = sorted(texts)
    wanted = {ids[k]: ids[c] for k, c in _classes([texts[i] for i in ids]).items()}
    assert got.keys() == wanted.keys() and all(got[d] in (d, c) for d, c in wanted.items())
    assert sum(got[d] == c for d, c in wanted.items()) >= 0.98 * len(wanted)


def test_large_buckets_lose_no_link(spark, monkeypatch):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    shared = [word() for _ in range(120)]
    odd = omh._mix(np.arange(1, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    sketch = lambda t: omh.sketches(omh.shingle_labels(omh.word_hashes(t)), odd, 1)[0]
    made = [" ".join(shared + [word() for _ in range(80)]) for _ in range(90)]
    names = [sketch(t) for t in made]
    most = max(set(names), key=names.count)
    texts = [t for t in made if sketch(t) == most][:30]
    pairs = {20: texts[20].rsplit(" ", 6)[0], 25: texts[25].rsplit(" ", 9)[0], 3: texts[3].rsplit(" ", 4)[0]}
    assert len(texts) == 30 and all(sketch(t) == most for t in pairs.values())  # one bucket holds them all
    rows = list(enumerate(texts)) + [(100 + i, t) for i, t in pairs.items()]
    monkeypatch.setattr(omh, "SMALL", 2)
    got = omh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), count=1, size=1).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i % 100 for i, _ in rows}


def test_similarity_is_the_aligned_share():
    a = np.arange(100, dtype=np.uint32)
    assert omh.similarity(a, a) == 1
    assert omh.similarity(a, np.delete(a, [5, 50])) == pytest.approx(0.98)
    assert omh.similarity(a, a[::-1].copy()) == 0 or omh.similarity(a, a[::-1].copy()) < 0.1
    assert omh.similarity(a, np.concatenate([a[50:], a[:50]])) < 0.5


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 51), (51, 52), (60, 50), (70, 71)]
    rnd = random.Random(1)
    rnd.shuffle(edges)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 50: 50, 51: 50, 52: 50, 60: 50, 70: 70, 71: 70}


# 1


def test_decontamination_query(spark):
    items = {r.item_id: decontam.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    truth = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        joined = " " + " ".join(decontam.words_of(r.text)) + " "
        truth |= {(r.doc_id, i) for i, ws in items.items() if " " + " ".join(ws) + " " in joined}
    found = {(r.doc_id, r.item_id) for r in queries.op1_decontaminate(spark, SF).collect()}
    assert truth and truth <= found and len(found - truth) <= max(2, len(truth) // 10)


def test_paraphrase_needs_the_answer(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(7))
    question, answer = [word() for _ in range(20)], [word() for _ in range(6)]
    item = " ".join(question) + ". " + " ".join(answer) + "."
    close = [w if k % 3 else word() for k, w in enumerate(question)]
    noise = [" ".join(word() for _ in range(80)) for _ in range(30)]
    docs = [*noise, noise[0] + " " + " ".join(close) + ". " + " ".join(answer) + ". " + noise[1], noise[2] + " " + " ".join(close) + ". " + noise[3], noise[4] + item + noise[5]]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = decontam.contaminated(frame, spark.createDataFrame([(7, item), (8, None)], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(30, 7), (32, 7)}


def test_items_of_all_lengths_follow_one_rule(spark):
    """Exhaustive subsequences over whole texts agree with the search, for copies, cut copies and paraphrases."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(7))
    items = {k: [word() for _ in range(n)] for k, n in enumerate([6, 12, 25, 48, 70, 90, 97, 150, 300])}
    texts, wanted = [], set()
    noise = lambda: [word() for _ in range(60)]
    for k, item in items.items():
        for share in (1.0, 0.9, 0.6, 0.4):
            held = item[: round(share * len(item))]
            if share >= decontam.VERBATIM:
                wanted.add((len(texts), k))
            texts.append(" ".join([*noise(), *held, *noise()]))
        if len(item) > 10:
            loose = [w if i % 9 else word() for i, w in enumerate(item)]
            wanted.add((len(texts), k))
            texts.append(" ".join([*noise(), *loose, *noise()]))
    bench = spark.createDataFrame([(k, " ".join(ws)) for k, ws in items.items()], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bench).collect()}
    assert found == wanted


def test_items_in_other_scripts_and_quotes(spark):
    rnd = random.Random(13)
    han = "".join(chr(rnd.randrange(0x4E00, 0x5E00)) for _ in range(60))
    rows = [(1, "前書き。" + han + "。後書き"), (2, "He said “seven purple elephants danced quietly” before noon and left the old town"), (3, han[:20])]
    bench = [(1, han), (2, 'he said "seven purple elephants danced quietly" before noon')]
    found = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 2)}


def test_tasks_make_the_products_of_items(spark, monkeypatch):
    """The driver makes none: with many items they would fill its memory.  Added up they are A'A."""
    rows = [([0, 2, 5], [0.6, 0.0, 0.8]), ([2, 5], [0.6, -0.8]), ([1], [1.0])]
    a = np.zeros((3, 6))
    for k, (at, value) in enumerate(rows):
        a[k, at] = value
    got = np.zeros(36)
    for r in decontam.gram(decontam._of_items(spark, rows, 3.0, 6), 6).collect():
        got[np.frombuffer(r["key"], np.int64)] += np.frombuffer(r["value"])
    assert np.allclose(got.reshape(6, 6), np.triu(9 * a.T @ a))

    driver, made = os.getpid(), decontam.products

    def in_tasks(*args):
        assert os.getpid() != driver, "the driver makes products"
        return made(*args)

    documents = spark.createDataFrame([(1, "a tall ship and a star to steer her by"), (2, "something else altogether")], "doc_id long, text string")
    monkeypatch.setattr(decontam, "products", in_tasks)
    assert len(list(decontam._spaces(documents, [(1, "a tall ship and a star")]))) == 1


def test_many_items_share_one_space(spark, monkeypatch):
    """More items than dimensions, in blocks: copies and paraphrases are found, others are not."""
    rnd = random.Random(14)
    word = lambda: rnd.choice("abcdefghijklmnop") + str(rnd.randrange(3000))
    items = [[word() for _ in range(rnd.randint(15, 40))] for _ in range(300)]
    texts, wanted = [], set()
    for k in range(0, 300, 4):
        copy = list(items[k])
        for i in rnd.sample(range(len(copy)), len(copy) // 8):
            copy[i] = word()
        wanted.add((len(texts), k))
        texts.append(" ".join([word() for _ in range(50)] + (copy if k % 8 else items[k]) + [word() for _ in range(50)]))
        texts.append(" ".join(word() for _ in range(150)))
    bench = spark.createDataFrame([(k, " ".join(ws)) for k, ws in enumerate(items)], "item_id long, text string")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {(r.doc_id, r.item_id): (r.cosine, r.common, r.answer) for r in decontam.contaminated(frame, bench).collect()}
    monkeypatch.setattr(decontam, "ITEMS", 150)
    found = {(r.doc_id, r.item_id): (r.cosine, r.common, r.answer) for r in decontam.contaminated(frame, bench).collect()}
    assert found.keys() <= wanted and len(found) >= 0.97 * len(wanted)
    assert found.keys() == whole.keys() and all(found[k] == pytest.approx(whole[k], abs=1e-4) for k in found)
    monkeypatch.setattr(decontam, "LARGEST", 10)
    with pytest.raises(ValueError):
        decontam.Words({"a": 0, "b": 1}, np.ones(2), np.ones((2, 2)))


class Counted:
    """Word vectors that tell how many words were looked up."""

    def __init__(self, weighted):
        self.weighted, self.shape, self.looked_up = weighted, weighted.shape, 0

    def __getitem__(self, ids):
        self.looked_up += len(ids)
        return self.weighted[ids]


def test_only_passages_that_can_reach_an_item_are_projected(spark):
    """Single words of an item far apart cannot; no passage that comes near any part is left out."""
    rnd = random.Random(8)
    items = [(k, " ".join(f"w{rnd.randrange(400)}" for _ in range(rnd.randint(12, 70)))) for k in range(40)]
    loose = [" ".join(f"w{rnd.randrange(400)}" if i % 48 == 0 else f"x{i}" for i in range(960)) for _ in range(5)]
    mixed = [" ".join(rnd.choice([f"w{rnd.randrange(400)}", "x"]) for _ in range(rnd.randint(1, 300))) for _ in range(60)]
    copies = [f"{loose[0]} {text} {loose[1]}" for _, text in items]
    documents = spark.createDataFrame(list(enumerate(loose + mixed + copies)), "doc_id long, text string")
    words, space = next(decontam._spaces(documents, items))
    known, whole = words.value, decontam.WORD.findall
    weighted = known.weighted
    known.weighted = Counted(weighted)
    assert not any(space.search(whole(t), known) for t in loose) and known.weighted.looked_up == 0
    assert all(k in space.search(whole(t), known) for k, t in enumerate(copies)) and known.weighted.looked_up > 0
    for t in mixed + copies:
        for start in range(0, len(whole(t)), decontam.STEP):
            ids = [known.vocabulary[w] for w in whole(t)[start : start + 2 * decontam.STEP] if w in known.vocabulary]
            along = (weighted[ids].sum(0) @ space.latent.T / space.norms).max() if ids else 0.0
            assert space.most[ids].sum() >= along - 1e-4
    unheld = decontam.Space(space.items, space.of, np.zeros_like(space.latent), np.zeros_like(space.norms), weighted)
    assert np.isinf(unheld.most).all()


def test_paraphrases_are_recalled(spark):
    """Of items planted with a third of their words replaced, but for their answer, nine of ten are found, and of copies all."""
    rnd = random.Random(21)
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 600").orderBy("doc_id").limit(60).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").orderBy("item_id").collect() if len(decontam.words_of(r.text)) >= 15][:20]
    fillers = sorted({w for t in docs for w in t.split()})[:2000]
    rows, planted = [], []
    for k, (item, text) in enumerate(items * 2):
        head, answer = text.split(), decontam.answer_of(text)
        if k >= len(items):
            for i in rnd.sample(range(max(0, len(head) - len(answer))), int(0.33 * max(0, len(head) - len(answer)))):
                head[i] = rnd.choice(fillers)
        base = docs[k % len(docs)].split()
        cut = len(base) // 2
        rows.append((k, " ".join([*base[:cut], *head, *base[cut:]])))
        planted.append((k, item))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert all(p in found for p in planted[: len(items)])
    assert sum(p in found for p in planted[len(items) :]) >= 0.9 * len(items)


def test_space_is_fitted_on_all_passages(spark):
    """A'A of the passages of every document; 4,500 documents, more than were once drawn."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 90, n)) for n in rng.integers(0, 200, 4500)] + [None, ""]
    vocabulary = {f"w{k}": k for k in range(80)}
    counts = decontam.counted(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), vocabulary)
    n, df = decontam.document_frequencies(counts, 80)
    assert n == len(texts) and df.tolist() == [sum(w in decontam.words_of(t) for t in texts) for w in vocabulary]
    idf = rng.random(80)
    wanted = np.zeros((80, 80))
    for t in texts:
        words = decontam.words_of(t)
        for k in range(0, len(words), 2 * decontam.STEP):
            tf = np.bincount([vocabulary[w] for w in words[k : k + 2 * decontam.STEP] if w in vocabulary], minlength=80)
            if (tf > 0).sum() >= 2:
                v = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0) * idf
                wanted += np.outer(v, v) / (v @ v)
    got = np.zeros((80, 80))
    matrix = decontam.gram(decontam._of_passages(counts, idf), 80)
    for r in matrix.collect():
        key = np.frombuffer(r.key, np.int64)
        got[key // 80, key % 80] += np.frombuffer(r.value)
    np.testing.assert_allclose(got, np.triu(wanted), rtol=1e-9, atol=1e-12)
    basis = decontam.latent_space(matrix, 80, 5)
    best = np.linalg.eigh(wanted)[1][:, ::-1][:, :1]
    assert abs(best[:, 0] @ basis[:, 0]) > 0.999


def test_subsequence():
    assert decontam.common_subsequence("a b c d".split(), "x a y c d b".split()) == 3
    assert decontam.common_subsequence("a a b".split(), "a b a".split()) == 2


# 3, 6


def test_language_is_learned(spark):
    rows = queries.op3_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 200 and held and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_forward_sums_all_segmentations():
    lattice = langid.Lattice(["▁a", "a", "b", "▁ab", "ab"])
    table = np.array([0.1, 0.2, 0.3, 0.05, 0.07, 1e-6])[:, None]
    edges = lattice.edges(["ab", "bab"])
    alpha = np.exp(lattice.forward(2, edges, table[edges[3]])[:, :, 0])
    beta = np.exp(lattice.backward(2, edges, table[edges[3]])[:, :, 0])
    unseen = 1e-6  # the word mark alone is no piece here
    first = 0.1 * 0.3 + 0.05 + unseen * (0.07 + 0.2 * 0.3)
    second = unseen * 0.3 * (0.07 + 0.2 * 0.3)
    assert alpha[0, 3] == pytest.approx(first) and alpha[1, 4] == pytest.approx(second)
    assert beta[:, 0] == pytest.approx([first, second])


def _sum_of_segmentations(lattice_pieces, word, row):
    """Log of the summed probability of all segmentations, by the plain recurrence over logs."""
    marked, logs = "▁" + word, [0.0]
    for e in range(1, len(marked) + 1):
        terms = [logs[s] + np.log(row[lattice_pieces[marked[s:e]]]) for s in range(max(0, e - 63), e) if marked[s:e] in lattice_pieces]
        if marked[e - 1] not in lattice_pieces:
            terms.append(logs[e - 1] + np.log(langid.UNSEEN))
        logs.append(np.logaddexp.reduce(terms))
    return logs[-1]


def test_long_words_teach(spark):
    """A language of words of over 64 characters of a script without spaces is learned."""
    rnd = random.Random(8)
    word = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    rows = [(i, word("漢字語文書体会社時間", 90), "zh") for i in range(40)] + [(100 + i, word("かなきくけこさしすせそ", 90), "ja") for i in range(40)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES)
    lang, score = model.predict([word("漢字語文書体", 80), word("かなきくけこ", 80)])
    assert lang == ["zh", "ja"] and min(score) > 0.99


def test_runs_of_words_cover_all(monkeypatch):
    monkeypatch.setattr(langid, "AT_ONCE", 3)
    monkeypatch.setattr(langid, "CELLS", 40)
    for sizes in ([], [1], [1] * 7, [1, 2, 100, 3, 3, 3, 50]):
        runs = list(langid.together(sizes))
        assert [i for r in runs for i in range(r.start, r.stop)] == list(range(len(sizes)))


def test_language_query_equals_brute_force(spark):
    """Predictions and scores of the registered model's kind, word by word from the plain recurrence; long words too."""
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(frame, PIECES, rows_per_language=20)
    pieces = {p: k for k, p in enumerate(model.pieces)}
    rnd = random.Random(6)
    texts = [r.text[:400] for r in frame.orderBy("doc_id").limit(12).collect()]
    texts += ["".join(rnd.choice("abcdefghiéñß漢") for _ in range(n)) for n in (40, 65, 300, 1500)]
    # letters outside the vocabulary, at lengths where plain sums leave the doubles; a Latin word between them decides
    texts += ["".join(rnd.choice(letters) for _ in range(n)) for letters in ("漢字語文書体", "かなきくけこ", "ابتثجحخد", "ሀለሐመሠረ") for n in (45, 50, 58, 64, 65, 400)]
    texts += ["漢" * 60 + " und der die", "ሀ" * 50]
    texts += ["das ist " + "x" * 900, "123", "", None]
    lang, score = model.predict(texts)
    for text, got, p in zip(texts, lang, score, strict=True):
        words = langid.WORD.findall((text or "").lower())
        total = np.array([sum(_sum_of_segmentations(pieces, w, model.table[:, k]) for w in words) for k in range(len(model.languages))])
        if not words:
            assert (got, p) == ("und", 0.0)
            continue
        share = np.exp(total - np.logaddexp.reduce(total))
        assert 0 <= p <= 1
        assert p == pytest.approx(share.max(), abs=1e-6) and share[model.languages.index(got)] == pytest.approx(share.max(), abs=1e-6)


def test_toxicity_is_learned_and_clean_texts_stay(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(3, 7)))
    bad = [f"zork{word()}" for _ in range(40)] + ["grumph", "blag"]
    rows = []
    for i in range(900):
        toxic = int(i % 6 == 0)
        words = [word() for _ in range(80)]
        if toxic:
            for _ in range(6):
                words[rnd.randrange(80)] = rnd.choice(bad)
        rows.append((i, " ".join(words), toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(frame.select("doc_id", "text"), frame.where("doc_id < 600").select("doc_id", "toxic"))
    got = toxicity.score(frame, model, keep=("doc_id", "toxic")).where("doc_id >= 600").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_label_model_knows_copies():
    """Copies of one voter hang together in the tree and do not outvote the others."""
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    voters = np.stack([np.where(rng.random(4000) < a, np.where(y, 1, -1), np.where(y, -1, 1)) for a in (0.9, 0.85, 0.8, 0.75)], 1)
    copies = np.concatenate([voters, voters[:, 3:], voters[:, 3:]], 1)
    model = toxicity.LabelModel().fit(copies, 0.3)
    assert len({frozenset(e) for e in model.parent} & {frozenset((a, b)) for a in (3, 4, 5) for b in (3, 4, 5) if a < b}) == 2
    assert ((model.posterior(copies) > 0.5) == y).mean() > 0.88
    assert ((model.posterior(copies) > 0.5) == y).mean() > (np.where(copies.sum(1) > 0, 1, 0) == y).mean()  # the plain majority


def test_label_model_equals_brute_force():
    """The posterior is Bayes' rule over the tree, voter by voter."""
    rng = np.random.default_rng(3)
    v = rng.integers(-1, 2, (300, 5))
    v[:, 4] = np.where(rng.random(300) < 0.8, v[:, 1], v[:, 4])
    model = toxicity.LabelModel().fit(v, 0.4, rounds=3)
    got = model.posterior(v)
    for row, p in zip(v[:40], got, strict=False):
        weight = []
        for c in (0, 1):
            w = (1 - model.prior, model.prior)[c] * np.exp(model.first[c][row[0] + 1])
            for (b, a), table in zip(model.parent, model.table, strict=True):
                w *= np.exp(table[c][row[a] + 1][row[b] + 1])
            weight.append(w)
        assert p == pytest.approx(weight[1] / sum(weight))
    assert np.allclose(np.exp(model.table).sum(axis=3), 1) and len(model.parent) == 4


def test_toxicity_query(spark):
    """Every document has one row, scores follow the whole text, and clean held-out documents stay."""
    rows = queries.op6_toxicity(spark, SF).collect()
    known = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == 200 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    clean = [r for r in rows if r.held_out and known.get(r.doc_id) == 0]
    assert clean and sum(r.predicted for r in clean) <= 0.05 * len(clean)


def test_toxicity_recall_on_held_out_rows(spark):
    """Nine of ten held-out toxic documents are found; some of the rest are labelled so without any sign in the text."""
    large = "/root/testdata/sf0.1"
    known = {r.doc_id: r.toxic for r in spark.read.parquet(f"{large}/labels.parquet").collect()}
    held = [r for r in queries.op6_toxicity(spark, large).collect() if r.held_out and r.doc_id in known]
    toxic, clean = ([r for r in held if known[r.doc_id] == y] for y in (1, 0))
    assert len(toxic) > 100 and sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_repeated_entries_need_two_near_hits():
    lexicon = toxicity.Lexicon(["grub*+", "plain"])
    far = "x " * (toxicity.NEAR + 5)
    found = lambda text: [lexicon.entries[k] for k in lexicon.measure(text)[0]]
    assert found("grubx") == found(f"grubx {far} grubx") == found("") == found(None) == []
    assert found("grubx y grubber") == ["grub*+"] and found("plain") == ["plain"]
    assert lexicon.measure("grubx y grubber plain")[1].tolist()[:3] == [4, 3, 1]
    assert {"ab+", "ab"} <= toxicity.terms_of("ab x ab") and "ab+" not in toxicity.terms_of(f"ab {far} ab")


def test_label_model_follows_the_known_sample():
    """Votes that mostly tell languages apart are still read as the sample says."""
    g = np.random.default_rng(4)
    y = (g.random(3000) < 0.15).astype(int)
    other = g.random(3000) < 0.3  # of another language, whose toxic texts one voter alone finds
    v = np.zeros((3000, 6), int)
    for k in range(5):
        v[:, k] = np.where((y == 1) & ~other & (g.random(3000) < 0.8), 1, -1)
    v[:, 5] = np.where((y == 1) & other & (g.random(3000) < 0.95), 1, -1)
    p = toxicity.LabelModel().fit(v, 0.15, known=(v[:300], y[:300])).posterior(v)
    assert ((p >= 0.7) == (y == 1)).mean() > 0.97


# 5


def test_chat_query(spark):
    wanted = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        wanted[r.conv_id].append((r.role, r.text))
    wanted[-7] = [(role, "</s>[INST] ok [/INST]") for role in ("user", "assistant")]
    template = chat.Template()
    rows = queries.op5_chat_tree(spark, SF).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        turns = wanted[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == sum(len(template.turn(*t)[0]) for t in turns)
    # the same tree, walked: children by their smallest conversation, nodes in depth-first order
    tree = {}
    for c in sorted(wanted, key=lambda c: f"c{c}"):
        at = tree
        for t in wanted[c]:
            at = at.setdefault(template.turn(*t)[0], {})
    start, stack, place = 0, [(tree, ())], {}
    while stack:
        node, way = stack.pop()
        if way:
            place[way] = start, start + len(way[-1])
            start += len(way[-1])
        stack += [(child, (*way, turn)) for turn, child in reversed(node.items())]
    for r in rows:
        way = tuple(template.turn(*t)[0] for t in wanted[r.conv_id])
        before = np.cumsum([0, *map(len, way)])
        positions = "".join(f"{a} {b - 1}\n" for a, b in zip(before, before[1:], strict=False))
        assert r.positions_sha256 == hashlib.sha256(positions.encode()).hexdigest()
        lines = ""
        for k in range(1, len(way) + 1):
            spans = []
            for a, b in (place[way[:j]] for j in range(1, k)):
                if spans and spans[-1][1] == a:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
            lines += " ".join(f"{a}-{b}" for a, b in [*spans, place[way[:k]]]) + "\n"
        assert r.attend_sha256 == hashlib.sha256(lines.encode()).hexdigest()


def test_tree_shares_beginnings_in_depth_first_order(spark):
    turns = {1: "abc", 2: "abd", 3: "ax", 4: "q", 5: "abdz", 6: "ab"}
    rows = [(c, k, "user" if k % 2 == 0 else "assistant", t) for c, ts in turns.items() for k, t in enumerate(ts)] + [(None, 0, None, None)]
    tree, ways = chat.prefix_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    nodes = sorted(tree.collect(), key=lambda r: r.start)
    template = chat.Template()
    assert [template.parse("".join(map(chr, n.token_ids)))[1] for n in nodes] == ["a", "b", "c", "d", "z", "x", "q", ""]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(nodes, nodes[1:], strict=False))
    for n in nodes:
        assert sum(b - a for a, b in n.attend) == n.pos and all(b <= n.start for _, b in n.attend)
    z = nodes[4]
    seen = [m for m in nodes if any(a <= m.start < b for a, b in z.attend)]
    assert [template.parse("".join(map(chr, m.token_ids)))[1] for m in seen] == ["a", "b", "d"]
    assert chat.digests(chat.read_back(tree, ways)).count() == 7


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("<s>/[INST]\\ ab\n"), max_size=30), st.text(st.sampled_from("<s>/[INST]\\u"), max_size=12))
def test_escapes_are_reversible(text, role):
    template = chat.Template()
    turn, a, b = template.turn(role, text)
    assert template.parse(turn) == (role, text) and template.unescape(turn[a:b]) == text
    assert not any(c in turn[a:b] for c in template.controls)


# 7, 9, 10


@pytest.mark.parametrize("most", [50_000, 0])
def test_url_rules_edges(spark, monkeypatch, most):
    monkeypatch.setattr(urlrules, "MAX_RULES", most)  # few rules in every task, or a table of them
    urls = ["HTTP://EXAMPLE.com/EN/7", "http://a.example.com/en/71?x#y", "http://com/en/1", "http://notcom/en/1", "http://x.net/de/8", "http://example.net/de/8#z", "no url", None, "http://", "a://b://c/d", "http://x.com?/en/"]
    got = urlrules.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), map(urlrules.parse_rule, queries.URL_RULES)).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [
        ("example.com", "/EN/7", None, "allow"),
        ("a.example.com", "/en/71", "example.com/en/7", "allow"),
        ("com", "/en/1", "com/en/", "block"),
        ("notcom", "/en/1", None, "allow"),
        ("x.net", "/de/8", "net/de/", "block"),
        ("example.net", "/de/8", "example.net/de/8", "block"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("b:", "//c/d", None, "allow"),
        ("x.com", "", None, "allow"),
    ]


@pytest.mark.parametrize("most", [50_000, 0])
def test_url_rules_keep_large_ids_beside_a_null_one(spark, monkeypatch, most):
    monkeypatch.setattr(urlrules, "MAX_RULES", most)
    rows = [(None, "http://a.com/en/1"), (2**60 + 1, "http://a.com/en/1"), (2**60 + 2, "http://example.com/en/7"), (2**60 + 3, None)]
    got = urlrules.judge(spark.createDataFrame(rows, "page_id long, url string").coalesce(1), map(urlrules.parse_rule, queries.URL_RULES)).collect()
    assert {(r.page_id, r.rule, r.verdict) for r in got} == {(None, "com/en/", "block"), (2**60 + 1, "com/en/", "block"), (2**60 + 2, "example.com/en/7", "allow"), (2**60 + 3, None, "allow")}


def test_token_counts_across_blocks(spark, tmp_path, reference):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text for r in frame.collect()]
    path = str(tmp_path / "flat")
    tokcount.write_flat(frame, path, RANKS, public_tokenizers.PATTERN, queries.END_ID)
    wanted = sorted(len(reference.encode_ordinary(t)) for t in texts)
    for block in (64, 1000, 1 << 20):
        got = tokcount.count_tokens(tokcount.read_blocks(spark, path, block), queries.END_ID)
        assert sorted(r.n_tokens for r in got.where("ended").collect()) == wanted and got.where("not ended").count() == 0


def test_token_counts_of_odd_blocks(spark):
    ids = [5, 9, 9, 1, 2, 3, 9, 7]
    raw = np.asarray(ids, ">u2").tobytes()
    rows = [("f", k, raw[2 * k : 2 * k + 2]) for k in range(len(ids))] + [("g", 0, b""), ("h", 0, np.asarray([9], ">u2").tobytes())]
    got = tokcount.count_tokens(spark.createDataFrame(rows, "file string, block int, data binary"), 9).orderBy("file", "doc").collect()
    assert [(r.file, r.doc, r.n_tokens, r.ended) for r in got] == [("f", 0, 1, True), ("f", 1, 0, True), ("f", 2, 3, True), ("f", 3, 1, False), ("h", 0, 0, True)]


def test_top_k_with_ties_and_copies(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(400, 8)).round(2)
    vectors[50:200] = vectors[0]  # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(400, None), (500, [float("nan")] * 8), (600, [None] * 8), (None, vectors[3].tolist()), (700, [1.0])]
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 2)
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 100 == 0).collect()
    whole = np.floor(vectors * 1024).astype(int)
    scores = whole @ whole.T
    wanted = set()
    for q in range(0, 400, 100):
        best = sorted((-scores[q, c], c) for c in range(400) if c != q)[:10]
        wanted |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(best)}
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == wanted


def test_top_k_of_huge_components(spark):
    """Scores beyond a long are ranked exactly and told as the nearest long."""
    vectors = {0: [1e15, 1.0], 1: [1e15, 2.0], 2: [1e15, -5.0], 3: [-1e15, 0.0], 4: [1e300, 0.0], 5: [3.0, 4.0], 6: [0.0, 0.0], 7: [0.001, 0.0], 8: [0.002, 1.0]}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = sorted((r.rank, r.vec_id, r.score) for r in topk.top_k(frame, F.col("id") == 0).collect())
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v in vectors.items()}
    scores = {i: sum(a * b for a, b in zip(v, whole[0], strict=True)) for i, v in whole.items() if i}
    order = sorted(scores, key=lambda i: (-scores[i], i))
    assert got == [(k + 1, i, max(-(2**63), min(2**63 - 1, scores[i]))) for k, i in enumerate(order)]
    assert {i: s for _, i, s in got}[7] == 1_024_000_000_000_000_000 and {i: s for _, i, s in got}[8] == 2_048_000_000_001_048_576


@pytest.mark.parametrize("name", ["op10_top_k", "op11_hard_negatives"])
def test_blocks_meet_without_coalescing(spark, name):
    """Equal blocks of both sides meet in one task, however many tasks there are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        same(queries.QUERIES[name](spark, SF), SF, queries.ORACLE_SQL[name])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_files_are_read_in_ranges(spark, tmp_path):
    """Ranges and blocks that end inside tokens, files that begin with a byte order mark or end with the cut."""
    rng = np.random.default_rng(5)
    files = {
        "plain": rng.integers(0, 40, 5000),
        "mark": np.concatenate([[0xEFBB, 0xBF0A], rng.integers(0, 20, 300)]),
        "cut": np.concatenate([rng.integers(0, 20, 301), [0x0A0A]]),
        "one": np.array([9]),
        "none": np.array([], int),
        "cuts": np.full(400, 0x0A0A),
    }
    wanted = set()
    for name, ids in files.items():
        (tmp_path / name).write_bytes(ids.astype(">u2").tobytes())
        at = np.flatnonzero(ids == 9)
        lengths = np.diff(np.concatenate([[-1], at])) - 1
        wanted |= {(name, k, int(n), True) for k, n in enumerate(lengths)}
        left = len(ids) - (at[-1] + 1 if len(at) else 0)
        if left:
            wanted.add((name, len(at), int(left), False))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        for block in (3, 100, 1 << 20):
            got = tokcount.count_tokens(tokcount.read_blocks(spark, str(tmp_path), block), 9).collect()
            assert {(r.file.rsplit("/", 1)[1], r.doc, r.n_tokens, r.ended) for r in got} == wanted and len(got) == len(wanted)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_token_counts_of_wide_ids(spark):
    ids = np.array([70000, 9, 9, 1 << 24, 5, 9, 7], ">u4").tobytes()
    rows = [("f", k, ids[3 * k : 3 * k + 3]) for k in range(-(-len(ids) // 3))]
    got = tokcount.count_tokens(spark.createDataFrame(rows, "file string, block int, data binary"), 9, 4).orderBy("doc").collect()
    assert [(r.doc, r.n_tokens, r.ended) for r in got] == [(0, 1, True), (1, 0, True), (2, 2, True), (3, 1, False)]


def test_token_count_query(spark, reference):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op9_token_counts(spark, SF).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(reference.encode_ordinary(t)) for t in texts) and all(r.ended for r in got)
