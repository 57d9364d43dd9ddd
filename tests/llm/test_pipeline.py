"""Each stage of the pipeline against brute force, and with awkward rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF
from tests.llm.test_edges import docs
from tests.llm.test_operators import _classes, brute_removal
from tickloom.llm import decontam

STAGES = dict(corpus_pipeline.STAGES)


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_toxicity_drops_labelled_documents_and_keeps_clean_ones(spark, corpus):
    kept = texts(STAGES["toxicity"](spark, corpus, SF))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i in texts(corpus) if labels.get(i) == 0]
    toxic = [i for i in texts(corpus) if labels.get(i) == 1]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and sum(i not in kept for i in toxic) >= 0.6 * len(toxic)  # some are labelled so without any sign in the text


def test_near_duplicates_keep_the_first_of_each_class(spark, corpus):
    all_, kept = texts(corpus), texts(STAGES["near_duplicates"](spark, corpus, SF))
    ids = sorted(all_)
    wanted = {ids[k] for k, c in _classes([all_[i] for i in ids]).items() if k == c}
    assert wanted <= kept.keys() and len(kept) <= len(wanted) + 0.02 * len(ids) and all(all_[i] == t for i, t in kept.items())


def test_repeated_passages_equal_brute_force(spark, corpus):
    wanted = brute_removal([(i, (t or "").encode()) for i, t in texts(corpus).items()])
    got = STAGES["repeated_passages"](spark, corpus, SF).collect()
    assert len(got) == len(wanted)
    for r in got:
        assert r.text == wanted[r.doc_id][0].decode("utf-8", "ignore") and r.n_chars == len(r.text)


def test_decontamination_drops_what_holds_an_item(spark, corpus):
    all_, kept = texts(corpus), texts(STAGES["decontamination"](spark, corpus, SF))
    items = [" " + " ".join(decontam.words_of(r.text)) + " " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {i for i, t in all_.items() if any(x in " " + " ".join(decontam.words_of(t)) + " " for x in items)}
    assert held and not held & kept.keys() and len(kept) >= len(all_) - len(held) - max(2, len(held) // 10)


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_with_awkward_rows(spark, name):
    """Nulls, empty and long texts, equal rows, a null id and clashing columns; and no rows at all."""
    frame = docs(spark)
    out = STAGES[name](spark, frame, SF)
    rows = out.collect()
    count = {"near_duplicates": frame.count() - 3}.get(name, frame.count())  # 6 equals 5, 5 stands twice, 8 is near 7
    assert len(rows) == count
    if name != "encoding":
        assert out.columns == list(corpus_pipeline.COLUMNS)
    assert sum(r.doc_id is None for r in rows) == 1
    assert STAGES[name](spark, docs(spark, empty=True), SF).count() == 0


def test_an_id_with_two_texts_loses_only_the_judged_one(spark):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(1, words), (2, words + " seventeen"), (2, "quite another text with other words that nobody else has written down"), (3, words), (3, words)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(None).cast("string").alias(c) for c in ("lang", "source")], F.length("text").cast("long").alias("n_chars"))
    kept = STAGES["near_duplicates"](spark, frame, SF).collect()
    assert sorted((r.doc_id, r.text[:5]) for r in kept) == [(1, "one t"), (2, "quite")]
