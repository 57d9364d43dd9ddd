"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF
from tickloom.llm import bpe, chat, decontam, langid, licenses, omh, queries, suffix, tokcount, topk, toxicity, urlrules

RANKS, PIECES = public_tokenizers.path(queries.RANKS), public_tokenizers.path(queries.PIECES)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, rep long, node long, bucket long, labels string"
LONG = "lorem ipsum dolor sit amet " * 9000


def docs(spark, empty=False):
    texts = ["", None, " ", "###", "one", "The quick brown fox jumps over the lazy dog again and again today", "The quick brown fox jumps over the lazy dog again and again today", LONG, LONG + "x", "漢字かな交じり文" * 40, "🙂" * 60]
    rows = [(i, t, "en" if i % 2 else None, None, None, "x", 1, 2, 3, "y") for i, t in enumerate(texts)]
    rows += [rows[5], (None, "no id at all but some words here to count", "en", None, None, "x", 1, 2, 3, "y")]
    return spark.createDataFrame([] if empty else rows, DOCS)


def benchmark(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog again and again"), (2, None), (None, "some words here to count"), (3, "")], "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(1, 0), (5, 1), (7, None), (None, 1), (8, 0)], "doc_id long, toxic int")


def learned(spark, frame):
    return langid.identify(frame, langid.train(frame, PIECES))


def scored(spark, frame):
    return toxicity.score(frame, toxicity.train(frame, labels(spark)))


RUNS = {
    "decontaminate": lambda s, d: decontam.contaminated(d, benchmark(s)),
    "near_duplicates": lambda s, d: omh.near_duplicates(d),
    "language": learned,
    "licenses": lambda s, d: licenses.scan(d),
    "bpe": lambda s, d: bpe.transcode(d, RANKS, public_tokenizers.PATTERN, tuple(bpe.OUTPUTS)),
    "toxicity": scored,
    "suffix": lambda s, d: suffix.strip_repeats(d, ("kept", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256")),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_awkward_documents(spark, name):
    frame = docs(spark)
    rows = RUNS[name](spark, frame).collect()
    if name == "decontaminate":
        assert {r.doc_id for r in rows if r.item_id == 1} == {5, 6}
    else:
        assert len(rows) == frame.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, r)
    if name == "near_duplicates":
        assert by[6].class_id == 5 and by[8].class_id == 7 and by[1].class_id == 1 and by[None].class_id is None and by[3].class_id == 3
    if name == "language":
        assert by[0].lang_pred == by[1].lang_pred == by[3].lang_pred == "und" and by[1].score == 0
    if name == "licenses":
        assert by[1].n_words == by[0].n_words == by[3].n_words == 0 and by[7].n_words == 45_000 and by[5].n_words == 13 and by[9].n_words == 1  # no separator in it
        assert all(r.labels == r.base_labels == "" and r.score == 0 for r in rows)
    if name == "bpe":
        assert by[1].n_tokens == 0 and bytes(by[7].decoded).decode() == LONG
    if name == "toxicity":
        assert all(0 <= r.score <= 1 for r in rows)
    if name == "suffix":
        assert by[6].n_removed == by[6].n_bytes and by[5].n_removed == 0 and by[1].n_bytes == 0 and by[7].n_removed == 0 and by[8].n_removed == by[8].n_bytes - 1


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_documents(spark, name):
    assert RUNS[name](spark, docs(spark, empty=True)).count() == 0


def test_other_empty_tables(spark):
    none = lambda schema: spark.createDataFrame([], schema)
    assert decontam.contaminated(docs(spark), none("item_id long, text string")).count() == 0
    assert topk.top_k(none("vec_id long, embedding array<float>"), F.col("id") % 100 == 0).count() == 0
    assert urlrules.judge(none("page_id long, url string, html string"), []).count() == 0
    assert tokcount.count_tokens(none("file string, block int, data binary"), 9).count() == 0
    tree, ways = chat.prefix_tree(none("conv_id long, turn long, role string, text string"))
    assert chat.digests(chat.read_back(tree, ways)).count() == 0
    assert toxicity.score(docs(spark), toxicity.train(docs(spark), none("doc_id long, toxic int"))).where("score <> 0").count() == 0


def test_pipeline_stages_keep_clean_documents(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, frame, SF)
        assert out.columns == list(corpus_pipeline.COLUMNS)
        kept = out.count()
        assert 0.5 * frame.count() <= kept <= frame.count(), name
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]
