"""A corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows to the shared folder and reads them again for the next.  All stages but
the last return the columns of ``documents``.  Decisions are taken on a row's id and text
together, so an id that repeats with another text loses only the row that was judged.
Empty tables, null texts and null ids pass every stage without rows being lost; columns
beside those of ``documents`` are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import bpe, decontam, omh, suffix, toxicity
from tickloom.llm.common import materialise, settle, shared_folder, table
from tickloom.llm.queries import RANKS

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents whose id and text are not among the (doc_id, text_hash) of ``found``."""
    gone = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    named = docs.withColumn("text_hash", F.xxhash64("text"))
    return named.join(gone, named["doc_id"].eqNullSafe(gone["__id"]) & (named["text_hash"] == gone["__hash"]), "left_anti").select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier, trained on the labels, rejects.

    Null and empty texts stay, equal texts share their fate, and without labels of both
    classes the share of toxic ones is every document's score.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=COLUMNS).where("predicted = 0").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates: the smallest id, of its texts the smallest hash.

    Of equal rows one stays.  Rows with a null id take no part and stay.
    """
    classes = materialise(omh.near_duplicates(docs))
    key = F.struct("doc_id", "text_hash")
    kept = classes.where("class_id is not null").groupBy("class_id").agg(F.min(key).alias("kept"))
    rest = classes.join(kept, "class_id").where(key != F.col("kept"))
    left = _without(docs, rest)
    equal = materialise(classes.where("doc_id is not null").groupBy("doc_id", "text_hash").count().where("count > 1"))
    if equal.isEmpty():
        return left
    hashed = left.withColumn("text_hash", F.xxhash64("text"))
    one = hashed.join(equal, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return _without(left, equal).unionByName(one.select(*COLUMNS))


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out the passages that a document with a smaller id holds too; documents stay.

    Null texts become empty; texts of under 50 bytes, equal rows and rows with a null id
    keep their text, and an id's own other text is no smaller document.
    """
    cut = suffix.strip_repeats(docs, outputs=("kept_text",), keep=("doc_id", "lang", "source"))
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("bigint").alias("n_chars"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item, also those with a null id.

    Null texts, null items and an empty benchmark match nothing; equal rows share their fate.
    """
    return _without(docs, decontam.contaminated(docs, table(spark, sf_dir, "benchmark")))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left: doc_id, lang, source, n_tokens, token_ids.

    A null text has no tokens; equal rows and null ids stay.
    """
    return bpe.transcode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _rested(stage: Stage) -> Stage:
    """``stage``, after the driver has given back what the stages before it left."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        settle(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", _rested(toxicity_stage)),
    ("near_duplicates", _rested(near_duplicate_stage)),
    ("repeated_passages", _rested(repeated_passage_stage)),
    ("decontamination", _rested(decontamination_stage)),
    ("encoding", _rested(encoding_stage)),
]

#: SQL expresses neither the classifier, the sketches nor the encoding; tests/llm/test_pipeline.py compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each run writes to a folder of its own."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
