"""Thin queries over the driver tables, one for each training-data operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import bpe, chat, decontam, hardneg, kmeans, langid, licenses, omh, suffix, tokcount, topk, toxicity, urlrules
from tickloom.llm.common import shared_folder, table

#: The rank file that the byte-level queries use.
RANKS = "byte_bpe_multi_50k.tiktoken"

#: An id that the rank file leaves free, as end of document.
END_ID = 50256

#: The vocabulary of the language model.
PIECES = "piece_bpe_32k.model"

#: Rules of the URL query.
URL_RULES = (
    "block com/en/",
    "allow example.com/en/7",
    "block net/de/",
    "block example.net/de/8",
    "block org/es/",
)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return omh.near_duplicates(table(spark, sf_dir, "documents"))


def _fold(n: int):
    """crc32 of the document id's decimal text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(_fold(4) == 2, F.lit(False)))
    model = langid.train(docs.where(~F.col("held_out")), public_tokenizers.path(PIECES))
    return langid.identify(docs, model, keep=("doc_id", "held_out"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of ids and of decoded bytes."""
    return bpe.transcode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(RANKS),
        public_tokenizers.PATTERN,
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op5_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all conversations and one of control strings; digests of what is read back."""
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trial = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
    tree, ways = chat.prefix_tree(own.unionByName(spark.createDataFrame(trial, own.schema)))
    return chat.digests(chat.read_back(tree, ways))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(_fold(3) == 1, F.lit(False)))
    labels = table(spark, sf_dir, "labels").where(F.coalesce(_fold(3) != 1, F.lit(False)))
    model = toxicity.train(docs.where(~F.col("held_out")), labels)
    return toxicity.score(docs, model, keep=("doc_id", "held_out"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every page."""
    return urlrules.judge(table(spark, sf_dir, "pages"), map(urlrules.parse_rule, URL_RULES))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that start in a smaller document."""
    return suffix.strip_repeats(table(spark, sf_dir, "documents"), outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into flat token files; count tokens by scanning those for separators.

    Returns file (number of the part file), doc (from 0 in each file), n_tokens, ended.
    """
    path = f"{shared_folder(spark)}/flat-tokens-{uuid.uuid4().hex}"  # of this run alone
    tokcount.write_flat(table(spark, sf_dir, "documents"), path, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, END_ID)
    counts = tokcount.count_tokens(tokcount.read_blocks(spark, path), END_ID)
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("int")
    return counts.withColumn("file", part)


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best candidates of every vector whose id is divisible by 100."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 50; labels of every seventh id are shifted."""
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(rows.withColumn("label", shifted), F.col("id") % 50 == 0)


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty clusters of all vectors of 64 components after five rounds."""
    first = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    return kmeans.cluster(table(spark, sf_dir, "embeddings"), first, k=40, rounds=5, dim=64).drop("centroid")


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_order_minhash": op2_order_minhash,
    "op3_language": op3_language,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_chat_tree": op5_chat_tree,
    "op6_toxicity": op6_toxicity,
    "op7_url_rules": op7_url_rules,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_top_k": op10_top_k,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_clusters": op12_clusters,
    "op13_licenses": op13_licenses,
}


def _clusters_sql(k: int = 40, rounds: int = 5) -> str:
    """Plain rounds over all distances."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""d{n} AS (SELECT r, vec_id, v, j, vv - 2 * list_inner_product(v, c) + cc AS d FROM kept, (SELECT *, list_inner_product(c, c) AS cc FROM c{n})),
a{n} AS (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(j, d * 64 + j) AS j, min(d) AS d FROM d{n} GROUP BY r)""")
        if n < rounds:
            steps.append(f"""s{n} AS (SELECT j, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT j, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n}) GROUP BY 1, 2),
m{n} AS (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS c FROM s{n} GROUP BY 1),
c{n + 1} AS (SELECT c{n}.j, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} ON c{n}.j = m{n}.j)""")
    every = ",\n".join(steps)
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, v, list_inner_product(v, v) AS vv FROM (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS j, v AS c FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h LIMIT {k})),
{every},
t AS (SELECT j, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY 1)
SELECT vec_id, a.j AS cluster, CAST(d AS BIGINT) AS distance, cluster_inertia, CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN t ON a.j = t.j JOIN c{rounds} c ON a.j = c.j
"""


ORACLE_SQL: dict[str, str] = {
    "op11_hard_negatives": """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS s
  FROM usable a JOIN usable c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
pos AS (
  SELECT anchor_id, other AS positive_id, s AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other) AS r FROM scored WHERE same) WHERE r <= 5),
neg AS (
  SELECT anchor_id, positive_id, positive_score, other AS negative_id, s AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, other) AS rank
  FROM pos JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * s AND 100 * s <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
""",
    "op12_clusters": _clusters_sql(),
    "op13_licenses": licenses.scan_sql(),
    "op10_top_k": """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op7_url_rules": r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(rhost, rpath, verdict) AS (VALUES
  ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'block'),
  ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
judged AS (
  SELECT p.*, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM parts p LEFT JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM judged
""",
}
