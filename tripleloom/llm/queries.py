"""The named queries of the operators for training text, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripleloom.llm import language, quality, shard_tree, toxicity
from tripleloom.llm.binary_codes import near_vectors
from tripleloom.llm.bit_sliced import top_k
from tripleloom.llm.bpe import bpe_decode, bpe_encode
from tripleloom.llm.common import fold, table
from tripleloom.llm.first_fit import first_fit_packed
from tripleloom.llm.packing import best_fit_packed
from tripleloom.llm.prefix_trie import prefix_trie
from tripleloom.llm.secrets import scan
from tripleloom.llm.simhash import simhash_components
from tripleloom.llm.whitening import whitened

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

#: Nodes are named by the digest of their turns; a node adds to all its prefixes.
CONVERSATIONS = """
WITH RECURSIVE crc_steps(b, c, i) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM crc_steps WHERE i < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM crc_steps WHERE i = 8),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
named AS (SELECT *, sha256(length(role)::VARCHAR || ':' || role || text)[:32] AS id FROM turns),
own AS (
  SELECT conv_id, list({'id': id, 'bytes': strlen(text)} ORDER BY turn NULLS FIRST, id) AS turns FROM named GROUP BY conv_id),
counted AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM own CROSS JOIN crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM counted c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
paths AS (
  SELECT conv_id, len(turns) AS length, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt),
prefixes AS (
  SELECT conv_id, length, depth, turns[depth].bytes AS bytes,
    sha256(list_aggregate(list_transform(turns[1:depth], lambda x: x.id), 'string_agg', '')) AS node,
    sha256(list_aggregate(list_transform(turns[1:depth - 1], lambda x: x.id), 'string_agg', '')) AS parent
  FROM paths),
keyed AS (SELECT *, coalesce(node, 'root') AS k, CASE WHEN depth > 0 THEN coalesce(parent, 'root') END AS p FROM prefixes),
nodes AS (
  SELECT k, any_value(p) AS p, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM keyed GROUP BY k),
children AS (SELECT p AS k, count(*) AS n_children FROM nodes WHERE p IS NOT NULL GROUP BY p),
gains AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * bytes END AS gain
  FROM nodes n LEFT JOIN children USING (k)),
-- a node's ancestors are the prefixes of its smallest member's path
above AS (
  SELECT a.k, sum(CASE WHEN g.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(g.gain) AS saved_tokens
  FROM gains g JOIN keyed a ON a.conv_id = g.conv_id AND a.depth <= g.depth GROUP BY a.k)
SELECT g.conv_id, g.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, g.n_convs::BIGINT AS n_convs,
  g.n_children::BIGINT AS n_children, a.n_leaves::BIGINT AS n_leaves, a.saved_tokens::BIGINT AS saved_tokens, g.ends_sha256
FROM gains g JOIN above a USING (k) LEFT JOIN nodes q ON q.k = g.p"""

TOP_K = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * r.v[i]))::BIGINT AS score
  FROM usable q JOIN usable r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints differ in at most 4 bits."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each text, learned from the labels of all folds but the held-out one."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (fold(docs["doc_id"], 5) == 0).alias("held_out"), quality.score(docs["text"], model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each text, by pattern and by entropy."""
    return scan(table(spark, sf_dir, "documents"))


def op4_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 23 by doc_id, and the shard after one more has joined."""
    found = shard_tree.sharded(table(spark, sf_dir, "documents"), shard_tree.ShardTree())
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_binary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked by a cosine of 0.95 or more, and their components."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each text, learned from the labels of all folds but the held-out one."""
    docs = table(spark, sf_dir, "documents")
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    if fitted is None:
        scored = toxicity.scored(docs, None).select("doc_id", held_out, F.col("toxicity").alias("score"))
    else:
        _, limits, raw = fitted
        scored = raw.select("doc_id", held_out, toxicity.score(F.col("raw"), F.col("language"), limits).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 1024 tokens."""
    return best_fit_packed(table(spark, sf_dir, "documents"), VOCABULARY)


def op8_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of each vector whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of each text, and the digest of what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_decode(bpe_encode(docs, VOCABULARY).drop("text"), VOCABULARY)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each text, learned from all folds but the held-out one."""
    docs = table(spark, sf_dir, "documents")
    found = language.predicted(docs, language.fit(docs))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_first_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens without padding."""
    return first_fit_packed(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 first whitened components of each vector; a deviation beyond a long is null."""
    found = whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_quality": op2_quality,
        "op3_secrets": op3_secrets,
        "op4_hash_tree": op4_hash_tree,
        "op5_binary_codes": op5_binary_codes,
        "op6_toxicity": op6_toxicity,
        "op7_residual_packing": op7_residual_packing,
        "op8_bit_sliced_top_k": op8_bit_sliced_top_k,
        "op9_bpe": op9_bpe,
        "op10_language": op10_language,
        "op11_burst_trie": op11_burst_trie,
        "op12_first_fit": op12_first_fit,
        "op13_whitening": op13_whitening,
    }


def llm_checks() -> dict[str, str]:
    return {"op4_hash_tree": shard_tree.sql(shard_tree.ShardTree()), "op8_bit_sliced_top_k": TOP_K, "op11_burst_trie": CONVERSATIONS}
