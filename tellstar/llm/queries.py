"""One query for each dealt operator, with its production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, hmm, negatives, neighbours, packing, quality, sharding, simhash, substring, topk, toxicity, whitening
from .folds import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated 50-word windows removed, the smallest doc_id's copy kept."""
    return substring.report(table(spark, sf_dir, "documents"), window=50).drop("spans")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document by the additive model."""
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op3_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and hidden Markov scores of every document, trained on nine tenths of them."""
    return hmm.scores(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 ids."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, capacity=4096, end=2, with_ids=False)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every vector whose vec_id is divisible by 50."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every document by the weakly supervised classifier."""
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


#: Names of the shards that op7 fills.
SHARDS = [f"shard-{i:03d}" for i in range(256)]


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement of every document on 256 shards by a table of 65,537 slots."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.octet_length("text").cast("long").alias("n_bytes"))
    found = sharding.placed(docs, "doc_id", SHARDS)
    return found.select("doc_id", "source", "n_bytes", F.col("_slot").alias("slot"), F.col("_shard_id").alias("shard_id"), F.col("_shard").alias("shard"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components: 4-word shingles, links at 4 or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by 13-word phrases of the benchmark items."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, share=20).drop("spans")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE token counts of every document, and those over 1024 tokens."""
    return bpe.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 8 whitened components of every vector."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=8, scale=1024, offset=100000)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five positives of every vector whose vec_id is divisible by 100, and five negatives of each
    that score 80 to 100 percent of it; a seventh of the labels is moved on first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label, positives=5, negatives=5, share=(80, 100), scale=256)


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose vec_id is divisible by 20."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


REGISTRY: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality": op2_quality,
    "op3_hmm": op3_hmm,
    "op4_packing": op4_packing,
    "op5_topk": op5_topk,
    "op6_toxicity": op6_toxicity,
    "op7_sharding": op7_sharding,
    "op8_simhash": op8_simhash,
    "op9_decontamination": op9_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_neighbours": op13_neighbours,
}

#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLE: dict[str, str] = {
    "op5_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
              FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
        p AS (SELECT anchor_id, vec_id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id)::INTEGER AS positive_rank FROM s WHERE same),
        n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score, positive_rank,
                     row_number() OVER (PARTITION BY p.anchor_id, positive_rank ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
              FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score WHERE positive_rank <= 5)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank FROM n WHERE rank <= 5""",
}
