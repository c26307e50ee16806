"""Intermediate relations (M7, M8): the pricing contract and the enriched answer grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.scalars import coalesce_sum, token_cost
from ..operators.joins import broadcast_if_small, null_aware_anti_join
from .staging import explode_answers

RATE_COLUMNS = ["input_usd_per_mtok", "output_usd_per_mtok", "cache_read_usd_per_mtok", "cache_write_usd_per_mtok"]
PRICING_COLUMNS = [
    "pricing_sk", "provider", "model_resolved", *RATE_COLUMNS,
    "effective_date", "source_note", "rate_unit", "pricing_source",
]
# Fixed values of the pricing contract.
RATE_UNIT = "usd_per_mtok"
SOURCE_CATALOG = "portkey"
SOURCE_OVERRIDE = "override"


def _priced(df: DataFrame, source: str) -> DataFrame:
    return df.select(
        surrogate_key("provider", "model_resolved").alias("pricing_sk"),
        "provider",
        "model_resolved",
        *[F.col(c).cast("decimal(14,6)").alias(c) for c in RATE_COLUMNS],
        "effective_date",
        "source_note",
        F.lit(RATE_UNIT).alias("rate_unit"),
        F.lit(source).alias("pricing_source"),
    )


def int_model_pricing(stg_pricing: DataFrame, overrides: DataFrame) -> DataFrame:
    """M7: curated overrides UNION ALL catalog rows whose model is NOT IN the overrides."""
    catalog = null_aware_anti_join(stg_pricing, overrides, "model_resolved", "model_resolved")
    return _priced(overrides, SOURCE_OVERRIDE).unionByName(_priced(catalog, SOURCE_CATALOG))


def _price_role(pricing: DataFrame, prefix: str) -> DataFrame:
    """One role of the price relation (generator or writer), columns prefixed."""
    return pricing.select(
        F.col("model_resolved").alias(f"{prefix}_model"),
        F.col("pricing_sk").alias(f"{prefix}_pricing_sk"),
        *[F.col(c).alias(f"{prefix}_{c}") for c in RATE_COLUMNS],
    )


def int_scored_answers_enriched(
    raw_answers: DataFrame, questions: DataFrame, runs: DataFrame, pricing: DataFrame
) -> DataFrame:
    """M8: answers with traversal measures, question and run attributes, and cost.

    * answers + traversal come from one parse of each record (no self-join, J2)
    * questions (J3) and runs (J4) are plain left joins: the planner broadcasts them
      when their measured size allows and shuffles otherwise (AQE splits a hot key)
    * prices (J5, J6) are broadcast behind a row-count check; the generator price joins
      the *resolved* model id only, the writer price the writer model
    """
    a = explode_answers(raw_answers)
    q = questions.select("question_id", "type_id", "template_id", "question_hop_count", "num_seed_entities")
    r = runs.select(
        "run_id", "run_ts", "judge_model", "corpus_build_id", "harness_version", "generator_system_prompt_sha256"
    )
    price = broadcast_if_small(pricing.select("model_resolved", "pricing_sk", *RATE_COLUMNS), max_rows=1_000_000)
    gp = _price_role(price, "gp")
    wp = _price_role(price, "wp")
    j = (
        a.join(q, "question_id", "left")
        .join(r, "run_id", "left")
        .join(gp, F.col("generator_model_resolved") == F.col("gp_model"), "left")
        .join(wp, F.col("writer_model") == F.col("wp_model"), "left")
    )
    return j.select(
        "run_id",
        "question_id",
        "run_ts",
        "judge_model",
        "corpus_build_id",
        "harness_version",
        "generator_system_prompt_sha256",
        "generator_provider",
        "generator_model_id",
        "generator_model_family",
        "generator_temperature",
        "retriever",
        "mechanism",
        "writer_model",
        "writer_model_family",
        "embed_model",
        "endpoint",
        "scoring",
        "type_id",
        "template_id",
        "question_hop_count",
        "num_seed_entities",
        "score",
        "is_passed",
        "is_judged",
        "verdict",
        "error",
        F.col("error").isNotNull().alias("is_error"),
        "generator_input_tokens",
        "generator_output_tokens",
        "generator_cache_read_tokens",
        "generator_cache_creation_tokens",
        coalesce_sum("generator_input_tokens", "generator_output_tokens").alias("generator_total_tokens"),
        "context_tokens_proxy",
        "num_sources",
        "retrieval_latency_ms",
        "generation_latency_ms",
        coalesce_sum("retrieval_latency_ms", "generation_latency_ms").alias("total_latency_ms"),
        "neighborhood_hops",
        "neighborhood_num_triples",
        "neighborhood_num_linked",
        "top_k",
        "dense_num_chunks",
        "writer_temperature",
        "writer_input_tokens",
        "writer_output_tokens",
        coalesce_sum("writer_input_tokens", "writer_output_tokens").alias("writer_total_tokens"),
        "is_sparql_valid",
        "sparql_num_rows",
        F.col("gp_pricing_sk").alias("generator_pricing_sk"),
        F.col("wp_pricing_sk").alias("writer_pricing_sk"),
        token_cost(
            ("generator_input_tokens", "gp_input_usd_per_mtok"),
            ("generator_output_tokens", "gp_output_usd_per_mtok"),
            ("generator_cache_read_tokens", "gp_cache_read_usd_per_mtok"),
            ("generator_cache_creation_tokens", "gp_cache_write_usd_per_mtok"),
        ).alias("generator_cost_usd"),
        token_cost(
            ("writer_input_tokens", "wp_input_usd_per_mtok"),
            ("writer_output_tokens", "wp_output_usd_per_mtok"),
        ).alias("writer_cost_usd"),
    )


def join_traversal(answers: DataFrame, traversal: DataFrame) -> DataFrame:
    """J2 in its join form, for when the two staging relations come from separate inputs."""
    return answers.join(traversal, ["run_id", "question_id"], "left")
