"""Staging relations (M1-M6): typed, flattened views of the raw payloads, 1:1 with raw.

Each payload is parsed once per row. The answer grain (the large table) is read with
``from_json`` and an explicit schema of text leaves: one streaming pass that materialises
only the selected keys, each as the JSON text ``->>`` returns, followed by strict casts.
Relations whose values are polymorphic (ground truth: string or array; the catalog's
model map) are parsed into a VARIANT instead. Unknown keys are never selected, so
producers may add keys freely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import (
    array_length_or_zero,
    ground_truth_text,
    jsub,
    jtext,
    jtyped,
    parsed,
    parsed_struct,
    stext,
    styped,
    text_schema,
)
from ..functions.keys import model_family
from ..functions.scalars import hop_count, infer_mechanism, nullif_empty, usd_per_mtok


def stg_runs(raw_manifest: DataFrame) -> DataFrame:
    """M1: one row per run, manifest metadata."""
    v = F.col("_v")
    return raw_manifest.withColumn("_v", parsed("payload")).select(
        "run_id",
        jtyped(v, "timestamp", "timestamp").alias("run_ts"),
        jtext(v, "retriever").alias("retriever"),
        jtext(v, "generator_provider").alias("generator_provider"),
        jtext(v, "generator_model").alias("generator_model"),
        jtext(v, "generator_model_resolved").alias("generator_model_resolved"),
        jtyped(v, "generator_temperature", "double").alias("generator_temperature"),
        jtext(v, "judge").alias("judge_model"),
        jtext(v, "corpus_build_id").alias("corpus_build_id"),
        jtext(v, "harness_version").alias("harness_version"),
        jtyped(v, "num_questions", "int").alias("num_questions"),
        jtext(v, "system_prompt_sha256").alias("generator_system_prompt_sha256"),
        "source_uri",
        "loaded_at",
    )


ANSWER_KEYS = [
    "retriever", "scoring", "generator_provider", "generator_model", "generator_model_resolved",
    "generator_temperature", "score", "passed", "judged", "verdict", "error", "input_tokens", "output_tokens",
    "cache_read_input_tokens", "cache_creation_input_tokens", "context_tokens_proxy", "num_sources",
    "retrieval_latency_ms", "generation_latency_ms",
]
TRAVERSAL_KEYS = [
    "mechanism", "hops", "num_triples", "num_linked", "top_k", "num_chunks", "embed_model", "writer_model",
    "writer_temperature", "writer_input_tokens", "writer_output_tokens", "sparql_valid", "num_rows", "endpoint",
    "context_tokenizer",
]
ANSWER_SCHEMA = text_schema(ANSWER_KEYS + [f"traversal_info.{k}" for k in TRAVERSAL_KEYS])


def _answer_columns(j: Column) -> list[Column]:
    resolved = stext(j, "generator_model_resolved")
    model_id = F.coalesce(resolved, stext(j, "generator_model"))
    return [
        stext(j, "retriever").alias("retriever"),
        stext(j, "scoring").alias("scoring"),
        stext(j, "generator_provider").alias("generator_provider"),
        stext(j, "generator_model").alias("generator_model"),
        resolved.alias("generator_model_resolved"),
        model_id.alias("generator_model_id"),
        model_family(model_id).alias("generator_model_family"),
        styped(j, "generator_temperature", "double").alias("generator_temperature"),
        styped(j, "score", "double").alias("score"),
        styped(j, "passed", "boolean").alias("is_passed"),
        styped(j, "judged", "boolean").alias("is_judged"),
        stext(j, "verdict").alias("verdict"),
        nullif_empty(stext(j, "error")).alias("error"),
        styped(j, "input_tokens", "bigint").alias("generator_input_tokens"),
        styped(j, "output_tokens", "bigint").alias("generator_output_tokens"),
        styped(j, "cache_read_input_tokens", "bigint").alias("generator_cache_read_tokens"),
        styped(j, "cache_creation_input_tokens", "bigint").alias("generator_cache_creation_tokens"),
        styped(j, "context_tokens_proxy", "bigint").alias("context_tokens_proxy"),
        styped(j, "num_sources", "int").alias("num_sources"),
        styped(j, "retrieval_latency_ms", "double").alias("retrieval_latency_ms"),
        styped(j, "generation_latency_ms", "double").alias("generation_latency_ms"),
    ]


def _traversal_columns(j: Column) -> list[Column]:
    # a missing traversal_info behaves as {} : every lookup below is NULL then
    ti = "traversal_info"
    writer = stext(j, f"{ti}.writer_model")
    return [
        infer_mechanism(stext(j, f"{ti}.mechanism"), stext(j, "retriever")).alias("mechanism"),
        styped(j, f"{ti}.hops", "int").alias("neighborhood_hops"),
        styped(j, f"{ti}.num_triples", "int").alias("neighborhood_num_triples"),
        styped(j, f"{ti}.num_linked", "int").alias("neighborhood_num_linked"),
        styped(j, f"{ti}.top_k", "int").alias("top_k"),
        styped(j, f"{ti}.num_chunks", "int").alias("dense_num_chunks"),
        stext(j, f"{ti}.embed_model").alias("embed_model"),
        writer.alias("writer_model"),
        model_family(writer).alias("writer_model_family"),
        styped(j, f"{ti}.writer_temperature", "double").alias("writer_temperature"),
        styped(j, f"{ti}.writer_input_tokens", "bigint").alias("writer_input_tokens"),
        styped(j, f"{ti}.writer_output_tokens", "bigint").alias("writer_output_tokens"),
        styped(j, f"{ti}.sparql_valid", "boolean").alias("is_sparql_valid"),
        styped(j, f"{ti}.num_rows", "int").alias("sparql_num_rows"),
        stext(j, f"{ti}.endpoint").alias("endpoint"),
        stext(j, f"{ti}.context_tokenizer").alias("context_tokenizer"),
    ]


def _answers_parsed(raw_answers: DataFrame) -> DataFrame:
    return raw_answers.withColumn("_j", parsed_struct("payload", ANSWER_SCHEMA))


def stg_scored_answers(raw_answers: DataFrame) -> DataFrame:
    """M2: one row per (run, question), typed answer measures."""
    j = F.col("_j")
    return _answers_parsed(raw_answers).select(
        "run_id", "question_id", *_answer_columns(j), "source_uri", "loaded_at"
    )


def stg_traversal(raw_answers: DataFrame) -> DataFrame:
    """M3: the polymorphic traversal object as sparse, mechanism-prefixed columns."""
    j = F.col("_j")
    return _answers_parsed(raw_answers).select("run_id", "question_id", *_traversal_columns(j))


def explode_answers(raw_answers: DataFrame) -> DataFrame:
    """M2 and M3 in one pass: a single parse per record yields both column sets.

    Replaces the 1:1 self-join of the two staging views on (run_id, question_id) (J2)."""
    j = F.col("_j")
    return _answers_parsed(raw_answers).select(
        "run_id", "question_id", *_answer_columns(j), *_traversal_columns(j)
    )


def stg_questions(raw_question: DataFrame) -> DataFrame:
    """M4: the question bank, with readable ground truth and parsed hop depth."""
    v = F.col("_v")
    type_id = jtext(v, "type_id")
    return raw_question.withColumn("_v", parsed("payload")).select(
        "question_id",
        type_id.alias("type_id"),
        jtext(v, "template_id").alias("template_id"),
        jtext(v, "scoring").alias("scoring"),
        jtext(v, "answer_var").alias("answer_var"),
        jtext(v, "question").alias("question_text"),
        F.to_json(jsub(v, "ground_truth")).alias("ground_truth_json"),
        ground_truth_text(v, "ground_truth").alias("ground_truth_answer_text"),
        hop_count(type_id).alias("question_hop_count"),
        array_length_or_zero(v, "seeds").alias("num_seed_entities"),
    )


def stg_corpus_profile(raw_profile: DataFrame) -> DataFrame:
    """M5: corpus size metrics; graph counts stay NULL where the profile has none."""
    v = F.col("_v")
    return raw_profile.withColumn("_v", parsed("payload")).select(
        "corpus_build_id",
        jtext(v, "scale").alias("corpus_scale"),
        jtyped(v, "measured_at", "timestamp").alias("corpus_measured_at"),
        jtyped(v, "graph.triples", "bigint").alias("triple_count"),
        jtyped(v, "graph.nodes", "bigint").alias("node_count"),
        jtyped(v, "graph.edges", "bigint").alias("edge_count"),
        jtyped(v, "graph.ttl_bytes", "bigint").alias("ttl_bytes"),
        jtext(v, "graph.ttl_sha256").alias("ttl_sha256"),
        jtyped(v, "vector.n_abstracts", "bigint").alias("paper_count"),
        jtyped(v, "vector.n_chunks", "bigint").alias("chunk_count"),
        jtyped(v, "vector.n_words", "bigint").alias("word_count"),
        jtyped(v, "vector.chunk_size", "int").alias("chunk_size"),
        jtyped(v, "vector.chunk_overlap", "int").alias("chunk_overlap"),
        jtyped(v, "vector.store_bytes", "bigint").alias("store_bytes"),
        jtext(v, "vector.embed_model").alias("embed_model"),
        "loaded_at",
    )


# Provenance prefix of catalog rows and the pay-as-you-go price paths.
CATALOG_NOTE_PREFIX = "portkey-ai/models @ "
PRICE_PATHS = {
    "input_usd_per_mtok": "pricing_config.pay_as_you_go.request_token.price",
    "output_usd_per_mtok": "pricing_config.pay_as_you_go.response_token.price",
    "cache_read_usd_per_mtok": "pricing_config.pay_as_you_go.cache_read_input_token.price",
    "cache_write_usd_per_mtok": "pricing_config.pay_as_you_go.cache_write_input_token.price",
}


def explode_catalog(raw_pricing: DataFrame) -> DataFrame:
    """One row per (provider, model key) from the snapshot's ``models`` object.

    An empty object yields no rows (inner lateral semantics)."""
    v = F.col("_v")
    return (
        raw_pricing.withColumn("_v", parsed("payload"))
        .select(
            "provider",
            jsub(v, "meta").alias("meta"),
            F.explode(F.variant_get(v, "$.models", "map<string,variant>")).alias("portkey_model_key", "model_obj"),
        )
    )


def stg_model_pricing(raw_pricing: DataFrame, alias_seed: DataFrame) -> DataFrame:
    """M6: the catalog flattened to one priced row per model, USD per 1M tokens.

    The alias crosswalk maps a catalog key to the benchmark's model name (identity when
    there is no alias row, J1)."""
    e = explode_catalog(raw_pricing)
    m = F.col("model_obj")
    meta = F.col("meta")
    rates = [usd_per_mtok(jtext(m, path)).alias(name) for name, path in PRICE_PATHS.items()]
    flat = e.select(
        "provider",
        "portkey_model_key",
        *rates,
        jtyped(meta, "fetched_at", "date").alias("effective_date"),
        F.concat(F.lit(CATALOG_NOTE_PREFIX), jtext(meta, "ref"), F.lit(", fetched "), jtext(meta, "fetched_at")).alias(
            "source_note"
        ),
    )
    a = F.broadcast(alias_seed.select("portkey_model_key", F.col("model_resolved").alias("_alias")))
    return flat.join(a, "portkey_model_key", "left").select(
        "provider",
        F.coalesce(F.col("_alias"), F.col("portkey_model_key")).alias("model_resolved"),
        "portkey_model_key",
        *PRICE_PATHS.keys(),
        "effective_date",
        "source_note",
    )
