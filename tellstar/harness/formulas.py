"""Stand-in telemetry derived from the driver tables, as SQL expressions in two dialects.

The same formulas build the JSON landing files on Spark (``adapter``) and the typed
expectation relations in DuckDB (``oracle``). They only decide which value each field of
the input has (or that it is absent); all pipeline work happens in the library.

Base relation ``ev`` (from ``events``): eid, u (user_id), et (event_type), val (value),
ts, k (props.k), d (day of month), ymd (yyyymmdd), ymd_dash (yyyy-mm-dd).
"""

from __future__ import annotations

# Question type ids and scoring types of the benchmark (seed order),
# plus one type id the seed does not know, to exercise the label fallback.
TYPE_IDS = [
    "01_0hop_attribute", "02_1hop_factoid", "03_2hop_traversal", "04_3plus_hop_traversal",
    "05_aggregative", "06_set_intersection", "07_set_difference", "08_negative_unanswerable",
    "09_path_existence", "10_fuzzy_semantic", "11_unseeded_probe",
]
SCORINGS = ["string_match", "set_match", "numerical", "binary", "boolean", "semantic"]
# model family per part type, for the part-derived price catalog
FAMILY_BY_PART_TYPE = {
    "ECONOMY": "claude-haiku-4-5",
    "LARGE": "claude-sonnet-4-5",
    "MEDIUM": "claude-haiku-4-5",
    "PROMO": "claude-opus-4-1",
    "SMALL": "claude-3-5-haiku",
    "STANDARD": "claude-sonnet-4-5",
}
MODEL_SPACE = 2003  # answers reference snapshot ids 0..2002; ids without a part are unpriced


def _pick(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


def dialect(name: str) -> dict[str, str]:
    if name == "spark":
        return {
            "STR": "string",
            "K": "CAST(get_json_object(props, '$.k') AS INT)",
            "YMD": "date_format(ts, 'yyyyMMdd')",
            "YMD_DASH": "date_format(ts, 'yyyy-MM-dd')",
            "DAY": "CAST(day(ts) AS INT)",
        }
    return {
        "STR": "varchar",
        "K": "CAST(json_extract_string(props, '$.k') AS INTEGER)",
        "YMD": "strftime(ts, '%Y%m%d')",
        "YMD_DASH": "strftime(ts, '%Y-%m-%d')",
        "DAY": "CAST(day(ts) AS INTEGER)",
    }


def ev_sql(dia: str, table: str = "events") -> str:
    x = dialect(dia)
    return (
        f"SELECT event_id AS eid, user_id AS u, event_type AS et, value AS val, ts, "
        f"{x['K']} AS k, {x['DAY']} AS d, {x['YMD']} AS ymd, {x['YMD_DASH']} AS ymd_dash FROM {table}"
    )


def corpus_id(sk: str, dia: str) -> str:
    s = dialect(dia)["STR"]
    return f"(CASE WHEN {sk} % 4 = 0 THEN 'smoke' ELSE 'full' END || '-' || lpad(CAST({sk} AS {s}), 8, '0'))"


def retriever(et: str = "et", d: str = "d") -> str:
    return (
        f"CASE {et} WHEN 'view' THEN 'closed_book' WHEN 'click' THEN 'vector' "
        f"WHEN 'signup' THEN CASE WHEN {d} <= 3 THEN 'graph_neighborhood' ELSE 'graph_neighborhood_1hop' END "
        f"WHEN 'purchase' THEN CASE WHEN {d} = 30 THEN 'hybrid_x' ELSE 'graph_neighborhood_2hop' END "
        f"WHEN 'error' THEN 'graph_sparqlgen' END"
    )


def run_fields(dia: str) -> list[tuple[str, str]]:
    """Manifest fields of the run (et, d); NULL = key absent."""
    s = dialect(dia)["STR"]
    return [
        ("run_id", "et || '-' || ymd"),
        ("timestamp", "ymd_dash || 'T09:30:00+0200'"),
        ("retriever", retriever()),
        ("generator_provider", "'anthropic'"),
        ("generator_model", "'claude-haiku-4-5'"),
        ("generator_model_resolved", "CASE WHEN d % 7 = 0 THEN NULL ELSE 'claude-haiku-4-5-20251001' END"),
        ("generator_temperature", "CASE WHEN d > 15 THEN CAST(0.0 AS DOUBLE) END"),
        ("judge", "CASE WHEN et = 'error' THEN 'semantic-judge-v2' ELSE 'deterministic-v1' END"),
        ("questions_path", "'eval/questions.jsonl'"),
        ("num_questions", "d + 40"),
        ("system_prompt_sha256", "substr(md5(et), 1, 16)"),
        ("corpus_build_id",
         f"CASE WHEN d <= 10 THEN NULL WHEN d > 27 THEN 'full-ffffffff' "
         f"ELSE {corpus_id('((d * 7) % 97)', dia)} END"),
        ("harness_version", "CASE WHEN d <= 20 THEN 'harness-v1' ELSE 'harness-v2' END"),
    ]


def answer_fields(dia: str) -> list[tuple[str, str]]:
    """Scored-answer fields per event (top level); NULL = key absent."""
    s = dialect(dia)["STR"]
    err = "(k % 20 = 0)"
    ret = retriever()
    return [
        ("question_id", f"'q-' || CAST(eid AS {s})"),
        ("type_id", _pick("u % 11", TYPE_IDS)),
        ("scoring", f"CASE WHEN u % 50 = 49 THEN NULL ELSE {_pick('u % 6', SCORINGS)} END"),
        ("question", f"'What about item ' || CAST(eid AS {s}) || '?'"),
        ("retriever", ret),
        ("generator_provider", "CASE WHEN u % 10 = 0 THEN 'ollama' ELSE 'anthropic' END"),
        ("generator_model", "CASE WHEN u % 10 = 0 THEN 'qwen2.5:3b-instruct' ELSE 'claude-haiku-4-5' END"),
        ("generator_model_resolved",
         f"CASE WHEN k % 7 = 0 THEN NULL WHEN u % 10 = 0 THEN 'qwen2.5:3b-instruct' "
         f"ELSE 'claude-haiku-4-5-' || CAST(20250000 + (eid * 7 + k) % {MODEL_SPACE} AS {s}) END"),
        ("generator_temperature",
         "CASE WHEN d > 15 THEN CASE WHEN u % 2 = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(0.7 AS DOUBLE) END END"),
        ("score", f"CASE WHEN {err} THEN NULL WHEN k % 3 = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"),
        ("passed", f"CASE WHEN {err} THEN NULL ELSE (k % 3 = 0) END"),
        ("judged", f"NOT {err}"),
        ("verdict", f"CASE WHEN {err} THEN 'error' WHEN k % 3 = 0 THEN 'pass' ELSE 'fail' END"),
        ("error", f"CASE WHEN {err} THEN 'timeout after ' || CAST(eid AS {s}) || ' ms' WHEN k % 20 = 10 THEN '' END"),
        ("input_tokens", "CAST(100 + k AS BIGINT)"),
        ("output_tokens", "CAST(k + u % 5 AS BIGINT)"),
        ("cache_read_input_tokens", "CASE WHEN k % 2 = 0 THEN CAST(2 * k AS BIGINT) END"),
        ("cache_creation_input_tokens", "CASE WHEN k % 2 = 0 THEN CAST(k % 11 AS BIGINT) END"),
        ("context_tokens_proxy", "CAST(10 * k AS BIGINT)"),
        ("num_sources", "k % 12"),
        ("retrieval_latency_ms",
         f"CASE WHEN {err} THEN NULL WHEN {ret} = 'closed_book' THEN CAST(0.0 AS DOUBLE) ELSE val END"),
        ("generation_latency_ms", f"CASE WHEN {err} THEN NULL ELSE val / 2 END"),
    ]


def traversal_fields(dia: str) -> list[tuple[str, str]]:
    """Keys of ``traversal_info`` (object absent when k % 4 = 0); NULL = key absent."""
    s = dialect(dia)["STR"]
    ret = retriever()
    return [
        ("retriever", f"CASE WHEN {ret} = 'closed_book' THEN 'none' END"),
        ("mechanism",
         f"CASE WHEN {ret} = 'vector' THEN 'dense' "
         f"WHEN {ret} IN ('graph_neighborhood_1hop', 'graph_neighborhood_2hop') THEN 'neighborhood' "
         f"WHEN {ret} = 'graph_sparqlgen' THEN 'sparqlgen' END"),
        ("hops",
         f"CASE WHEN {ret} = 'graph_neighborhood_1hop' THEN 1 WHEN {ret} = 'graph_neighborhood_2hop' THEN 2 END"),
        ("num_triples", f"CASE WHEN {ret} LIKE 'graph_neighborhood%' THEN 3 * k END"),
        ("num_linked", f"CASE WHEN {ret} LIKE 'graph_neighborhood%' THEN k % 5 END"),
        ("top_k", f"CASE WHEN {ret} = 'vector' THEN CASE WHEN u % 2 = 0 THEN 5 ELSE 10 END END"),
        ("num_chunks", f"CASE WHEN {ret} = 'vector' THEN k % 7 END"),
        ("embed_model", f"CASE WHEN {ret} = 'vector' THEN 'all-MiniLM-L6-v2' END"),
        ("writer_model",
         f"CASE WHEN {ret} = 'graph_sparqlgen' THEN "
         f"CASE WHEN d % 2 = 0 THEN 'claude-haiku-4-5-' ELSE 'claude-sonnet-4-5-' END "
         f"|| CAST(20250000 + (eid * 3) % {MODEL_SPACE} AS {s}) END"),
        ("writer_temperature",
         f"CASE WHEN {ret} = 'graph_sparqlgen' AND d > 10 THEN CAST(0.0 AS DOUBLE) END"),
        ("writer_input_tokens", f"CASE WHEN {ret} = 'graph_sparqlgen' THEN CAST(500 + k AS BIGINT) END"),
        ("writer_output_tokens", f"CASE WHEN {ret} = 'graph_sparqlgen' THEN CAST(100 + k % 50 AS BIGINT) END"),
        ("sparql_valid", f"CASE WHEN {ret} = 'graph_sparqlgen' THEN (k % 2 = 1) END"),
        ("num_rows", f"CASE WHEN {ret} = 'graph_sparqlgen' THEN k % 9 END"),
        ("endpoint",
         f"CASE WHEN {ret} LIKE 'graph%' THEN 'http://graph.invalid/sparql' END"),
        ("context_tokenizer", f"CASE WHEN {ret} <> 'closed_book' AND d > 20 THEN 'wordpunct-v1' END"),
    ]


TRAVERSAL_PRESENT = "(k % 4 <> 0)"


def question_fields(dia: str) -> list[tuple[str, str]]:
    """Question-bank fields per event (bank skips u % 13 = 12). ground_truth/seeds separate."""
    s = dialect(dia)["STR"]
    return [
        ("question_id", f"'q-' || CAST(eid AS {s})"),
        ("type_id", _pick("u % 11", TYPE_IDS)),
        ("template_id", f"'tpl-' || CAST(u % 7 AS {s})"),
        ("scoring", _pick("u % 6", SCORINGS)),
        ("answer_var", "'answer'"),
        ("question", f"'What about item ' || CAST(eid AS {s}) || '?'"),
    ]


# The bank deliberately lacks the questions of one user class, so some answers point at a
# question the bank does not have (what the coverage check, the NULL-key grouping and the
# label fallback exist for). It shapes the input only: every event is still an answer and
# every query runs over all of them.
QUESTION_PRESENT = "(u % 13 <> 12)"
# ground truth shape by k % 5: 0 scalar, 1 two elements, 2 empty array, 3 ["", null, x], 4 [null]
# seeds: absent when k % 3 = 0, else an array of k % 4 elements


def profile_fields(dia: str) -> list[tuple[str, str]]:
    """Corpus profile per supplier row (s_suppkey ...)."""
    s = dialect(dia)["STR"]
    smoke = "(s_suppkey % 4 = 0)"
    return [
        ("corpus_build_id", corpus_id("s_suppkey", dia)),
        ("scale", f"CASE WHEN {smoke} THEN 'smoke' ELSE 'full' END"),
        ("measured_at", f"'2026-06-' || lpad(CAST(1 + s_suppkey % 28 AS {s}), 2, '0') || 'T10:20:30+0200'"),
        ("graph_ttl_bytes", "CAST(s_suppkey * 1000 + 17 AS BIGINT)"),
        ("graph_ttl_sha256", "md5(s_name)"),
        ("graph_triples", f"CASE WHEN {smoke} THEN NULL ELSE CAST(s_suppkey * 100 + 1 AS BIGINT) END"),
        ("graph_nodes", f"CASE WHEN {smoke} THEN NULL ELSE CAST(s_suppkey * 10 + 2 AS BIGINT) END"),
        ("graph_edges", f"CASE WHEN {smoke} THEN NULL ELSE CAST(s_suppkey * 50 + 3 AS BIGINT) END"),
        ("vector_store_bytes", "CAST(s_suppkey * 7919 + 654321 AS BIGINT)"),
        ("vector_n_chunks", "CAST(s_suppkey * 3 + 1 AS BIGINT)"),
        ("vector_n_abstracts", "CAST(s_suppkey + 15 AS BIGINT)"),
        ("vector_n_words", "CAST(s_suppkey * 40 + 2718 AS BIGINT)"),
        ("vector_embed_model", "'sentence-transformers/all-MiniLM-L6-v2'"),
        ("vector_chunk_size", "256"),
        ("vector_chunk_overlap", "48"),
    ]


def family_case(col: str = "p_type") -> str:
    whens = " ".join(f"WHEN '{t}' THEN '{f}'" for t, f in FAMILY_BY_PART_TYPE.items())
    return f"CASE {col} {whens} END"


def price_fields(dia: str) -> list[tuple[str, str]]:
    """Catalog entry per part row. Prices are cents per token (decimals)."""
    s = dialect(dia)["STR"]
    base = "CAST(p_size % 10 + 1 AS DECIMAL(10,0))"
    no_cache = "(p_size % 7 = 0)"
    return [
        ("provider", f"'vendor' || substr(p_brand, 7) || '-' || CAST(CAST(floor(p_partkey / 5000) AS BIGINT) AS {s})"),
        ("model_key", f"{family_case()} || '-' || CAST(20250000 + p_partkey AS {s})"),
        ("request", f"CAST({base} * 0.00001 AS DECIMAL(12,8))"),
        ("response", f"CAST({base} * 0.00005 AS DECIMAL(12,8))"),
        ("cache_read", f"CASE WHEN {no_cache} THEN NULL ELSE CAST({base} * 0.000001 AS DECIMAL(12,8)) END"),
        ("cache_write", f"CASE WHEN {no_cache} THEN NULL ELSE CAST({base} * 0.0000125 AS DECIMAL(12,8)) END"),
    ]


FETCHED_AT = "2026-06-27"
CATALOG_REF = "main"
OLD_BATCH = "20240115T000000Z"
NEW_BATCH = "20240201T000000Z"
OLD_BATCH_DAYS = 5  # runs of days 1..5 also have an older manifest copy (harness-v0)
