"""DuckDB expectations for the harness queries, computed straight from the driver tables.

The relations below re-derive every staging, intermediate and mart relation from the
typed formulas (no JSON on this side), so they check the library's parsing, casting,
joins, keys, cost arithmetic and aggregation independently. ``PRELUDE`` holds them as
CTEs; each oracle query is ``PRELUDE + final SELECT``.
"""

from __future__ import annotations

from decimal import Decimal

from ..sources.seeds import SCHEMAS, seed_rows
from . import formulas as fm

D = "duckdb"


def sk(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS varchar), '∅')" for e in exprs)
    return f"md5(concat_ws('|', {parts}))"


def family(e: str) -> str:
    return f"regexp_replace({e}, '-\\d{{8}}$', '')"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, Decimal)):
        return str(v)
    if hasattr(v, "isoformat"):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("'", "''") + "'"


_DUCK_TYPES = {"StringType": "varchar", "BooleanType": "boolean", "IntegerType": "integer", "DateType": "date"}


def seed_values(name: str) -> str:
    schema = SCHEMAS[name]
    cols = [f.name for f in schema.fields]
    types = []
    for f in schema.fields:
        t = type(f.dataType).__name__
        types.append(f"decimal({f.dataType.precision},{f.dataType.scale})" if t == "DecimalType" else _DUCK_TYPES[t])
    rows = seed_rows(name)
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in zip(cols, types))
        return f"SELECT {nulls} WHERE FALSE"
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in zip(cols, types))
    return f"SELECT {casts} FROM (VALUES {body}) AS t({', '.join(cols)})"


def _fields(fields, prefix):
    return ", ".join(f"{e} AS {prefix}{n}" for n, e in fields)


MECH_CASE = (
    "CASE WHEN a_retriever = 'vector' THEN 'dense' WHEN a_retriever LIKE 'graph_neighborhood%' THEN 'neighborhood' "
    "WHEN a_retriever = 'graph_sparqlgen' THEN 'sparqlgen' WHEN a_retriever = 'closed_book' THEN 'none' END"
)


def _t(name: str) -> str:
    return f"CASE WHEN ti_present THEN t_{name} END"


def _ctes() -> list[tuple[str, str]]:
    pf = dict(fm.profile_fields(D))
    pr = dict(fm.price_fields(D))
    gt = (
        "CASE k % 5 WHEN 0 THEN 'gt-' || CAST(eid AS varchar) "
        "WHEN 1 THEN 'a-' || CAST(eid AS varchar) || ', b-' || CAST(eid AS varchar) "
        "WHEN 2 THEN NULL WHEN 3 THEN ', c-' || CAST(eid AS varchar) ELSE NULL END"
    )
    rates = lambda m: f"CAST(CAST(p_size % 10 + 1 AS DECIMAL(10,0)) * {m} AS DECIMAL(14,6))"
    no_cache = "(p_size % 7 = 0)"
    run_f = dict(fm.run_fields(D))
    cost = lambda pairs: (
        "CAST((" + " + ".join(f"CAST(coalesce({t}, 0) AS DECIMAL(12,0)) * {r}" for t, r in pairs)
        + ") * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(38,12))"
    )
    return [
        ("ev", fm.ev_sql(D)),
        ("ans", f"SELECT ev.*, et || '-' || ymd AS run_id, {fm.TRAVERSAL_PRESENT} AS ti_present, "
                f"{_fields(fm.answer_fields(D), 'a_')}, {_fields(fm.traversal_fields(D), 't_')} FROM ev"),
        ("sa", f"""SELECT run_id, a_question_id AS question_id, eid, u, k, d, line_no,
            a_retriever AS retriever, a_scoring AS scoring, a_generator_provider AS generator_provider,
            a_generator_model AS generator_model, a_generator_model_resolved AS generator_model_resolved,
            coalesce(a_generator_model_resolved, a_generator_model) AS generator_model_id,
            {family('coalesce(a_generator_model_resolved, a_generator_model)')} AS generator_model_family,
            a_generator_temperature AS generator_temperature, a_score AS score, a_passed AS is_passed,
            a_judged AS is_judged, a_verdict AS verdict, nullif(a_error, '') AS error,
            a_input_tokens AS generator_input_tokens, a_output_tokens AS generator_output_tokens,
            a_cache_read_input_tokens AS generator_cache_read_tokens,
            a_cache_creation_input_tokens AS generator_cache_creation_tokens,
            a_context_tokens_proxy AS context_tokens_proxy, a_num_sources AS num_sources,
            a_retrieval_latency_ms AS retrieval_latency_ms, a_generation_latency_ms AS generation_latency_ms,
            coalesce({_t('mechanism')}, {MECH_CASE}) AS mechanism,
            {_t('hops')} AS neighborhood_hops, {_t('num_triples')} AS neighborhood_num_triples,
            {_t('num_linked')} AS neighborhood_num_linked, {_t('top_k')} AS top_k,
            {_t('num_chunks')} AS dense_num_chunks, {_t('embed_model')} AS embed_model,
            {_t('writer_model')} AS writer_model, {family(_t('writer_model'))} AS writer_model_family,
            {_t('writer_temperature')} AS writer_temperature,
            {_t('writer_input_tokens')} AS writer_input_tokens, {_t('writer_output_tokens')} AS writer_output_tokens,
            {_t('sparql_valid')} AS is_sparql_valid, {_t('num_rows')} AS sparql_num_rows,
            {_t('endpoint')} AS endpoint, {_t('context_tokenizer')} AS context_tokenizer
            FROM (SELECT *, CAST(row_number() OVER (PARTITION BY run_id ORDER BY eid) - 1 AS INTEGER) AS line_no
                  FROM ans)"""),
        ("rv", "SELECT DISTINCT et, d, ymd, ymd_dash FROM ev"),
        ("runs", f"""SELECT {run_f['run_id']} AS run_id,
            CAST(ymd_dash || ' 07:30:00' AS TIMESTAMP) AS run_ts,
            {run_f['retriever']} AS retriever, {run_f['generator_provider']} AS generator_provider,
            {run_f['generator_model']} AS generator_model,
            {run_f['generator_model_resolved']} AS generator_model_resolved,
            {run_f['generator_temperature']} AS generator_temperature, {run_f['judge']} AS judge_model,
            {run_f['corpus_build_id']} AS corpus_build_id, {run_f['harness_version']} AS harness_version,
            CAST({run_f['num_questions']} AS INTEGER) AS num_questions,
            {run_f['system_prompt_sha256']} AS generator_system_prompt_sha256, d
            FROM rv"""),
        ("questions", f"""SELECT {', '.join(f'{e} AS {n}' for n, e in fm.question_fields(D) if n != 'question')},
            'What about item ' || CAST(eid AS varchar) || '?' AS question_text,
            {gt} AS ground_truth_answer_text,
            CAST(CASE WHEN {_pick_type()} LIKE '%3plus_hop%' THEN 3 WHEN {_pick_type()} LIKE '%2hop%' THEN 2
                 WHEN {_pick_type()} LIKE '%1hop%' THEN 1 WHEN {_pick_type()} LIKE '%0hop%' THEN 0 END AS INTEGER)
                 AS question_hop_count,
            CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE k % 4 END AS INTEGER) AS num_seed_entities, eid, u, k
            FROM ev WHERE {fm.QUESTION_PRESENT}"""),
        ("profiles", f"""SELECT {pf['corpus_build_id']} AS corpus_build_id, {pf['scale']} AS corpus_scale,
            CAST('2026-06-' || lpad(CAST(1 + s_suppkey % 28 AS varchar), 2, '0') || ' 08:20:30' AS TIMESTAMP)
                AS corpus_measured_at,
            {pf['graph_triples']} AS triple_count, {pf['graph_nodes']} AS node_count,
            {pf['graph_edges']} AS edge_count, {pf['graph_ttl_bytes']} AS ttl_bytes,
            {pf['graph_ttl_sha256']} AS ttl_sha256, {pf['vector_n_abstracts']} AS paper_count,
            {pf['vector_n_chunks']} AS chunk_count, {pf['vector_n_words']} AS word_count,
            CAST({pf['vector_chunk_size']} AS INTEGER) AS chunk_size,
            CAST({pf['vector_chunk_overlap']} AS INTEGER) AS chunk_overlap,
            {pf['vector_store_bytes']} AS store_bytes, {pf['vector_embed_model']} AS embed_model
            FROM supplier"""),
        ("catalog", f"""SELECT {pr['provider']} AS provider, {pr['model_key']} AS model_resolved,
            {pr['model_key']} AS portkey_model_key,
            {rates('0.1')} AS input_usd_per_mtok, {rates('0.5')} AS output_usd_per_mtok,
            CASE WHEN {no_cache} THEN NULL ELSE {rates('0.01')} END AS cache_read_usd_per_mtok,
            CASE WHEN {no_cache} THEN NULL ELSE {rates('0.125')} END AS cache_write_usd_per_mtok,
            DATE '{fm.FETCHED_AT}' AS effective_date,
            'portkey-ai/models @ {fm.CATALOG_REF}, fetched {fm.FETCHED_AT}' AS source_note
            FROM part"""),
        ("overrides", seed_values("seed_pricing_local_overrides")),
        ("pricing", f"""SELECT {sk('provider', 'model_resolved')} AS pricing_sk, provider, model_resolved,
                input_usd_per_mtok, output_usd_per_mtok, cache_read_usd_per_mtok, cache_write_usd_per_mtok,
                effective_date, source_note, 'usd_per_mtok' AS rate_unit, 'override' AS pricing_source
              FROM overrides
            UNION ALL
            SELECT {sk('provider', 'model_resolved')}, provider, model_resolved,
                input_usd_per_mtok, output_usd_per_mtok, cache_read_usd_per_mtok, cache_write_usd_per_mtok,
                effective_date, source_note, 'usd_per_mtok', 'portkey'
              FROM catalog WHERE model_resolved NOT IN (SELECT model_resolved FROM overrides)"""),
        ("retriever_labels", seed_values("seed_retriever_labels")),
        ("alias_seed", seed_values("seed_pricing_model_alias")),
        ("scoring_labels", seed_values("seed_scoring_labels")),
        ("type_labels", seed_values("seed_question_type_labels")),
        ("enriched", f"""SELECT a.*, r.run_ts, r.judge_model, r.corpus_build_id, r.harness_version,
            r.generator_system_prompt_sha256, q.type_id, q.template_id, q.question_hop_count, q.num_seed_entities,
            a.error IS NOT NULL AS is_error,
            coalesce(a.generator_input_tokens, 0) + coalesce(a.generator_output_tokens, 0) AS generator_total_tokens,
            coalesce(a.retrieval_latency_ms, 0) + coalesce(a.generation_latency_ms, 0) AS total_latency_ms,
            coalesce(a.writer_input_tokens, 0) + coalesce(a.writer_output_tokens, 0) AS writer_total_tokens,
            gp.pricing_sk AS generator_pricing_sk, wp.pricing_sk AS writer_pricing_sk,
            {cost([('a.generator_input_tokens', 'gp.input_usd_per_mtok'),
                   ('a.generator_output_tokens', 'gp.output_usd_per_mtok'),
                   ('a.generator_cache_read_tokens', 'gp.cache_read_usd_per_mtok'),
                   ('a.generator_cache_creation_tokens', 'gp.cache_write_usd_per_mtok')])} AS generator_cost_usd,
            {cost([('a.writer_input_tokens', 'wp.input_usd_per_mtok'),
                   ('a.writer_output_tokens', 'wp.output_usd_per_mtok')])} AS writer_cost_usd
            FROM sa a
            LEFT JOIN questions q ON a.question_id = q.question_id
            LEFT JOIN runs r ON a.run_id = r.run_id
            LEFT JOIN pricing gp ON a.generator_model_resolved = gp.model_resolved
            LEFT JOIN pricing wp ON a.writer_model = wp.model_resolved"""),
        ("fct", f"""SELECT {sk('run_id', 'question_id')} AS scored_answer_sk, {sk('run_id')} AS run_sk,
            {sk('question_id')} AS question_sk,
            {sk('generator_provider', 'generator_model_id', 'generator_temperature')} AS generator_sk,
            {sk('retriever', 'mechanism', 'neighborhood_hops', 'top_k')} AS retriever_cond_sk,
            {sk('writer_model', 'writer_temperature')} AS writer_sk, {sk('scoring')} AS scoring_sk,
            {sk('corpus_build_id')} AS corpus_sk, generator_pricing_sk, writer_pricing_sk,
            score, is_passed, is_judged, is_error, generator_input_tokens, generator_output_tokens,
            generator_cache_read_tokens, generator_cache_creation_tokens,
            CAST(generator_total_tokens AS BIGINT) AS generator_total_tokens, context_tokens_proxy, num_sources,
            retrieval_latency_ms, generation_latency_ms, CAST(total_latency_ms AS DOUBLE) AS total_latency_ms,
            neighborhood_num_triples, neighborhood_num_linked, dense_num_chunks, writer_input_tokens,
            writer_output_tokens, CAST(writer_total_tokens AS BIGINT) AS writer_total_tokens, is_sparql_valid,
            sparql_num_rows, generator_cost_usd, writer_cost_usd,
            CAST(coalesce(generator_cost_usd, 0) + coalesce(writer_cost_usd, 0) AS DECIMAL(38,12)) AS total_cost_usd
            FROM enriched"""),
        ("dim_question", f"""SELECT {sk('q.question_id')} AS question_sk, q.question_id, q.type_id, l.type_family,
            l.display_label AS type_display_label, l.description AS type_description, q.template_id, q.scoring,
            q.question_hop_count, q.num_seed_entities, q.question_text, q.ground_truth_answer_text
            FROM questions q LEFT JOIN type_labels l ON q.type_id = l.type_id"""),
        ("dim_retriever_cond", f"""SELECT {sk('o.retriever', 'o.mechanism', 'o.neighborhood_hops', 'o.top_k')}
              AS retriever_cond_sk, o.retriever, o.mechanism, o.neighborhood_hops, o.top_k,
            l.retriever_family, l.is_graph, l.display_label, l.sort_order
            FROM (SELECT DISTINCT retriever, mechanism, neighborhood_hops, top_k FROM enriched) o
            LEFT JOIN retriever_labels l ON o.retriever = l.retriever"""),
        ("dim_generator", f"""SELECT {sk('generator_provider', 'generator_model_id', 'generator_temperature')}
              AS generator_sk, generator_provider, generator_model_id, generator_model_family, generator_temperature,
            generator_provider = 'ollama' AS is_local
            FROM (SELECT DISTINCT generator_provider, generator_model_id, generator_model_family,
                  generator_temperature FROM enriched)"""),
        ("dim_writer", f"""SELECT {sk('writer_model', 'writer_temperature')} AS writer_sk, writer_model,
            writer_model_family, writer_temperature
            FROM (SELECT DISTINCT writer_model, writer_model_family, writer_temperature FROM enriched)"""),
        ("dim_scoring", f"""SELECT {sk('o.scoring')} AS scoring_sk, o.scoring, l.scoring_family, l.display_label
            FROM (SELECT DISTINCT scoring FROM enriched WHERE scoring IS NOT NULL) o
            LEFT JOIN scoring_labels l ON o.scoring = l.scoring"""),
        ("dim_run", f"""SELECT {sk('run_id')} AS run_sk, run_id, run_ts, judge_model, harness_version,
            generator_system_prompt_sha256 FROM runs"""),
        ("dim_corpus", f"""SELECT {sk('o.corpus_build_id')} AS corpus_sk, o.corpus_build_id,
            coalesce(p.corpus_scale, split_part(coalesce(o.corpus_build_id, ''), '-', 1)) AS corpus_scale,
            split_part(coalesce(o.corpus_build_id, ''), '-', 2) AS corpus_sha,
            p.triple_count, p.node_count, p.edge_count, p.paper_count, p.chunk_count, p.word_count,
            p.chunk_size, p.chunk_overlap, p.ttl_bytes, p.ttl_sha256, p.store_bytes, p.embed_model,
            p.corpus_measured_at
            FROM (SELECT corpus_build_id FROM runs UNION SELECT corpus_build_id FROM profiles) o
            LEFT JOIN profiles p ON o.corpus_build_id = p.corpus_build_id"""),
        ("dim_token_pricing", """SELECT pricing_sk, provider, model_resolved, input_usd_per_mtok, output_usd_per_mtok,
            cache_read_usd_per_mtok, cache_write_usd_per_mtok, rate_unit, effective_date, source_note,
            pricing_source FROM pricing"""),
        ("af", """SELECT f.*, q.type_id, coalesce(q.type_display_label, q.type_id) AS type_display_label,
            q.question_hop_count, r.display_label, r.retriever, r.mechanism, r.sort_order,
            g.generator_model_family, w.writer_model, w.writer_model_family, ru.harness_version,
            CAST(coalesce(f.is_passed, FALSE) AS INTEGER) AS passed,
            coalesce(f.generator_total_tokens, 0) + coalesce(f.writer_total_tokens, 0) AS total_tokens,
            CAST(f.total_cost_usd AS DOUBLE) AS total_cost_d
            FROM fct f
            LEFT JOIN dim_question q ON f.question_sk = q.question_sk
            LEFT JOIN dim_retriever_cond r ON f.retriever_cond_sk = r.retriever_cond_sk
            LEFT JOIN dim_generator g ON f.generator_sk = g.generator_sk
            LEFT JOIN dim_writer w ON f.writer_sk = w.writer_sk
            LEFT JOIN dim_run ru ON f.run_sk = ru.run_sk"""),
    ]


def _pick_type() -> str:
    return fm._pick("u % 11", fm.TYPE_IDS)


def prelude() -> str:
    return "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in _ctes()) + "\n"


def q(final_select: str) -> str:
    return prelude() + final_select
