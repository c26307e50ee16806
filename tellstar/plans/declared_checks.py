"""The declared data tests of the pipeline as data (Q1-Q4), and one job that runs them all.

Each entry is (relation, column, test[, args]). Relations are the raw tables, the staging
and intermediate relations, the marts and the seeds; ``run_declared_checks`` evaluates
the whole catalog into one tidy ``(check, relation, column, failures)`` frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import Check, run_checks
from ..sources.seeds import read_seed
from ..sources.tables import latest_entry, read_table, snapshot_path
from .marts import MARTS, RAW_VERSION, Relations, manifest_version
from .staging import explode_answers

# Accepted value lists of the declared tests.
PROVIDERS = ("anthropic", "ollama")
RETRIEVERS = ("closed_book", "vector", "graph_neighborhood", "graph_neighborhood_1hop", "graph_neighborhood_2hop",
              "graph_sparqlgen")
SCORINGS = ("string_match", "set_match", "numerical", "binary", "boolean", "semantic")
MECHANISMS = ("dense", "neighborhood", "sparqlgen", "none")
HOP_COUNTS = (0, 1, 2, 3)
RATE_UNITS = ("usd_per_mtok",)
PRICING_SOURCES = ("portkey", "override")

NN, UQ, AV, REL = "not_null", "unique", "accepted_values", "relationships"


def _c(rel, col, kind, values=(), parent=None, parent_column=None):
    return Check(kind, rel, col, values=values, parent=parent, parent_column=parent_column)


DECLARED: list[Check] = [
    # sources (raw landing tables)
    _c("raw.run_manifest", "run_id", NN), _c("raw.run_manifest", "run_id", UQ),
    _c("raw.scored_answer", "run_id", NN), _c("raw.scored_answer", "question_id", NN),
    _c("raw.question", "question_id", NN), _c("raw.question", "question_id", UQ),
    _c("raw.corpus_profile", "corpus_build_id", NN), _c("raw.corpus_profile", "corpus_build_id", UQ),
    _c("raw.model_pricing", "provider", NN), _c("raw.model_pricing", "provider", UQ),
    # staging
    _c("stg_runs", "run_id", NN), _c("stg_runs", "run_id", UQ), _c("stg_runs", "generator_provider", AV, PROVIDERS),
    _c("stg_scored_answers", "run_id", NN), _c("stg_scored_answers", "question_id", NN),
    _c("stg_scored_answers", "retriever", AV, RETRIEVERS), _c("stg_scored_answers", "scoring", AV, SCORINGS),
    _c("stg_traversal", "run_id", NN), _c("stg_traversal", "question_id", NN),
    _c("stg_traversal", "mechanism", AV, MECHANISMS),
    _c("stg_questions", "question_id", NN), _c("stg_questions", "question_id", UQ),
    _c("stg_questions", "question_hop_count", AV, HOP_COUNTS),
    _c("stg_corpus_profile", "corpus_build_id", NN), _c("stg_corpus_profile", "corpus_build_id", UQ),
    _c("stg_corpus_profile", "paper_count", NN), _c("stg_corpus_profile", "chunk_count", NN),
    _c("stg_corpus_profile", "word_count", NN),
    _c("stg_model_pricing", "model_resolved", NN), _c("stg_model_pricing", "model_resolved", UQ),
    # intermediate
    _c("int_model_pricing", "model_resolved", NN), _c("int_model_pricing", "model_resolved", UQ),
    _c("int_model_pricing", "rate_unit", AV, RATE_UNITS), _c("int_model_pricing", "pricing_source", AV, PRICING_SOURCES),
    # marts: fact
    _c("fct_scored_answer", "scored_answer_sk", UQ),
    *[_c("fct_scored_answer", fk, REL, parent=dim, parent_column=fk) for fk, dim in (
        ("run_sk", "dim_run"), ("question_sk", "dim_question"), ("generator_sk", "dim_generator"),
        ("retriever_cond_sk", "dim_retriever_cond"), ("writer_sk", "dim_writer"), ("scoring_sk", "dim_scoring"),
        ("corpus_sk", "dim_corpus"))],
    _c("fct_scored_answer", "generator_pricing_sk", REL, parent="dim_token_pricing", parent_column="pricing_sk"),
    _c("fct_scored_answer", "writer_pricing_sk", REL, parent="dim_token_pricing", parent_column="pricing_sk"),
    # marts: dimensions
    _c("dim_run", "run_sk", NN), _c("dim_run", "run_sk", UQ), _c("dim_run", "run_id", NN), _c("dim_run", "run_id", UQ),
    _c("dim_question", "question_sk", NN), _c("dim_question", "question_sk", UQ),
    _c("dim_question", "question_id", NN), _c("dim_question", "question_id", UQ),
    _c("dim_question", "question_hop_count", AV, HOP_COUNTS),
    _c("dim_generator", "generator_sk", NN), _c("dim_generator", "generator_sk", UQ),
    _c("dim_generator", "generator_provider", AV, PROVIDERS),
    _c("dim_retriever_cond", "retriever_cond_sk", NN), _c("dim_retriever_cond", "retriever_cond_sk", UQ),
    _c("dim_retriever_cond", "mechanism", AV, MECHANISMS),
    _c("dim_writer", "writer_sk", NN), _c("dim_writer", "writer_sk", UQ),
    _c("dim_scoring", "scoring_sk", NN), _c("dim_scoring", "scoring_sk", UQ),
    _c("dim_scoring", "scoring", NN), _c("dim_scoring", "scoring", UQ),
    _c("dim_corpus", "corpus_sk", NN), _c("dim_corpus", "corpus_sk", UQ), _c("dim_corpus", "corpus_build_id", UQ),
    _c("dim_token_pricing", "pricing_sk", NN), _c("dim_token_pricing", "pricing_sk", UQ),
    _c("dim_token_pricing", "model_resolved", NN), _c("dim_token_pricing", "model_resolved", UQ),
    _c("dim_token_pricing", "rate_unit", AV, RATE_UNITS), _c("dim_token_pricing", "pricing_source", AV, PRICING_SOURCES),
    # seeds
    _c("seed_pricing_local_overrides", "model_resolved", NN), _c("seed_pricing_local_overrides", "model_resolved", UQ),
    _c("seed_pricing_local_overrides", "input_usd_per_mtok", NN),
    _c("seed_pricing_local_overrides", "output_usd_per_mtok", NN),
    _c("seed_pricing_model_alias", "portkey_model_key", NN), _c("seed_pricing_model_alias", "portkey_model_key", UQ),
    _c("seed_retriever_labels", "retriever", NN), _c("seed_retriever_labels", "retriever", UQ),
    _c("seed_scoring_labels", "scoring", NN), _c("seed_scoring_labels", "scoring", UQ),
    _c("seed_question_type_labels", "type_id", NN), _c("seed_question_type_labels", "type_id", UQ),
]

SEEDS = ("seed_pricing_local_overrides", "seed_pricing_model_alias", "seed_retriever_labels", "seed_scoring_labels",
         "seed_question_type_labels")


def relations(spark: SparkSession, raw_dir: str, marts_dir: str) -> dict[str, DataFrame]:
    """Every relation the declared tests name.

    The two staging views of the answers are not parsed again where the enriched grain was built
    from the answers that are live now: it holds one row for each answer (a price join that would
    multiply rows is refused) and carries the tested columns unchanged. If runs were landed after
    the build, the answers themselves are parsed and tested."""
    p = Relations(spark, raw_dir)
    written = f"{marts_dir.rstrip('/')}/_int/int_scored_answers_enriched"
    tested = {c.column for c in DECLARED if c.relation in ("stg_scored_answers", "stg_traversal")}
    grain = latest_entry(spark, written)
    answers = None
    if grain is not None and grain.notes.get(RAW_VERSION) == manifest_version(spark, raw_dir):
        answers = spark.read.parquet(snapshot_path(written, grain))
    if answers is None or not tested <= set(answers.columns):
        answers = explode_answers(p.raw("scored_answer"))
    rel: dict[str, DataFrame] = {f"raw.{t}": p.raw(t) for t in
                                 ("run_manifest", "scored_answer", "question", "corpus_profile", "model_pricing")}
    rel.update({
        "stg_runs": p.runs(),
        # both staging views of the answers are columns of one frame, so they share one pass
        "stg_scored_answers": answers,
        "stg_traversal": answers,
        "stg_questions": p.questions(),
        "stg_corpus_profile": p.profiles(),
        "stg_model_pricing": p.stg_pricing(),
        "int_model_pricing": p.pricing(),
    })
    rel.update({m: read_table(spark, f"{marts_dir.rstrip('/')}/{m}") for m in MARTS})
    rel.update({s: read_seed(spark, s) for s in SEEDS})
    return rel


def run_declared_checks(spark: SparkSession, raw_dir: str, marts_dir: str) -> DataFrame:
    """All declared tests in one job; failures = 0 means the build passes."""
    return run_checks(relations(spark, raw_dir, marts_dir), DECLARED)
