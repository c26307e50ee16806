"""Ad-hoc analyses (O5, O6): bounded previews of every relation and the observed
combinations of condition knobs. A limit is the feature here, always after a total order
so the preview is reproducible."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .marts import MARTS, Relations
from .staging import stg_scored_answers, stg_traversal

PREVIEW_ROWS = 100
# condition / knob columns of the enriched grain (current names)
CONDITION_COLUMNS = ["retriever", "mechanism", "neighborhood_hops", "top_k", "generator_provider",
                     "generator_model_family", "writer_model_family", "harness_version"]


def preview(df: DataFrame, order_by: list[str], n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows by a total order (a top-n, not a full sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)


def previews(pipe: Relations, marts_dir: str, n: int = PREVIEW_ROWS) -> dict[str, DataFrame]:
    """O5 for every raw, staging, intermediate and mart relation."""
    sp = pipe.spark
    rel: dict[str, tuple[DataFrame, list[str]]] = {
        "raw_run_manifest": (pipe.raw("run_manifest"), ["run_id"]),
        "raw_scored_answer": (pipe.raw("scored_answer"), ["run_id", "question_id"]),
        "raw_question": (pipe.raw("question"), ["question_id"]),
        "stg_runs": (pipe.runs(), ["run_id"]),
        "stg_scored_answers": (stg_scored_answers(pipe.raw("scored_answer")), ["run_id", "question_id"]),
        "stg_traversal": (stg_traversal(pipe.raw("scored_answer")), ["run_id", "question_id"]),
        "stg_questions": (pipe.questions(), ["question_id"]),
        "int_scored_answers_enriched": (pipe.enriched(), ["run_id", "question_id"]),
    }
    keys = {"dim_run": "run_sk", "dim_question": "question_sk", "dim_retriever_cond": "retriever_cond_sk",
            "dim_generator": "generator_sk", "dim_writer": "writer_sk", "dim_scoring": "scoring_sk",
            "dim_corpus": "corpus_sk", "dim_token_pricing": "pricing_sk", "fct_scored_answer": "scored_answer_sk"}
    for m in MARTS:
        rel[m] = (read_table(sp, f"{marts_dir.rstrip('/')}/{m}"), [keys[m]])
    return {name: preview(df, order, n) for name, (df, order) in rel.items()}


def condition_combinations(enriched: DataFrame, n: int = 1000) -> DataFrame:
    """Distinct combinations of the condition knobs, first ``n`` in a total order."""
    return preview(enriched.select(*CONDITION_COLUMNS).distinct(), CONDITION_COLUMNS, n)
