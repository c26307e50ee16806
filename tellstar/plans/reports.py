"""Report relations (B1-B11): the data side of every dashboard block.

Reports read only the marts (through ``load_mart``: decimals as doubles), keep filters,
joins and aggregations in one lazy plan, and return small aggregated frames. Chart
drawing is not part of this package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import coalesce_sum, guarded_ratio, not_in_or_null, passed_flag, starts_with_or_false
from ..operators.aggregates import (
    count_distinct,
    distinct_sorted_list,
    drop_null_keys,
    first_row_per_group,
    group_sizes,
    pass_rates,
    side_by_side,
)
from ..operators.reshape import unpivot
from .marts import load_mart

# Fixed values of the reports: the generator family most views pin, and retrievers
# superseded by newer conditions (excluded from comparisons).
HAIKU_FAMILY = "claude-haiku-4-5"
LEGACY_RETRIEVERS = ["graph_neighborhood"]
SPARQL_RETRIEVER = "graph_sparqlgen"
NO_VALUE = "—"
UNANSWERABLE = "— (unanswerable)"
# grouping columns of the matrices: the axes, and the labels and sort keys that depend on them
QUESTION_TYPE = ["type_id", "type_display_label"]
RETRIEVER_BY_TYPE = ["display_label", "sort_order", *QUESTION_TYPE]
WRITER_BY_TYPE = ["writer_model_family", *QUESTION_TYPE]
HARNESS_BY_TYPE = ["harness_version", *QUESTION_TYPE]


def analysis_frame(spark: SparkSession, marts_dir: str) -> DataFrame:
    """B1: the fact with the dimension attributes each view slices on.

    Small dimensions are broadcast by the planner from their file statistics; a large one
    (the question bank) is joined by shuffle, so no dimension has to fit in memory."""
    fct = load_mart(spark, marts_dir, "fct_scored_answer")
    dim_q = load_mart(spark, marts_dir, "dim_question").select(
        "question_sk", "type_id", "type_display_label", "question_hop_count"
    )
    dim_ret = load_mart(spark, marts_dir, "dim_retriever_cond").select(
        "retriever_cond_sk", "display_label", "retriever", "mechanism", "sort_order"
    )
    dim_gen = load_mart(spark, marts_dir, "dim_generator").select("generator_sk", "generator_model_family")
    dim_writer = load_mart(spark, marts_dir, "dim_writer").select("writer_sk", "writer_model", "writer_model_family")
    dim_run = load_mart(spark, marts_dir, "dim_run").select("run_sk", "harness_version")
    df = (
        fct.join(dim_q, "question_sk", "left")
        .join(dim_ret, "retriever_cond_sk", "left")
        .join(dim_gen, "generator_sk", "left")
        .join(dim_writer, "writer_sk", "left")
        .join(dim_run, "run_sk", "left")
    )
    return (
        df.withColumn("type_display_label", F.coalesce("type_display_label", "type_id"))
        .withColumn("passed", passed_flag("is_passed"))
        .withColumn("total_tokens", coalesce_sum("generator_total_tokens", "writer_total_tokens"))
    )


SERVING_TABLE = "_serving/analysis_frame"
#: The columns that the reports' filters pin (F2, F3), which the serving table's files are sorted by.
SERVING_ORDER = ["generator_model_family", "retriever"]


def clustered(df: DataFrame) -> DataFrame:
    """``df`` with each task's rows sorted by ``SERVING_ORDER``: written like this, a value lies in
    few row groups and pages of a file, and a filter on it skips the others by their minimum and
    maximum. No row moves to another task, so a family with a third of all rows is no hot key."""
    return df.sortWithinPartitions(*SERVING_ORDER)


def materialize_analysis(spark: SparkSession, marts_dir: str) -> str:
    """Write B1 once as a serving table (the fact joined with its dimensions), ``clustered``.

    Every report slices the same denormalised frame; computing the 5-way join once per
    build instead of once per report removes the shuffle join against the question
    dimension from every report query."""
    from ..sources.tables import write_snapshot

    return write_snapshot(clustered(analysis_frame(spark, marts_dir)), f"{marts_dir.rstrip('/')}/{SERVING_TABLE}")


def load_analysis(spark: SparkSession, marts_dir: str) -> DataFrame:
    """The materialised B1 of a build when present, else computed from the marts."""
    from ..sources.tables import latest_snapshot

    snap = latest_snapshot(spark, f"{marts_dir.rstrip('/')}/{SERVING_TABLE}")
    return spark.read.parquet(snap) if snap else analysis_frame(spark, marts_dir)


def question_type_axis(df: DataFrame) -> DataFrame:
    """O1: the question types that occur, in the order of their ids, with the rank of each."""
    types = drop_null_keys(df, ["type_id"]).select(*QUESTION_TYPE).distinct()
    return types.withColumn("rank", F.dense_rank().over(Window.orderBy("type_id"))).orderBy("rank", "type_display_label")


# ---- filters

def exclude_legacy(df: DataFrame) -> DataFrame:
    """drop legacy retrievers; a NULL retriever is kept."""
    return df.where(not_in_or_null("retriever", LEGACY_RETRIEVERS))


def fixed_generator(df: DataFrame, family: str = HAIKU_FAMILY) -> DataFrame:
    """F2."""
    return df.where(F.col("generator_model_family") == family)


def sparql_only(df: DataFrame) -> DataFrame:
    """the SPARQL-generating retriever with the fixed generator."""
    return fixed_generator(df).where(F.col("retriever") == SPARQL_RETRIEVER)


def harness_slice(df: DataFrame) -> DataFrame:
    """fixed generator, no legacy, writer absent or of the same family."""
    w = F.col("writer_model").isNull() | starts_with_or_false("writer_model", HAIKU_FAMILY)
    return exclude_legacy(fixed_generator(df)).where(w)


# ---- reports

def headline_kpis(df: DataFrame) -> DataFrame:
    """Scored, pass_rate (0.0 when empty), num_correct, total_cost, cost_per_correct."""
    total_cost = F.coalesce(F.sum(F.coalesce("total_cost_usd", F.lit(0.0))), F.lit(0.0))
    correct = F.coalesce(F.sum("passed"), F.lit(0)).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("scored"),
        F.coalesce(F.avg("passed"), F.lit(0.0)).alias("pass_rate"),
        correct.alias("num_correct"),
        total_cost.alias("total_cost"),
    ).withColumn("cost_per_correct", guarded_ratio("total_cost", "num_correct"))


def best_retriever(df: DataFrame) -> DataFrame:
    """Highest-accuracy retriever label outside the legacy set; ties -> first label.

    ``min_by`` over (-accuracy, label) is an exact argmax with a deterministic tie-break
    and stays a two-phase aggregate. Returns one row; label '—' when nothing qualifies."""
    per = (
        drop_null_keys(exclude_legacy(df), ["display_label"])
        .groupBy("display_label")
        .agg((F.sum("passed") / F.count(F.lit(1))).alias("accuracy"))
    )
    rank = F.struct((-F.col("accuracy")).alias("neg"), F.col("display_label"))
    return per.agg(
        F.coalesce(F.min_by("display_label", rank), F.lit(NO_VALUE)).alias("best_label"),
        F.max("accuracy").alias("best_accuracy"),
    )


def report_headline(df: DataFrame) -> DataFrame:
    """B2: the four KPIs in one row (two one-row aggregates side by side, no join)."""
    return side_by_side(headline_kpis(df), best_retriever(df))


def report_cost_per_correct(df: DataFrame) -> DataFrame:
    """B3 (A9): per retriever label: cost, correct, accuracy, cost/correct, latency."""
    g = drop_null_keys(exclude_legacy(df), ["display_label", "sort_order"]).groupBy("display_label", "sort_order").agg(
        F.coalesce(F.sum("total_cost_usd"), F.lit(0.0)).alias("total_cost"),
        F.sum("passed").cast("bigint").alias("correct"),
        F.count(F.lit(1)).alias("total"),
        F.avg("retrieval_latency_ms").alias("avg_retrieval_ms"),
        F.avg("generation_latency_ms").alias("avg_generation_ms"),
    )
    return g.select(
        "*",
        (F.col("correct") / F.col("total")).alias("accuracy"),
        guarded_ratio("total_cost", "correct").alias("cost_per_correct"),
        coalesce_sum("avg_retrieval_ms", "avg_generation_ms").alias("avg_latency_ms"),
    ).orderBy("sort_order")


def report_accuracy_matrix(df: DataFrame) -> DataFrame:
    """Accuracy by retriever x question type, fixed generator, legacy excluded."""
    return pass_rates(exclude_legacy(fixed_generator(df)), RETRIEVER_BY_TYPE)


def report_writer_matrix(df: DataFrame) -> DataFrame:
    """Accuracy by writer family x question type, SPARQL retriever only."""
    return pass_rates(sparql_only(df), WRITER_BY_TYPE)


def latency_split(df: DataFrame) -> DataFrame:
    """A10: mean of each phase per retriever label (NULLs skipped), n = rows."""
    return drop_null_keys(df, ["display_label", "sort_order"]).groupBy("display_label", "sort_order").agg(
        F.avg("retrieval_latency_ms").alias("Retrieval"),
        F.avg("generation_latency_ms").alias("Generation"),
        F.count(F.lit(1)).alias("n"),
    )


def report_latency_split(df: DataFrame) -> DataFrame:
    """Phase means per retriever in long form (R1) with a pinned phase order."""
    wide = latency_split(exclude_legacy(fixed_generator(df)))
    return unpivot(wide, ["display_label", "sort_order", "n"], ["Retrieval", "Generation"], "phase",
                   "avg_latency_ms", order_col="phase_order")


def report_ground_truth(dim_question: DataFrame) -> DataFrame:
    """One whole example row per question type (W1), with the type's size."""
    cols = ["question_id", "type_display_label", "type_description", "question_text", "ground_truth_answer_text"]
    first = first_row_per_group(dim_question, "type_id", "question_id", cols)
    sizes = group_sizes(dim_question, "type_id", "n_questions")
    j = first.join(sizes, first["type_id"].eqNullSafe(sizes["type_id"]), "left").drop(sizes["type_id"])
    return j.select(
        "type_id",
        F.coalesce("type_display_label", "type_id").alias("type_display_label"),
        F.coalesce("type_description", F.lit(NO_VALUE)).alias("type_description"),
        F.when(F.col("type_id").isNotNull(), F.col("n_questions")).alias("n_questions"),
        "question_text",
        F.coalesce("ground_truth_answer_text", F.lit(UNANSWERABLE)).alias("ground_truth_answer_text"),
    )


def report_pricing_reference(dim_pricing: DataFrame) -> DataFrame:
    """The price catalog behind every cost figure, sorted (O3)."""
    return dim_pricing.select(
        "provider", "model_resolved", "input_usd_per_mtok", "output_usd_per_mtok",
        "cache_read_usd_per_mtok", "cache_write_usd_per_mtok", "effective_date", "pricing_source",
    ).orderBy("provider", "model_resolved")


def report_token_usage(df: DataFrame) -> DataFrame:
    """Avg tokens and accuracy per retriever x type (fixed generator, no legacy)."""
    return pass_rates(exclude_legacy(fixed_generator(df)), RETRIEVER_BY_TYPE)


def report_harness_evolution(df: DataFrame) -> DataFrame:
    """Accuracy and avg tokens per harness version x type, on the harness slice."""
    return pass_rates(harness_slice(df), HARNESS_BY_TYPE)


def harness_versions(df: DataFrame) -> DataFrame:
    """A15 on the harness slice: how many versions (< 2 means no evolution to show)."""
    return count_distinct(harness_slice(df), "harness_version", "version_count")


def report_writer_series(df: DataFrame) -> DataFrame:
    """The SPARQL slice as writer-family series over question types."""
    return pass_rates(sparql_only(df), WRITER_BY_TYPE)


def writers_pooled(df: DataFrame) -> DataFrame:
    """A12 for the B4 caption: writer models pooled in the matrix, sorted, '—' if none."""
    return distinct_sorted_list(exclude_legacy(fixed_generator(df)), "writer_model")


# Display names of the pricing reference table.
PRICING_DISPLAY_NAMES = {
    "provider": "Provider",
    "model_resolved": "Model",
    "input_usd_per_mtok": "Input $/Mtok",
    "output_usd_per_mtok": "Output $/Mtok",
    "cache_read_usd_per_mtok": "Cache-read $/Mtok",
    "cache_write_usd_per_mtok": "Cache-write $/Mtok",
    "effective_date": "As of",
    "pricing_source": "Source",
}


def display_pricing(df: DataFrame) -> DataFrame:
    """Column subset renamed for display."""
    return df.select(*[F.col(c).alias(n) for c, n in PRICING_DISPLAY_NAMES.items()])


def dashboard(spark: SparkSession, marts_dir: str) -> dict[str, DataFrame]:
    """Every block of the report page as a lazy frame, in page order, plus the data behind
    the captions (writers pooled, writer families, harness versions, price sources)."""
    af = load_analysis(spark, marts_dir)
    pricing = load_mart(spark, marts_dir, "dim_token_pricing")
    return {
        "headline": report_headline(af),
        "cost_per_correct": report_cost_per_correct(af),
        "ground_truth": report_ground_truth(load_mart(spark, marts_dir, "dim_question")),
        "accuracy_matrix": report_accuracy_matrix(af),
        "accuracy_matrix_writers": writers_pooled(af),
        "writer_matrix": report_writer_matrix(af),
        "writer_families": distinct_sorted_list(sparql_only(af), "writer_model_family"),
        "latency_split": report_latency_split(af),
        "pricing_reference": display_pricing(report_pricing_reference(pricing)),
        "pricing_sources": distinct_sorted_list(pricing, "pricing_source"),
        "token_usage": report_token_usage(af),
        "harness_evolution": report_harness_evolution(af),
        "harness_versions": distinct_sorted_list(harness_slice(af), "harness_version"),
        "harness_version_count": harness_versions(af),
        "writer_series": report_writer_series(af),
    }
