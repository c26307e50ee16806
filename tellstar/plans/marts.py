"""Marts (M9-M17): one fact and eight dimensions keyed by md5 surrogate keys.

``build_star`` materialises the enriched grain once (a written table cuts the lineage and
survives executor loss). The fact and the dimensions observed on the answers (retriever
condition, generator, writer, scoring) are column-pruned reads of that table; run,
question, corpus and pricing dimensions come from their staging relations. Each mart is
written as a committed snapshot; independent marts are submitted concurrently.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import surrogate_key
from ..functions.scalars import COST_TYPE, coalesce_sum, is_local_provider, split_part_or_empty
from ..operators.landing import read_raw
from ..sources.seeds import seed
from ..sources.tables import latest_entry, read_table, write_snapshot
from .intermediate import int_model_pricing, int_scored_answers_enriched
from .staging import stg_corpus_profile, stg_model_pricing, stg_questions, stg_runs

GENERATOR_KEY = ("generator_provider", "generator_model_id", "generator_temperature")
RETRIEVER_KEY = ("retriever", "mechanism", "neighborhood_hops", "top_k")
WRITER_KEY = ("writer_model", "writer_temperature")


def dim_run(runs: DataFrame) -> DataFrame:
    """M9."""
    return runs.select(
        surrogate_key("run_id").alias("run_sk"),
        "run_id",
        "run_ts",
        "judge_model",
        "harness_version",
        "generator_system_prompt_sha256",
    )


def dim_question(questions: DataFrame, type_labels: DataFrame) -> DataFrame:
    """An unseeded type still yields a row (left join to the seed, J9)."""
    labels = type_labels.select(
        "type_id",
        "type_family",
        F.col("display_label").alias("type_display_label"),
        F.col("description").alias("type_description"),
    )
    return questions.join(labels, "type_id", "left").select(
        surrogate_key("question_id").alias("question_sk"),
        "question_id",
        "type_id",
        "type_family",
        "type_display_label",
        "type_description",
        "template_id",
        "scoring",
        "question_hop_count",
        "num_seed_entities",
        "question_text",
        "ground_truth_answer_text",
    )


def dim_retriever_cond(enriched: DataFrame, retriever_labels: DataFrame) -> DataFrame:
    """Distinct conditions (A1; NULLs group together) with seed labels."""
    observed = enriched.select(*RETRIEVER_KEY).distinct()
    return observed.join(retriever_labels, "retriever", "left").select(
        surrogate_key(*RETRIEVER_KEY).alias("retriever_cond_sk"),
        *RETRIEVER_KEY,
        "retriever_family",
        "is_graph",
        "display_label",
        "sort_order",
    )


def dim_generator(enriched: DataFrame) -> DataFrame:
    """M12 (A2): distinct generator configurations."""
    observed = enriched.select(
        "generator_provider", "generator_model_id", "generator_model_family", "generator_temperature"
    ).distinct()
    return observed.select(
        surrogate_key(*GENERATOR_KEY).alias("generator_sk"),
        "generator_provider",
        "generator_model_id",
        "generator_model_family",
        "generator_temperature",
        is_local_provider("generator_provider").alias("is_local"),
    )


def dim_writer(enriched: DataFrame) -> DataFrame:
    """M13 (A3): distinct writer configurations, including the all-NULL member."""
    observed = enriched.select("writer_model", "writer_model_family", "writer_temperature").distinct()
    return observed.select(
        surrogate_key(*WRITER_KEY).alias("writer_sk"), "writer_model", "writer_model_family", "writer_temperature"
    )


def dim_scoring(enriched: DataFrame, scoring_labels: DataFrame) -> DataFrame:
    """M14 (A4, F5, J8): non-NULL scoring types with seed labels."""
    observed = enriched.select("scoring").where(F.col("scoring").isNotNull()).distinct()
    return observed.join(scoring_labels, "scoring", "left").select(
        surrogate_key("scoring").alias("scoring_sk"), "scoring", "scoring_family", "display_label"
    )


def observed_corpora(runs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Corpus ids seen in runs UNION profiled ids (set semantics; NULL kept once)."""
    return runs.select("corpus_build_id").union(profiles.select("corpus_build_id")).distinct()


def dim_corpus(runs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Catalog of corpora; NULL id matches no profile (J10); id parts parsed."""
    o = observed_corpora(runs, profiles)
    p = profiles.withColumnRenamed("corpus_build_id", "_pid")
    j = o.join(p, o["corpus_build_id"] == p["_pid"], "left")
    return j.select(
        surrogate_key("corpus_build_id").alias("corpus_sk"),
        "corpus_build_id",
        F.coalesce(F.col("corpus_scale"), split_part_or_empty("corpus_build_id", "-", 1)).alias("corpus_scale"),
        split_part_or_empty("corpus_build_id", "-", 2).alias("corpus_sha"),
        "triple_count",
        "node_count",
        "edge_count",
        "paper_count",
        "chunk_count",
        "word_count",
        "chunk_size",
        "chunk_overlap",
        "ttl_bytes",
        "ttl_sha256",
        "store_bytes",
        "embed_model",
        "corpus_measured_at",
    )


def dim_token_pricing(pricing: DataFrame) -> DataFrame:
    """The pricing contract as a dimension."""
    return pricing.select(
        "pricing_sk",
        "provider",
        "model_resolved",
        "input_usd_per_mtok",
        "output_usd_per_mtok",
        "cache_read_usd_per_mtok",
        "cache_write_usd_per_mtok",
        "rate_unit",
        "effective_date",
        "source_note",
        "pricing_source",
    )


# Q5: the enforced contract of the fact (names, order, types, NOT NULL key).
FACT_CONTRACT = T.StructType(
    [T.StructField("scored_answer_sk", T.StringType(), False)]
    + [T.StructField(n, T.StringType()) for n in (
        "run_sk", "question_sk", "generator_sk", "retriever_cond_sk", "writer_sk", "scoring_sk", "corpus_sk",
        "generator_pricing_sk", "writer_pricing_sk")]
    + [
        T.StructField("score", T.DoubleType()),
        T.StructField("is_passed", T.BooleanType()),
        T.StructField("is_judged", T.BooleanType()),
        T.StructField("is_error", T.BooleanType()),
    ]
    + [T.StructField(n, T.LongType()) for n in (
        "generator_input_tokens", "generator_output_tokens", "generator_cache_read_tokens",
        "generator_cache_creation_tokens", "generator_total_tokens", "context_tokens_proxy")]
    + [T.StructField("num_sources", T.IntegerType())]
    + [T.StructField(n, T.DoubleType()) for n in ("retrieval_latency_ms", "generation_latency_ms", "total_latency_ms")]
    + [T.StructField(n, T.IntegerType()) for n in ("neighborhood_num_triples", "neighborhood_num_linked", "dense_num_chunks")]
    + [T.StructField(n, T.LongType()) for n in ("writer_input_tokens", "writer_output_tokens", "writer_total_tokens")]
    + [T.StructField("is_sparql_valid", T.BooleanType()), T.StructField("sparql_num_rows", T.IntegerType())]
    + [T.StructField(n, T.DecimalType(38, 12)) for n in ("generator_cost_usd", "writer_cost_usd", "total_cost_usd")]
)


def fct_scored_answer(enriched: DataFrame) -> DataFrame:
    """Surrogate keys only + measures; pricing FKs carried from the cost join."""
    return enriched.select(
        surrogate_key("run_id", "question_id").alias("scored_answer_sk"),
        surrogate_key("run_id").alias("run_sk"),
        surrogate_key("question_id").alias("question_sk"),
        surrogate_key(*GENERATOR_KEY).alias("generator_sk"),
        surrogate_key(*RETRIEVER_KEY).alias("retriever_cond_sk"),
        surrogate_key(*WRITER_KEY).alias("writer_sk"),
        surrogate_key("scoring").alias("scoring_sk"),
        surrogate_key("corpus_build_id").alias("corpus_sk"),
        F.col("generator_pricing_sk").cast("string").alias("generator_pricing_sk"),
        F.col("writer_pricing_sk").cast("string").alias("writer_pricing_sk"),
        "score",
        "is_passed",
        "is_judged",
        "is_error",
        "generator_input_tokens",
        "generator_output_tokens",
        "generator_cache_read_tokens",
        "generator_cache_creation_tokens",
        F.col("generator_total_tokens").cast("bigint").alias("generator_total_tokens"),
        "context_tokens_proxy",
        "num_sources",
        "retrieval_latency_ms",
        "generation_latency_ms",
        F.col("total_latency_ms").cast("double").alias("total_latency_ms"),
        "neighborhood_num_triples",
        "neighborhood_num_linked",
        "dense_num_chunks",
        "writer_input_tokens",
        "writer_output_tokens",
        F.col("writer_total_tokens").cast("bigint").alias("writer_total_tokens"),
        "is_sparql_valid",
        "sparql_num_rows",
        F.col("generator_cost_usd").cast(COST_TYPE).alias("generator_cost_usd"),
        F.col("writer_cost_usd").cast(COST_TYPE).alias("writer_cost_usd"),
        coalesce_sum("generator_cost_usd", "writer_cost_usd", cast=COST_TYPE).alias("total_cost_usd"),
    )


MARTS = (
    "dim_run", "dim_question", "dim_retriever_cond", "dim_generator", "dim_writer",
    "dim_scoring", "dim_corpus", "dim_token_pricing", "fct_scored_answer",
)


class ContractError(RuntimeError):
    pass


def check_contract(df: DataFrame, contract: T.StructType = FACT_CONTRACT) -> None:
    """Q5: exact column names, order and types; fails before anything is served."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in contract.fields]
    if got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w] or (got, want)
        raise ContractError(f"fact contract mismatch: {diff}")


class Relations:
    """The staging -> intermediate relations of one raw landing, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, raw_dir: str):
        self.spark = spark
        self.raw_dir = raw_dir

    def raw(self, table: str) -> DataFrame:
        return read_raw(self.spark, self.raw_dir, table)

    def runs(self) -> DataFrame:
        return stg_runs(self.raw("run_manifest"))

    def questions(self) -> DataFrame:
        return stg_questions(self.raw("question"))

    def profiles(self) -> DataFrame:
        return stg_corpus_profile(self.raw("corpus_profile"))

    def stg_pricing(self) -> DataFrame:
        return stg_model_pricing(self.raw("model_pricing"), seed(self.spark, "seed_pricing_model_alias"))

    def pricing(self) -> DataFrame:
        return int_model_pricing(self.stg_pricing(), seed(self.spark, "seed_pricing_local_overrides"))

    def enriched(self) -> DataFrame:
        return int_scored_answers_enriched(self.raw("scored_answer"), self.questions(), self.runs(), self.pricing())


#: Note of the enriched grain: the manifest version that it was built from.
RAW_VERSION = "raw_version"


def manifest_version(spark: SparkSession, raw_dir: str) -> str:
    """Id of the newest manifest version, which decides what answers are live."""
    entry = latest_entry(spark, f"{raw_dir.rstrip('/')}/run_manifest")
    return entry.id if entry else ""


def build_star(spark: SparkSession, raw_dir: str, marts_dir: str, parallelism: int = 4) -> dict[str, str]:
    """K8 + M9-M17: write every mart as a committed snapshot; returns mart -> folder."""
    raw_version = manifest_version(spark, raw_dir)  # told before the answers are read: never newer than they are
    p = Relations(spark, raw_dir)
    out = {}
    marts_dir = marts_dir.rstrip("/")
    # the price relation is small and used three times (guard, cost join, dimension):
    # parse the catalogs once and cut its lineage
    from ..operators.landing import key_violations
    from ..session import compiled_methods, workspace_dir

    workspace_dir(spark)
    compiled_methods(spark)
    pricing = p.pricing().checkpoint(eager=True)
    # the cost joins match on model_resolved alone: a repeated model would fan fact rows out
    repeated = key_violations(pricing, ["model_resolved"])
    if repeated:
        raise ContractError(f"pricing contract: model_resolved must be unique before the cost join: {repeated}")
    enriched_df = int_scored_answers_enriched(p.raw("scored_answer"), p.questions(), p.runs(), pricing)
    enriched_path = write_snapshot(enriched_df, f"{marts_dir}/_int/int_scored_answers_enriched", notes={RAW_VERSION: raw_version})
    enriched = spark.read.parquet(enriched_path)
    fact = fct_scored_answer(enriched)
    check_contract(fact)
    from ..operators.landing import null_keys

    builds = {
        "dim_run": lambda: dim_run(p.runs()),
        "dim_question": lambda: dim_question(p.questions(), seed(spark, "seed_question_type_labels")),
        "dim_retriever_cond": lambda: dim_retriever_cond(enriched, seed(spark, "seed_retriever_labels")),
        "dim_generator": lambda: dim_generator(enriched),
        "dim_writer": lambda: dim_writer(enriched),
        "dim_scoring": lambda: dim_scoring(enriched, seed(spark, "seed_scoring_labels")),
        "dim_corpus": lambda: dim_corpus(p.runs(), p.profiles()),
        "dim_token_pricing": lambda: dim_token_pricing(pricing),
    }

    def fact_check(written: DataFrame) -> None:
        if null_keys(written.select("scored_answer_sk"), ["scored_answer_sk"]).limit(1).count():
            raise ContractError("fct_scored_answer.scored_answer_sk has NULLs")

    jobs = {name: (lambda n=name, b=build: write_snapshot(b(), f"{marts_dir}/{n}")) for name, build in builds.items()}
    jobs["fct_scored_answer"] = lambda: write_snapshot(fact, f"{marts_dir}/fct_scored_answer", check=fact_check)
    # independent marts are submitted concurrently: small dimension jobs fill the cluster
    # while the fact (the only large write) runs
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        for name, fut in futures.items():
            out[name] = fut.result()
    out["int_scored_answers_enriched"] = enriched_path
    return out


def load_mart(spark: SparkSession, marts_dir: str, name: str) -> DataFrame:
    """One mart with every DECIMAL column cast to DOUBLE, as the report layer uses it."""
    df = read_table(spark, f"{marts_dir.rstrip('/')}/{name}")
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
