"""The training-data pipeline: stages over ``documents``, each written and read by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tellstar.llm import decontaminate, packing, simhash, substring, toxicity
from tellstar.llm.folds import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; the rest are unchanged."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group stays, the one with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=4, bits=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that a document with a smaller doc_id also has are cut out of the
    texts; documents with no word left after that go."""
    return substring.without_repeats(docs, window=50)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark phrases go; the rest are unchanged."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=13, share=20)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end=2, with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL cannot express the fitted classifier, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; each stage's rows are written as Parquet
    in the shared folder and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
