"""Landing-zone scans.

Layout contract of the producer::

    <root>/<batch>/<run_id>.manifest.json     one run-level JSON object
    <root>/<batch>/<run_id>.jsonl             one scored answer per line (the manifest's sibling)
    <root>/reference/questions.jsonl          shared question bank (a file, or a folder of parts)
    <root>/reference/<corpus_build_id>.json   corpus profiles
    <root>/reference/pricing/<provider>.json  price catalog snapshots

Every scan is one distributed read with the file path from ``_metadata``; keys come from
file names, nothing is looped over on the driver. The reference folder holds a small file for each
profile and provider; where it is mounted, tasks list and read it (``sources/documents.py``).
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordinality import line_numbers
from . import fs
from .documents import read_documents

log = logging.getLogger(__name__)

# Fixed values of the producer's file-naming contract.
MANIFEST_SUFFIX = ".manifest.json"
RECORDS_SUFFIX = ".jsonl"
QUESTIONS_NAME = "questions.jsonl"
REFERENCE_SUBDIR = "reference"
PRICING_SUBDIR = "pricing"
JSON_SUFFIX = ".json"

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _path_only(p: str) -> str:
    import re

    return re.sub(_SCHEME, "", p).rstrip("/")


def file_uri() -> Column:
    """The file's URI in plain characters: Spark's metadata column is percent-encoded."""
    return decoded("_metadata.file_path")


def decoded(path: str) -> Column:
    return F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))


def _rel(uri: Column, root: str) -> Column:
    """Path of a file (plain characters) below the landing root, scheme stripped on both sides.

    Every answer line has its file's path, so the usual forms are compared as they are; patterns
    took almost half of the time of a scan."""
    bare = F.regexp_replace(uri, _SCHEME, "")
    prefix = _path_only(root) + "/"
    local = "file:" in root[:5] or prefix == root.rstrip("/") + "/"
    forms = [f"file://{prefix}", f"file:{prefix}"] if local else [root.rstrip("/") + "/"]
    rel = F.when(bare.startswith(prefix), F.substring(bare, len(prefix) + 1, 1 << 30)).otherwise(bare)
    for form in reversed(forms):
        rel = F.when(uri.startswith(form), F.substring(uri, len(form) + 1, 1 << 30)).otherwise(rel)
    return rel


def folder_of(rel: Column) -> Column:
    """What stands before the last slash (none: empty)."""
    return F.substring(rel, F.lit(1), F.length(rel) - F.length(F.substring_index(rel, "/", -1)) - 1)


def refuse_hidden(spark: SparkSession, root: str) -> None:
    """Raises if a landing file has a name that Spark's readers would skip without a word."""
    skipped = fs.hidden_files(spark, root, (MANIFEST_SUFFIX, RECORDS_SUFFIX, JSON_SUFFIX))
    if skipped:
        raise ValueError(f"landing files or folders must not begin with '_' or '.': {skipped}")


# whitespace stripped around a JSON-Lines record (a line of only whitespace is skipped)
LINE_WHITESPACE = " \t\r\n\x0b\x0c"


def strip_line(c: Column | str) -> Column:
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(LINE_WHITESPACE))


def _stem(file_path: Column, suffix: str) -> Column:
    name = F.substring_index(file_path, "/", -1)
    return F.when(name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix))).when(file_path.isNotNull(), "")


def _not_reference(rel: Column) -> Column:
    """Tested on the part below the root only: the root itself may lie below such a folder."""
    return ~(rel.startswith(REFERENCE_SUBDIR + "/") | rel.contains("/" + REFERENCE_SUBDIR + "/"))


def run_folders(spark: SparkSession, root: str) -> list[str]:
    """What stands in the root, as patterns that match it alone, but the ``reference/`` subtree (it
    holds a file for each profile and provider, which no scan of runs has to list) and what Spark's
    readers skip. A root that does not exist is left to them."""
    if not fs.exists(spark, root):
        return [root]
    names = {c: c.rstrip("/").rsplit("/", 1)[-1] for c in fs.list_dir(spark, root)}
    hidden = {c for c, n in names.items() if n.startswith(".") or (n.startswith("_") and "=" not in n) or n.endswith("._COPYING_")}
    return [fs.glob_escaped(c) for c, n in names.items() if n != REFERENCE_SUBDIR and c not in hidden]


def _reference_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The ``*.json`` files that stand in the folder itself."""
    at = fs.mounted(spark, folder)
    return _whole_files(spark, folder, "*" + JSON_SUFFIX, recursive=False) if at is None else read_documents(spark, at, JSON_SUFFIX)


def _whole_files(spark: SparkSession, path: str | list[str], glob: str, recursive: bool) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    # ``wholetext`` must be the keyword: the text() default would override an option()
    return fs.few_tasks(reader.text(path, wholetext=True).select(
        file_uri().alias("source_uri"), F.col("value").alias("payload")
    ))


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def scan_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Every ``*.manifest.json`` below ``root`` except the ``reference/`` subtree.

    Columns: run_id (file stem), batch (folder relative to root), source_uri, payload."""
    if not fs.exists(spark, root):
        raise FileNotFoundError(f"landing root does not exist: {root}")
    refuse_hidden(spark, root)
    folders = run_folders(spark, root)
    if not folders:
        return _empty(spark, "run_id string, batch string, source_uri string, payload string")
    df = _whole_files(spark, folders, "*" + MANIFEST_SUFFIX, recursive=True)
    rel = _rel(F.col("source_uri"), root)
    return (
        df.withColumn("_rel", rel)
        .where(_not_reference(F.col("_rel")))
        .select(
            _stem(F.col("source_uri"), MANIFEST_SUFFIX).alias("run_id"),
            folder_of(F.col("_rel")).alias("batch"),
            "source_uri",
            "payload",
        )
    )


def dedupe_run_batches(manifests: DataFrame) -> DataFrame:
    """One manifest per run_id; the newest batch folder wins.

    Only run, batch and URI are aggregated; the winners' payloads are joined back, so a run
    copied into many batches neither gathers in one task nor carries its documents along."""
    newest = manifests.groupBy("run_id").agg(F.max(F.struct("batch", "source_uri")).alias("m")).select(
        F.col("run_id").alias("_run"), F.col("m.batch").alias("_batch"), F.col("m.source_uri").alias("_uri"))
    same = manifests["run_id"].eqNullSafe(newest["_run"]) & manifests["batch"].eqNullSafe(newest["_batch"]) & manifests["source_uri"].eqNullSafe(newest["_uri"])
    return manifests.join(newest, same, "left_semi").select("run_id", "batch", "source_uri", "payload")


def record_lines(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """Non-blank lines of every ``<run_id>.jsonl`` outside ``reference/`` (or below the given
    folders only), with the byte range of their file that they were read in.

    Columns: run_id, batch, records_uri, split_start, payload (whitespace-stripped line)."""
    folders = run_folders(spark, root) if paths is None else paths
    if not folders:
        return _empty(spark, "run_id string, batch string, records_uri string, split_start bigint, payload string")
    reader = spark.read.option("pathGlobFilter", "*" + RECORDS_SUFFIX)
    if paths is None:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(folders).select(
        strip_line("value").alias("payload"),
        file_uri().alias("records_uri"),
        F.col("_metadata.file_block_start").alias("split_start"),
    )
    lines = df.withColumn("_rel", _rel(F.col("records_uri"), root)).where(_not_reference(F.col("_rel")) & (F.col("payload") != ""))
    return lines.select(
        _stem(F.col("records_uri"), RECORDS_SUFFIX).alias("run_id"),
        folder_of(F.col("_rel")).alias("batch"),
        "records_uri",
        "split_start",
        "payload",
    )


def scan_record_lines(spark: SparkSession, root: str, paths: list[str] | None = None) -> DataFrame:
    """S3: ``record_lines`` with line_no (0-based among a file's non-blank lines).

    Columns: run_id, batch, records_uri, line_no, payload. The text is read once, here."""
    numbered = line_numbers(record_lines(spark, root, paths), "records_uri", "split_start")
    return numbered.select("run_id", "batch", "records_uri", "line_no", "payload")


def questions_path(root: str) -> str:
    return f"{root.rstrip('/')}/{REFERENCE_SUBDIR}/{QUESTIONS_NAME}"


def has_questions(spark: SparkSession, root: str) -> bool:
    return fs.exists(spark, questions_path(root))


def scan_questions(spark: SparkSession, root: str) -> DataFrame:
    """The question bank lines (payload only); empty with a warning when absent."""
    path = questions_path(root)
    if not fs.exists(spark, path):
        log.warning("no %s under %s; the question bank loads 0 rows", QUESTIONS_NAME, root)
        return _empty(spark, "payload string")
    return (
        spark.read.text(path)
        .select(strip_line("value").alias("payload"))
        .where(F.col("payload") != "")
    )


def scan_corpus_profiles(spark: SparkSession, root: str) -> DataFrame:
    """``reference/*.json`` (not ``.jsonl``, not ``pricing/``); id = file stem."""
    ref = f"{root.rstrip('/')}/{REFERENCE_SUBDIR}"
    if not fs.exists(spark, ref):
        return _empty(spark, "corpus_build_id string, source_uri string, payload string")
    df = _reference_documents(spark, ref)
    return df.select(_stem(F.col("source_uri"), JSON_SUFFIX).alias("corpus_build_id"), "source_uri", "payload")


def scan_pricing(spark: SparkSession, root: str) -> DataFrame:
    """One catalog snapshot per provider, ``reference/pricing/<provider>.json``."""
    ref = f"{root.rstrip('/')}/{REFERENCE_SUBDIR}/{PRICING_SUBDIR}"
    if not fs.exists(spark, ref):
        return _empty(spark, "provider string, source_uri string, payload string")
    df = _reference_documents(spark, ref)
    return df.select(_stem(F.col("source_uri"), JSON_SUFFIX).alias("provider"), "source_uri", "payload")


def relative_uri(source_uri: Column | str, root: str) -> Column:
    """S7 helper: provenance URI relative to the landing root (stable across machines)."""
    c = F.col(source_uri) if isinstance(source_uri, str) else source_uri
    return _rel(c, root)
