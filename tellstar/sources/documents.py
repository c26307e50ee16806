"""Many small documents of a mounted folder, listed and read by tasks.

Spark's readers hold the status, path and block locations of every file on the driver, from the
listing until the last task is sent (over 1 KB a file: 360,000 profiles took 400 MB). Here one task
lists the folder as a stream of names, they are dealt out, and tasks read the files that they get;
the driver knows the folder only. The texts are handed on as they are, byte by byte.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names and bytes that a task hands on at once.
NAMES, BYTES = 10_000, 1 << 20


def _documents(names: list[str], texts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "content": pa.array(texts, pa.binary())})


def read_documents(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(source_uri, payload) of the files that stand in ``folder`` itself and end in ``suffix``: those
    that Spark's readers take, so neither hidden nor empty ones."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        if sum(b.num_rows for b in batches):
            with os.scandir(folder) as entries:
                for e in entries:
                    hidden = e.name.startswith(".") or (e.name.startswith("_") and "=" not in e.name)
                    if e.name.endswith(suffix) and not hidden and e.is_file() and e.stat().st_size:
                        names.append(e.name)
                    if len(names) >= NAMES:
                        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})
                        names = []
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open(f"{folder}/{name}", "rb") as f:
                    texts.append(f.read())
                names.append(name)
                held += len(texts[-1])
                if held >= BYTES or len(names) >= NAMES:
                    yield _documents(names, texts)
                    names, texts, held = [], [], 0
        yield _documents(names, texts)

    one = spark.range(0, 1, 1, 1).mapInArrow(listed, "name string")
    # in parts of a fixed number, as one task for every few names would be (``fs.few_tasks``)
    dealt = one.repartition(8 * spark.sparkContext.defaultParallelism, "name")
    return dealt.mapInArrow(read, "name string, content binary").select(
        F.concat(F.lit(f"file:{folder}/"), F.col("name")).alias("source_uri"), F.col("content").cast("string").alias("payload"))
