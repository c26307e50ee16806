"""Connected components of an edge list by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that the rows of one key are dealt to.
SALTS = 1024


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of each index's component, for edges between indices below n."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (further := label[label]).tobytes() != label.tobytes():
            label = further
        live = label[a] != label[b]
        a, b = a[live], b[live]
    return label


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a batch as edges of each node to the smallest node of its local component."""
    for batch in batches:
        nodes, index = np.unique(np.concatenate([batch.column("a").to_numpy(), batch.column("b").to_numpy()]), return_inverse=True)
        label = roots(index[:batch.num_rows], index[batch.num_rows:], len(nodes))
        far = np.flatnonzero(label != np.arange(len(nodes)))
        yield pa.RecordBatch.from_pydict({"a": nodes[far], "b": nodes[label[far]]})


def looked_up(rows: DataFrame, key: str, salt: Column, found: DataFrame) -> DataFrame:
    """``rows`` joined with ``found`` (one row for each ``key``), no key's rows in one task.

    A key's rows are dealt to at most SALTS parts by ``salt`` (a long that is the same whenever
    the row is read again). Only the parts that there are get a copy of the key's row of ``found``,
    so a key of few rows costs no more than these."""
    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)))
    parts = salted.select(key, "_salt").distinct().join(found, key)
    return salted.join(parts, [key, "_salt"]).drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long a, long b); root is the smallest node.

    Each batch first contracts its own edges; the rest are large-star and small-star rounds
    (every node's neighbours are relinked to its smallest one), a logarithmic number of rounds
    whose state is checkpointed. A centre's neighbours are only aggregated (min) and joined in parts.
    """
    stars = edges.mapInArrow(_stars, "a long, b long").distinct().checkpoint()
    while True:
        ends = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = ends.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = looked_up(ends, "a", F.xxhash64("b"), low).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (looked_up(large, "a", F.xxhash64("b"), down)
                 .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct().checkpoint())
        stars = small
        several = stars.groupBy("a").count().where("count > 1").select("a")
        inner = stars.select(F.col("b").alias("a")).distinct().join(stars.select("a").distinct(), "a", "left_semi")
        if not several.unionByName(inner).limit(1).count():  # every node has one root, and no root has another
            break
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
