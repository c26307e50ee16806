"""Price-catalog snapshots (K7) and their shape check (Q7).

A snapshot wraps a provider's catalog (an object keyed by model name) as
``{"meta": {provider, fetched_at, ref, source_url, model_count}, "models": {...}}``
with keys in sorted order (VARIANT keeps object keys sorted), after refusing catalogs
whose shape would silently null every cost downstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import jtext
from ..sources.landing_files import PRICING_SUBDIR, REFERENCE_SUBDIR
from ..sources.sinks import write_named_documents

# Fixed value: the price path every usable catalog entry must carry.
REQUEST_PRICE_PATH = "pricing_config.pay_as_you_go.request_token.price"


class CatalogShapeError(ValueError):
    pass


def catalog_shape(models: DataFrame) -> DataFrame:
    """Q7 per provider: model count and how many carry the request price.

    ``models``: (provider, models_json). A non-object or empty catalog has 0 models."""
    entries = models.select(
        "provider",
        F.explode_outer(F.try_variant_get(F.parse_json("models_json"), "$", "map<string,variant>")).alias("k", "obj"),
    )
    return entries.groupBy("provider").agg(
        F.count("k").alias("n_models"),
        F.count(jtext(F.col("obj"), REQUEST_PRICE_PATH)).alias("n_with_request_price"),
    ).withColumn("ok", (F.col("n_models") > 0) & (F.col("n_with_request_price") > 0))


def validate_shape(models: DataFrame) -> None:
    bad = catalog_shape(models).where(~F.col("ok")).select("provider").limit(10).collect()
    if bad:
        raise CatalogShapeError(
            f"catalogs without any {REQUEST_PRICE_PATH} (or empty/non-object): {[r.provider for r in bad]}"
        )


def build_snapshots(models: DataFrame, ref: str, fetched_at: str, source_url_prefix: str = "catalog/") -> DataFrame:
    """(provider, models_json) -> (provider, snapshot) after ``validate_shape``."""
    validate_shape(models)
    v = F.parse_json("models_json")
    n = F.size(F.map_keys(F.variant_get(v, "$", "map<string,variant>")))
    meta = F.to_json(
        F.struct(
            F.col("provider"),
            F.lit(fetched_at).alias("fetched_at"),
            F.lit(ref).alias("ref"),
            F.concat(F.lit(source_url_prefix), F.col("provider"), F.lit(".json")).alias("source_url"),
            n.alias("model_count"),
        )
    )
    return models.select(
        "provider",
        F.concat(F.lit('{"meta":'), meta, F.lit(',"models":'), F.to_json(v), F.lit("}")).alias("snapshot"),
    )


def write_snapshots(snapshots: DataFrame, root: str) -> int:
    """Write each snapshot to ``<root>/reference/pricing/<provider>.json``."""
    root = root.rstrip("/")
    return write_named_documents(
        snapshots.select("provider", F.col("snapshot").alias("value")),
        ["provider"],
        f"{root}/_staging_snapshots",
        lambda v: f"{root}/{REFERENCE_SUBDIR}/{PRICING_SUBDIR}/{v['provider']}.json",
    )
