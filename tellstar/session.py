"""Session helpers: a tuned local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tellstar") -> SparkSession:
    """Local session with the settings the pipeline is designed around (AQE on, UTC, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TELLSTAR_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: HotSpot compiles no method of more bytes.
COMPILED_BYTES = 8000


def compiled_methods(spark: SparkSession) -> None:
    """Lets no stage run as one generated method that the JVM would only interpret.

    A projection of some dozen JSON fields is fused into a method far above HotSpot's limit; by
    default Spark keeps it up to 64 KB. Beyond the limit set here the operators of the stage run one
    by one, each in small methods. A limit that the session's owner has set stays."""
    if spark.sparkContext.getConf().get(METHOD_LIMIT, None) is None:
        spark.conf.set(METHOD_LIMIT, COMPILED_BYTES)


def workspace_dir(spark: SparkSession) -> str:
    """Shared scratch folder of the cluster.

    Read from the context's checkpoint folder or ``spark.checkpoint.dir``. Only a session that
    runs in one process (master ``local``, as in tests) gets a folder of its own when it has
    none; on a cluster a machine-local folder would be a different one on every node, so a
    missing setting is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return (sc.getCheckpointDir() or conf_dir).rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(f"master {sc.master}: set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return sc.getCheckpointDir().rstrip("/")
