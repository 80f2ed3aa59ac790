"""Session defaults and the few session-level helpers every stage shares.

Nothing here replaces Spark machinery: it only picks settings (AQE, skew join, UTC, no UI) and
reads the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. ANSI stays on (Spark 4 default): every division and cast in
# the library is written with try_* forms or guarded, so bad data yields NULL, not a crash.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Checkpoints of small derived tables are removed once their DataFrames are collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "boxstats", extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs. On a cluster use the cluster's session."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Only where it
    is unset (local tests) a private folder is created, so that ``checkpoint()`` works at all.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="boxstats-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read back: like a
    checkpoint, but later reads keep column pruning, pushed filters and file statistics."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
