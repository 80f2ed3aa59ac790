"""Incremental ingest of landed files with Structured Streaming.

A file-source stream with an explicit schema, run with ``trigger(availableNow=True)``: every
file landed since the last run is processed, then the query stops. The checkpoint replaces the
"already processed" bookkeeping; each micro-batch is committed with replace-by-key, so a replayed
batch replaces its own rows and leaves the table as it was.

One micro-batch may hold several landed copies of a row (a payload landed twice). Rows are
first reduced to one per ``row_keys``, keeping the copy from the most recently landed file, so
the replace never inserts duplicates. A file with a record that does not parse or lacks a key is
quarantined as a whole, under the micro-batch's own folder, which a replay overwrites.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxstats.session import materialize
from boxstats.sinks.writers import commit_replace
from boxstats.sources import schemas as SC

_LANDED = "__landed"
_FILE = "__file"


def latest_copy(batch: DataFrame, row_keys: Sequence[str]) -> DataFrame:
    """One row per ``row_keys``: the copy of the latest landed file (ties: file name)."""
    w = Window.partitionBy(*row_keys).orderBy(F.col(_LANDED).desc(), F.col(_FILE).desc())
    return (batch.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1)
            .drop("__rn", _LANDED, _FILE))


def stream_ingest(spark: SparkSession, landing_dir: str, schema: T.StructType,
                  target_path: str, checkpoint_path: str, keys: Sequence[str],
                  partition_col: str, row_keys: Sequence[str] | None = None,
                  fmt: str = "parquet",
                  prepare: Callable[[DataFrame], DataFrame] | None = None,
                  max_files_per_trigger: int | None = None, audit: bool = False) -> list[dict]:
    """Run the stream until the landed files are consumed; returns per-batch metrics.

    keys: replace key (all stored rows with a batch key are replaced); row_keys: identity of
    one landed row (defaults to ``keys``); every landed row needs all of them. ``prepare`` runs on
    each micro-batch after it is reduced to the latest landed copies, so it may join static tables
    (a schedule, or the finished games: J1, J2) and project to the stored contract. Quarantined
    rows are in ``<target_path>-quarantine``, with their file and, for text formats, the record
    as it landed."""
    row_keys = list(row_keys or keys)
    reader = spark.readStream.format(fmt)
    if fmt in ("json", "csv"):
        reader = (reader.schema(SC.with_corrupt(schema)).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", SC.CORRUPT_COLUMN))
    else:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing_dir).select(
        "*", F.col("_metadata.file_modification_time").alias(_LANDED),
        F.col("_metadata.file_path").alias(_FILE))
    broken = reduce(lambda a, k: a | F.col(k).isNull(), dict.fromkeys([*keys, *row_keys]),
                    F.lit(False))
    if SC.CORRUPT_COLUMN in stream.columns:
        broken = broken | F.col(SC.CORRUPT_COLUMN).isNotNull()
    metrics: list[dict] = []

    def commit(batch: DataFrame, epoch_id: int) -> None:
        # The corrupt column of text formats must be read together with the others.
        landed = materialize(batch)
        files = landed.filter(broken).select(_FILE).distinct()
        bad = landed.join(files, _FILE, "left_semi")
        bad.write.mode("overwrite").parquet(f"{target_path}-quarantine/epoch={epoch_id}")
        good = landed.join(files, _FILE, "left_anti").drop(SC.CORRUPT_COLUMN)
        rows = latest_copy(good, row_keys)
        if prepare is not None:
            rows = prepare(rows)
        m = commit_replace(spark, rows, target_path, keys, partition_col, audit=audit)
        metrics.append({**m, "epoch": epoch_id})

    query = (stream.writeStream.foreachBatch(commit)
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return metrics
