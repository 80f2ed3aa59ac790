"""T1 for both box scores: the records of the two contracts meet as streams.

Two queries, each run with ``availableNow``. The first parses every landed record once and files it
by kind, unusable ones apart. The second joins the basic and the advanced records of a game: each
side is freed of replays inside the watermark, and the full outer join gives a game as soon as both
records are there, and a single record once the watermark says that no partner can come any more.
Complete games are committed to both stored tables, single records go to the quarantine. What
still waits for its partner stays in the state of the query and is taken up by the next run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxstats.operators.games import finished
from boxstats.plans.ingest import commit_both
from boxstats.session import written
from boxstats.sources import landing as L
from boxstats.sources import schemas as SC

UNUSABLE = "unusable"
STATE_CODEC = "spark.sql.streaming.stateStore.compression.codec"


def file_by_kind(spark: SparkSession, landing: str, base: str) -> None:
    """Stateless: landed records as Parquet folders by kind; those that do not parse, or do not say
    what they are, under ``kind=unusable`` as they landed."""
    records = L.read_records(spark, landing, stream=True)
    kind = F.when(L.unusable(), UNUSABLE).otherwise(F.col("kind"))
    (records.withColumn("kind", kind).drop(L.MONTH).writeStream.format("parquet")
     .option("compression", "zstd").partitionBy("kind").option("path", f"{base}/records")
     .option("checkpointLocation", f"{base}/checkpoint-records")
     .trigger(availableNow=True).start().awaitTermination())


def side(spark: SparkSession, base: str, kind: str, delay: str) -> DataFrame:
    """The stream of one kind: gameId, the time it was sent and its players under the kind's name.
    A record that comes again within the watermark is dropped."""
    schema = T.StructType([*SC.with_corrupt(L.RECORD).fields])
    records = (spark.readStream.schema(schema).parquet(f"{base}/records")
               .filter(F.col("kind") == kind))
    sent = f"{kind}_sent"
    return (records.select("gameId", F.col("sent").alias(sent), F.col("players").alias(kind))
            .withWatermark(sent, delay).dropDuplicatesWithinWatermark(["gameId"])
            .withColumnRenamed("gameId", f"{kind}_id"))


def paired(spark: SparkSession, base: str, delay: str, within: str) -> DataFrame:
    """Full outer join of the two streams: a game's records are sent at most ``within`` apart, so
    the state of either side ends with the watermark."""
    basic, advanced = (side(spark, base, k, delay) for k in L.PAYLOADS)
    span = F.expr(f"INTERVAL {within}")
    near = ((F.col("basic_id") == F.col("advanced_id"))
            & (F.col("advanced_sent") >= F.col("basic_sent") - span)
            & (F.col("advanced_sent") <= F.col("basic_sent") + span))
    return basic.join(advanced, near, "full_outer")


def stream_box_scores(spark: SparkSession, season: DataFrame, landing: str, base: str,
                      paths: dict[str, str], delay: str = "2 days", within: str = "1 day",
                      ts: dt.datetime | None = None) -> list[dict]:
    """Run both queries until the landed files are consumed; returns the counts of each
    micro-batch. ``base`` holds the records by kind, the checkpoints and the quarantine.

    A micro-batch commits its complete finished games with replace-by-key, and writes the others
    (``half``: no partner came; ``not finished``: the schedule does not have the game as finished)
    under its own number, so a batch that is replayed after a failure leaves both as they were."""
    file_by_kind(spark, landing, base)
    games = finished(season, "game_status")
    metrics: list[dict] = []

    def commit(batch: DataFrame, epoch_id: int) -> None:
        landed = written(batch.withColumn("gameId", F.coalesce("basic_id", "advanced_id")), "pairs")
        whole = F.col("basic_id").isNotNull() & F.col("advanced_id").isNotNull()
        known = games.select(F.col("game_id").alias("gameId")).join(
            landed.filter(whole).select("gameId").distinct(), "gameId", "left_semi")
        done = written(known, "known")
        ready = landed.filter(whole).join(done, "gameId", "left_semi")
        held = (landed.filter(~whole).withColumn("reason", F.lit("half")).unionByName(
            landed.filter(whole).join(done, "gameId", "left_anti")
            .withColumn("reason", F.lit("not finished"))))
        held.write.option("compression", "zstd").mode("overwrite").parquet(
            f"{base}/quarantine/epoch={epoch_id}")
        boxes = {kind: L.player_rows(ready, kind, players=kind) for kind in paths}
        metrics.append(commit_both(spark, boxes, games.join(
            F.broadcast(done), F.col("game_id") == F.col("gameId"), "left_semi"), paths, ts)
            | {"epoch": epoch_id})

    # What waits for a partner is a day's records and more: kept small on disk. A checkpoint keeps the
    # codec it was begun with.
    codec = spark.conf.get(STATE_CODEC)
    spark.conf.set(STATE_CODEC, "zstd")
    try:
        (paired(spark, base, delay, within).writeStream.foreachBatch(commit)
         .option("checkpointLocation", f"{base}/checkpoint-pairs")
         .trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.set(STATE_CODEC, codec)
    return metrics


def quarantined(spark: SparkSession, base: str) -> DataFrame:
    """(gameId, reason) of what the runs so far put aside."""
    held = spark.read.parquet(f"{base}/quarantine").select("gameId", "reason")
    unread = (spark.read.schema(T.StructType([*SC.with_corrupt(L.RECORD).fields]))
              .parquet(f"{base}/records").filter(F.col("kind") == UNUSABLE))
    return held.unionByName(unread.select("gameId", F.lit(UNUSABLE).alias("reason")))
