"""Sources S1-S9 and the season schedule (C10: S4, P4, P3, F1, P1).

Every reader takes an explicit schema. Landed files are scanned as one dataset (a directory
scan replaces the per-game fetch loop and its union), so the work spreads over all executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxstats.functions.scalars import normalise_game_id
from boxstats.operators.games import with_game_type
from boxstats.operators.joins import bounded_broadcast
from boxstats.operators.projections import conform, lower_columns
from boxstats.sinks.writers import read_stored
from boxstats.sources import schemas as SC


def empty_text_as_null(df: DataFrame) -> DataFrame:
    """Q21: an empty text is a missing value, whatever the format it was stored in."""
    return df.withColumns({f.name: F.nullif(F.col(f"`{f.name}`"), F.lit("")) for f in df.schema
                           if isinstance(f.dataType, T.StringType)})


def _reader(spark: SparkSession, schema: T.StructType, fmt: str):
    r = spark.read.schema(schema)
    if fmt == "csv":
        # Empty fields read as NULL; no inference.
        r = r.option("header", True).option("mode", "PERMISSIVE")
    return r.format(fmt)


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Scan a stored table: CSV with header, parquet, (``fmt="commits"``) a table of
    ``commit_replace``, or (``fmt="table"``) a catalog table by name, projected to ``schema``
    when one is given. Empty texts read as NULL."""
    if fmt in ("table", "commits"):
        df = spark.table(path) if fmt == "table" else read_stored(spark, path)
        return empty_text_as_null(df if schema is None else conform(df, schema))
    if schema is None:
        if fmt == "csv":
            raise ValueError("CSV tables need a schema: inference misreads ids and clocks")
        return empty_text_as_null(spark.read.format(fmt).load(path))
    return empty_text_as_null(_reader(spark, schema, fmt).load(path))


def load_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "parquet") -> DataFrame:
    """A table that does not exist yet reads as empty (first run). Other read errors
    raise: a broken table is not "nothing stored"."""
    if fmt == "commits":
        return empty_text_as_null(conform(read_stored(spark, path, schema), schema))
    try:
        return load_table(spark, path, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_players(spark: SparkSession, path: str, fmt: str = "csv",
                 upper_case: bool = False) -> DataFrame:
    """S1 + P1 + P2: player index, one row per player, lower-case column names."""
    if upper_case:
        upper = T.StructType([T.StructField(f.name.upper(), f.dataType, True)
                              for f in SC.PLAYERS.fields])
        return conform(lower_columns(load_table(spark, path, upper, fmt)), SC.PLAYERS)
    return conform(load_table(spark, path, SC.PLAYERS, fmt), SC.PLAYERS)


def read_teams(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Static team list (a small dimension)."""
    return load_table(spark, path, SC.TEAMS, fmt)


def read_schedule(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """S3 + P5: league schedule, 21 columns; game ids normalised."""
    df = load_table(spark, path, SC.SCHEDULE, fmt)
    return df.withColumn("gameId", normalise_game_id("gameId"))


def read_season_schedule_json(spark: SparkSession, path: str) -> DataFrame:
    """The nested season document (league -> months -> games) as nested rows."""
    return (spark.read.schema(SC.SEASON_SCHEDULE_JSON).option("multiLine", True)
            .option("mode", "PERMISSIVE").json(path))


def flatten_games(doc: DataFrame) -> DataFrame:
    """S4 + P4 + P3: one row per game. ``explode`` skips months without ``mscd`` or ``g``."""
    months = doc.select(F.explode("lscd").alias("m"))
    games = months.select(F.explode("m.mscd.g").alias("g"))
    return games.select(*[F.col(f"g.{src}").alias(dst)
                          for src, dst in SC.SEASON_GAME_RENAMES.items()])


def season_games(doc: DataFrame, keep: Sequence[str] = ("regular", "playoffs")) -> DataFrame:
    """Flat season schedule of regular-season and playoff games, 11 columns."""
    flat = flatten_games(doc).withColumn("game_id", normalise_game_id("game_id"))
    typed = with_game_type(flat, "game_id", keep)
    # Unreadable dates become NULL (try_cast), never an error under ANSI.
    return conform(typed.withColumn("game_date", F.col("game_date").cast("string")
                                    .try_cast("date")), SC.SEASON_SCHEDULE)


def read_payloads(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "json") -> DataFrame:
    """S5 / S6 + U2: every landed box-score payload under ``path`` in one scan.

    Malformed records are kept in ``_corrupt_record`` (PERMISSIVE) and every row carries the file
    it came from; ``split_payloads`` routes bad files to a quarantine frame, so a bad game never
    stops the run (D2)."""
    df = (spark.read.schema(SC.with_corrupt(schema)).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", SC.CORRUPT_COLUMN).format(fmt).load(path))
    return df.select("*", F.col("_metadata.file_path").alias(SC.FILE_COLUMN)).withColumn(
        "gameId", normalise_game_id("gameId"))


def bad_payload() -> Column:
    """A row that failed to parse or has no game id."""
    return F.col(SC.CORRUPT_COLUMN).isNotNull() | F.col("gameId").isNull()


def split_payloads(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows), by whole files. A file is one game's payload, so one
    bad record quarantines all its rows: the game stays out of the stored ids and is ingested
    once the file is repaired."""
    # One row a bad file: by its size a broadcast, so the rows are not shuffled by file.
    files = bounded_broadcast(df.filter(bad_payload()).select(SC.FILE_COLUMN).distinct(),
                              derived=True)
    good = df.join(files, SC.FILE_COLUMN, "left_anti").drop(SC.CORRUPT_COLUMN, SC.FILE_COLUMN)
    return good, df.join(files, SC.FILE_COLUMN, "left_semi").select(*df.columns)

