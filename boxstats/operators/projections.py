"""Projections and reshaping."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxstats.functions.scalars import BENCH_FILL, finite_or_zero


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The contract columns in contract order and type; a missing column fails analysis.
    A value that does not convert becomes NULL (``try_cast``), never an error."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


_DATE_START = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def parse_datetimes(df: DataFrame, cols: Iterable[str], kind: str = "timestamp_ntz") -> DataFrame:
    """P5: text to ``timestamp_ntz`` / ``date`` / ``timestamp``; unreadable text gives NULL.

    Text that does not start like a date skips the cast: a failing ANSI cast is slow."""
    def parse(c: str):
        s = F.col(c).cast("string")
        return F.when(s.rlike(_DATE_START), s.try_cast(kind))
    return df.withColumns({c: parse(c) for c in cols})


def fill_position(df: DataFrame, col: str = "position", value: str = BENCH_FILL) -> DataFrame:
    """Missing position -> ``bench``."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))


def fill_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Feature columns as finite doubles (NULL, NaN, +-inf -> 0.0)."""
    return df.withColumns({c: finite_or_zero(c) for c in names})


# Output contract of the predictions table: target name -> source column (fixed values).
PREDICTION_COLUMNS = {
    "gameId": "gameId",
    "gameDate": "gameDate",
    "teamId": "team_id",
    "opponentId": "opponent",
    "personId": "person_id",
    "fullName": "player_slug",
    "predictedPoints": "prediction",
}


def prediction_rows(scored: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """The seven prediction columns, renamed."""
    mapping = mapping or PREDICTION_COLUMNS
    return scored.select(*[F.col(src).alias(dst) for dst, src in mapping.items()])
