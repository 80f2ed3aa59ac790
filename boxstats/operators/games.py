"""Schedule operators: game type (F1), finished (F2), date window (F3, F6, F7), new games
(J1, A5) and upcoming player-games (J3, U1, A4, I5, I7, I8, C1)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstats.functions.scalars import (
    FINISHED_STATUS, is_home, is_playoffs, is_regular_season, normalise_game_id, opponent_of,
    roster_group, season_of,
)
from boxstats.operators.joins import bounded_broadcast


def with_game_type(df: DataFrame, game_id: str = "game_id",
                   keep: Sequence[str] = ("regular", "playoffs")) -> DataFrame:
    """add ``is_playoffs`` / ``is_regular_season`` and keep the kinds in ``keep``."""
    out = df.withColumns({"is_playoffs": is_playoffs(game_id),
                          "is_regular_season": is_regular_season(game_id)})
    cond = F.lit(False)
    if "regular" in keep:
        cond = cond | F.coalesce(F.col("is_regular_season"), F.lit(False))
    if "playoffs" in keep:
        cond = cond | F.coalesce(F.col("is_playoffs"), F.lit(False))
    return out.filter(cond)


def finished(df: DataFrame, status: str = "game_status", value: str = FINISHED_STATUS) -> DataFrame:
    """games whose (text) status equals ``value``."""
    return df.filter(F.col(status).cast("string") == F.lit(value))


def games_between(df: DataFrame, date_col: str, date: dt.date | str, days: int = 1) -> DataFrame:
    """Rows whose date falls in [date, date + days). ``days=1`` is one day.

    Written as a range on the column itself so parquet row-group and partition pruning apply.
    An empty result is a valid answer (F7): callers decide what no games means."""
    start = dt.date.fromisoformat(date) if isinstance(date, str) else date
    end = start + dt.timedelta(days=days)
    col = F.col(date_col)
    kind = dict(df.dtypes)[date_col]
    # Bounds as text cast to the column's type: no dependence on the driver's local zone.
    if kind in ("timestamp", "timestamp_ntz"):
        lo = F.lit(f"{start.isoformat()} 00:00:00").cast(kind)
        hi = F.lit(f"{end.isoformat()} 00:00:00").cast(kind)
    else:
        lo, hi = F.lit(start.isoformat()).cast("date"), F.lit(end.isoformat()).cast("date")
    return df.filter((col >= lo) & (col < hi))


def new_games(finals: DataFrame, stored: DataFrame | None, finals_key: str = "game_id",
              stored_key: str = "gameId") -> DataFrame:
    """J1 + A5: finished games whose (normalised) id is not in the stored table.

    The stored table is large, the schedule small: stored ids are first cut to the schedule's
    ids with a broadcast semi join (map side, no shuffle of the stored table), so only at most
    as many ids as the schedule has reach the anti join."""
    keyed = finals.withColumn("__gid", normalise_game_id(finals_key))
    if stored is None:
        return keyed.drop("__gid")
    ids = bounded_broadcast(keyed.select("__gid").filter(F.col("__gid").isNotNull()).distinct(), derived=True)
    seen = (stored.select(normalise_game_id(stored_key).alias("__gid"))
            .join(ids, "__gid", "left_semi").distinct())
    return keyed.join(seen, "__gid", "left_anti").drop("__gid")


def roster(players: DataFrame, cols: Sequence[str] = ("person_id", "player_slug", "team_id",
                                                      "position")) -> DataFrame:
    """A4 / U4: distinct roster rows."""
    return players.select(*cols).distinct()


def player_games(games: DataFrame, roster_df: DataFrame, home: str = "homeTeam_teamId",
                 away: str = "awayTeam_teamId", team: str = "team_id",
                 game_id: str = "gameId", game_date: str = "gameDate") -> DataFrame:
    """J3 + U1 + I5 + I7 + I8 + I2 (C1 without the date filter).

    Each game becomes two rows (home team, away team) by one ``explode`` and meets the roster
    in one broadcast join, instead of two joins and a union. Adds ``opponent``,
    ``position_group``, ``is_home``, ``season`` and ``game_date``."""
    sides = games.withColumn(team, F.explode(F.array(F.col(home), F.col(away))))
    small = bounded_broadcast(roster_df, derived=True)
    joined = sides.join(small, team, "inner")
    return joined.withColumns({
        "opponent": opponent_of(team, home, away),
        "position_group": roster_group("position"),
        "is_home": is_home(team, home),
        "season": season_of(game_id),
        "game_date": F.col(game_date).cast("timestamp_ntz"),
    })


def upcoming_player_games(schedule: DataFrame, players: DataFrame, date: dt.date | str,
                          days: int = 1, date_col: str = "gameDate", **kw) -> DataFrame:
    """The players of both teams of each game in [date, date + days)."""
    games = games_between(schedule, date_col, date, days)
    return player_games(games, roster(players), game_date=date_col, **kw)
