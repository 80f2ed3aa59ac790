"""Fixed schemas of the landed tables. Column names and order are the source pipeline's
contracts; types are chosen from how each column is used. No schema inference anywhere: CSV
inference turns ``0022400123`` into an integer and ``12:30`` into a timestamp."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

PLAYERS = _struct([
    ("person_id", L), ("player_last_name", S), ("player_first_name", S), ("player_slug", S),
    ("team_id", L), ("team_abbreviation", S), ("jersey_number", S), ("position", S),
    ("height", S), ("weight", S), ("college", S), ("country", S), ("draft_year", I),
    ("draft_round", I), ("draft_number", I), ("roster_status", D), ("from_year", S),
    ("to_year", S),
])

TEAMS = _struct([("id", L), ("full_name", S), ("abbreviation", S), ("nickname", S),
                 ("city", S), ("state", S), ("year_founded", I)])

SCHEDULE = _struct([
    ("seasonYear", S), ("gameDate", T.TimestampNTZType()), ("gameId", S), ("gameStatus", I),
    ("gameStatusText", S), ("gameDateTimeUTC", T.TimestampType()), ("gameLabel", S),
    ("gameSubLabel", S), ("seriesGameNumber", S), ("seriesText", S), ("postponedStatus", S),
    ("gameSubtype", S), ("isNeutral", B), ("arenaName", S), ("arenaState", S), ("arenaCity", S),
    ("homeTeam_teamId", L), ("homeTeam_teamTricode", S), ("awayTeam_teamId", L),
    ("awayTeam_teamTricode", S), ("nationalBroadcasters_broadcasterDisplay", S),
])

_TEAM_REF = _struct([("tid", L), ("ta", S)])
SEASON_GAME = _struct([
    ("gid", S), ("seri", S), ("st", S), ("stt", S), ("gdte", S),
    ("h", _TEAM_REF), ("v", _TEAM_REF),
])
SEASON_SCHEDULE_JSON = _struct([
    ("lscd", T.ArrayType(_struct([
        ("mscd", _struct([("g", T.ArrayType(SEASON_GAME))])),
    ]))),
])
# Source field -> column name of the flat season schedule (fixed values of the source).
SEASON_GAME_RENAMES = {
    "gid": "game_id", "seri": "playoffs_desc", "st": "game_status",
    "stt": "game_status_text", "gdte": "game_date", "h.tid": "home_team_id",
    "h.ta": "home_team_tricode", "v.tid": "visitor_team_id", "v.ta": "visitor_team_tricode",
}
SEASON_SCHEDULE = _struct([
    ("game_id", S), ("is_regular_season", B), ("is_playoffs", B), ("playoffs_desc", S),
    ("game_date", T.DateType()), ("home_team_id", L), ("home_team_tricode", S),
    ("visitor_team_id", L), ("visitor_team_tricode", S), ("game_status", S),
    ("game_status_text", S),
])

_KEY_WHO_CLOCK = [
    ("gameId", S), ("teamId", L), ("teamTricode", S), ("personId", L), ("playerSlug", S),
    ("position", S), ("minutes", S),
]
_GAME = [
    ("is_regular_season", B), ("is_playoffs", B), ("playoffs_desc", S),
    ("game_date", T.DateType()), ("home_team_id", L), ("visitor_team_id", L),
    ("game_status_text", S),
]
BASIC_STATS = [
    ("fieldGoalsMade", I), ("fieldGoalsAttempted", I), ("fieldGoalsPercentage", D),
    ("threePointersMade", I), ("threePointersAttempted", I), ("threePointersPercentage", D),
    ("freeThrowsMade", I), ("freeThrowsAttempted", I), ("freeThrowsPercentage", D),
    ("reboundsOffensive", I), ("reboundsDefensive", I), ("reboundsTotal", I), ("assists", I),
    ("steals", I), ("blocks", I), ("turnovers", I), ("foulsPersonal", I), ("points", I),
]
ADVANCED_STATS = [(n, D) for n in (
    "estimatedOffensiveRating", "offensiveRating", "estimatedDefensiveRating",
    "defensiveRating", "estimatedNetRating", "netRating", "assistPercentage",
    "assistToTurnover", "assistRatio", "offensiveReboundPercentage",
    "defensiveReboundPercentage", "reboundPercentage", "turnoverRatio",
    "effectiveFieldGoalPercentage", "trueShootingPercentage", "usagePercentage",
    "estimatedUsagePercentage", "estimatedPace", "pace", "pacePer40", "possessions", "PIE",
)]

BOX_BASIC = _struct(_KEY_WHO_CLOCK + BASIC_STATS + _GAME)
BOX_ADVANCED = _struct(_KEY_WHO_CLOCK + ADVANCED_STATS + _GAME)
# One landed payload row (a player's line of one game, before the schedule join).
BASIC_PAYLOAD = _struct(_KEY_WHO_CLOCK + BASIC_STATS)
ADVANCED_PAYLOAD = _struct(_KEY_WHO_CLOCK + ADVANCED_STATS)

PREDICTIONS = _struct([
    ("gameId", S), ("gameDate", T.DateType()), ("teamId", L), ("opponentId", L),
    ("personId", L), ("fullName", S), ("predictedPoints", D),
])

AUDIT_COLUMN = "aud_modification_date"
CORRUPT_COLUMN = "_corrupt_record"
FILE_COLUMN = "_payload_file"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, S, True)])
