"""Scalar column expressions (I1-I12 of the blueprint).

Every function takes and returns ``Column`` objects built from native Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF. All are total: junk input gives NULL (or
the documented default), never an exception, also with ANSI mode on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source pipeline's for the same results.
# Game id prefixes: "004" playoffs, "002" regular season. Finished game status: "3".
PLAYOFFS_PREFIX = "004"
REGULAR_SEASON_PREFIX = "002"
FINISHED_STATUS = "3"
# Roster position to position group.
POSITION_GROUPS = {
    "G": "G", "G-F": "G",
    "F": "F", "F-G": "F", "F-C": "F",
    "C": "C", "C-F": "C",
}
# Value given to a missing box-score position, and the literal the opponent filter removes.
BENCH_FILL = "bench"
BENCH_LITERAL = "BENCH"
# Season = two digits of the game id + this year.
SEASON_BASE_YEAR = 2000

_INT = r"\s*[+-]?[0-9]+\s*"
_TWO_RE = f"^{_INT}:{_INT}$"
_THREE_RE = f"^{_INT}:{_INT}:{_INT}$"
_NUM_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_minutes(c) -> Column:
    """Clock text to minutes (double).

    NULL or '' -> 0.0; ``MM:SS`` -> m + s/60; ``H:MM:SS`` -> 60h + m + s/60; a single number ->
    that number; anything else (``PT34M``, ``12:x``, ``1:2:3:4``) -> 0.0. Parts must be whole
    numbers (signed digits, surrounding whitespace allowed).

    Each form is recognised by one anchored pattern over the whole text, so the casts that
    follow only ever see valid input: a failing ANSI cast is far slower than a pattern test.
    The first test is the common ``MM:SS`` form. ``get`` is used for parts, so a short array
    never raises.
    """
    s = _c(c).cast("string")
    parts = F.split(s, ":")

    def part(i: int) -> Column:
        return F.get(parts, i).try_cast("long").cast("double")

    sixty = F.lit(60.0)
    value = (
        F.when(s.rlike(_TWO_RE), part(0) + part(1) / sixty)
        .when(s.rlike(_THREE_RE), part(0) * sixty + part(1) + part(2) / sixty)
        .when(s.rlike(_NUM_RE), F.trim(s).try_cast("double"))
    )
    return F.coalesce(value, F.lit(0.0))


def normalise_game_id(c) -> Column:
    """Game id as text; an 8-digit id (integer form) gets the ``00`` prefix.

    Not a blind ``lpad``: junk such as ``abc`` stays junk instead of turning into a valid id.
    """
    s = _c(c).cast("string")
    return F.when(s.rlike(r"^[0-9]{8}$"), F.concat(F.lit("00"), s)).otherwise(s)


def season_of(c) -> Column:
    """Season start year from a game id, NULL when it cannot be read.

    8 characters: characters 2-3 + 2000; starting with ``00``: characters 4-5 + 2000.
    """
    s = _c(c).cast("string")
    two_a = F.substring(s, 2, 2)
    two_b = F.substring(s, 4, 2)
    digits = r"^[0-9]{2}$"
    return (
        F.when((F.length(s) == 8) & two_a.rlike(digits),
               two_a.cast("int") + F.lit(SEASON_BASE_YEAR))
        .when((F.length(s) != 8) & s.startswith("00") & two_b.rlike(digits),
              two_b.cast("int") + F.lit(SEASON_BASE_YEAR))
    )


def is_game_type(c, prefix: str) -> Column:
    """True when the (text) game id starts with ``prefix``; NULL id gives NULL."""
    return _c(c).cast("string").startswith(prefix)


def is_playoffs(c) -> Column:
    return is_game_type(c, PLAYOFFS_PREFIX)


def is_regular_season(c) -> Column:
    return is_game_type(c, REGULAR_SEASON_PREFIX)


def _group_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in POSITION_GROUPS.items() for x in kv])


def roster_group(c) -> Column:
    """Roster position to group (G/F/C); unknown values pass through unchanged."""
    pos = _c(c)
    return F.coalesce(F.try_element_at(_group_map(), pos), pos)


def history_group(position, roster_position) -> Column:
    """Group of a historical box-score row.

    A starter keeps the starting position; a ``bench`` row takes the group of the roster
    position when it is one of the known ones, else stays ``bench``.
    """
    pos = _c(position)
    mapped = F.try_element_at(_group_map(), _c(roster_position))
    return F.when(pos == F.lit(BENCH_FILL), F.coalesce(mapped, F.lit(BENCH_FILL))).otherwise(pos)


def opponent_of(team, home, away) -> Column:
    """The other team of the game: away when ``team`` is home, else home (also for NULL team)."""
    return F.when(_c(team) == _c(home), _c(away)).otherwise(_c(home))


def is_home(team, home) -> Column:
    """``team == home`` where a missing side counts as not home (never NULL)."""
    return F.coalesce(_c(team) == _c(home), F.lit(False))


def per36(stat, minutes) -> Column:
    """stat / minutes * 36; zero or missing minutes give NULL (skipped by means)."""
    return F.try_divide(_c(stat).cast("double"), _c(minutes).cast("double")) * F.lit(36.0)


def per_possession(stat, possessions) -> Column:
    """stat / possessions; zero or missing possessions give NULL."""
    return F.try_divide(_c(stat).cast("double"), _c(possessions).cast("double"))


def finite_or_zero(c) -> Column:
    """NULL, NaN and +-inf to 0.0: what a feature matrix needs."""
    x = _c(c).cast("double")
    return F.when(F.isnull(x) | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(0.0)) \
        .otherwise(x)
