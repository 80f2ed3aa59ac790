"""DuckDB SQL for each registered query, written independently of the Spark code.

Tables are the driver's views (region nation customer supplier part orders lineitem events
...). Divisions use ``nullif`` (DuckDB gives inf/NaN for x/0), doubles are rounded to 6 places.
"""

from __future__ import annotations

R = 6

# B1 (events as a box score) in SQL.
_B1 = """
b1 AS (
  SELECT user_id, event_id, ts, value, event_type AS position,
         user_id // 15 AS team, event_id % 30 AS opponent,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS minutes,
         CAST(event_id % 7 AS DOUBLE) AS possessions
  FROM events
),
b1r AS (
  SELECT *, value / nullif(minutes, 0) * 36 AS value_per36,
            value / nullif(possessions, 0) AS value_per_poss
  FROM b1
)"""

_RATES = ("value_per36", "value_per_poss")
_WINDOWS = (5, 10, 20)
_B1_W = "PARTITION BY user_id ORDER BY ts ASC NULLS LAST, event_id ASC NULLS LAST"


def ordered_mean(c: str, oldest: int, newest: int, window: str) -> str:
    """Mean of ``c`` over rows (i-oldest .. i-newest), NULLs skipped, summed oldest first.

    Written as an explicit left-to-right sum so that the double result is reproducible."""
    terms = [c if k == 0 else f"lag({c}, {k}) OVER ({window})"
             for k in range(oldest, newest - 1, -1)]
    total = " + ".join(f"coalesce({t}, 0.0)" for t in terms)
    count = " + ".join(f"CASE WHEN {t} IS NULL THEN 0 ELSE 1 END" for t in terms)
    return f"(0.0 + {total}) / nullif({count}, 0)"


def _rolling_cols(lagged: bool = False) -> str:
    cols = []
    for c in _RATES:
        for n in _WINDOWS:
            if lagged:
                expr, name = ordered_mean(c, n, 1, _B1_W), f"{c}_lag_rolling_{n}"
            else:
                expr, name = ordered_mean(c, n - 1, 0, _B1_W), f"{c}_rolling_{n}"
            cols.append(f"{expr} AS {name}")
    return ",\n  ".join(cols)


ROLLING_RATE_FEATURES = f"""
WITH {_B1}
SELECT user_id, event_id, ts,
  value_per36, value_per_poss,
  {_rolling_cols()}
FROM b1r
"""

_SKEW_W = "PARTITION BY player ORDER BY ts ASC NULLS LAST, event_id ASC NULLS LAST"
ROLLING_RATE_FEATURES_SKEWED = f"""
WITH {_B1},
sk AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL WHEN user_id % 3 = 0 THEN -1
                       ELSE user_id END AS player FROM b1r)
SELECT CAST(player AS DOUBLE) AS player, event_id, ts, value_per36, value_per_poss,
  """ + ",\n  ".join(
    f"CASE WHEN player IS NOT NULL THEN {ordered_mean(c, n - 1, 0, _SKEW_W)} END"
    f" AS {c}_rolling_{n}" for c in _RATES for n in _WINDOWS
) + """
FROM sk
"""

LATEST_FEATURES_PER_PLAYER = f"""
WITH {_B1},
f AS (
  SELECT user_id, event_id, ts,
    value_per36, value_per_poss,
    {_rolling_cols()},
    row_number() OVER (PARTITION BY user_id
                       ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
  FROM b1r
)
SELECT * EXCLUDE (rn) FROM f WHERE rn = 1 AND user_id IS NOT NULL
"""

ROLLING_LAGGED_FEATURES = f"""
WITH {_B1}
SELECT user_id, event_id, ts,
  {_rolling_cols(lagged=True)}
FROM b1r
"""

_BACKTEST_COLS = [f"{c}_rolling_{n}" for c in _RATES for n in _WINDOWS]
BACKTEST_FEATURES = f"""
WITH {_B1},
sk AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS player FROM b1r),
f AS (
  SELECT player, event_id, ts, """ + ", ".join(
    f"{ordered_mean(c, n - 1, 0, _SKEW_W)} AS {c}_rolling_{n}"
    for c in _RATES for n in _WINDOWS) + """
  FROM sk
),
asked AS (SELECT DISTINCT player, CAST(ts AS DATE) + 1 AS day FROM sk),
last AS (SELECT a.player, a.day, max(f.ts) AS ts FROM asked a
         JOIN f ON f.player = a.player AND f.ts < a.day GROUP BY ALL),
own AS (SELECT l.player, l.day, max(f.event_id) AS event_id
        FROM last l JOIN f ON f.player = l.player AND f.ts = l.ts GROUP BY ALL)
SELECT a.player, a.day, CAST(own.event_id AS DOUBLE) AS event_id, """ + ", ".join(
    f"round(f.{c}, {R}) AS {c}" for c in _BACKTEST_COLS) + """
FROM asked a LEFT JOIN own ON own.player = a.player AND own.day = a.day
LEFT JOIN f ON f.player = a.player AND f.event_id = own.event_id
"""

# B2 (order x supplier nation revenue as points) in SQL.
_B2 = """
per_nation AS (
  SELECT l_orderkey, s_nationkey, sum(l_extendedprice) AS points
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
),
b2 AS (
  SELECT o_orderkey AS game, o_orderdate AS game_date, o_custkey AS player,
         c_nationkey AS team, c_mktsegment AS position_group, s_nationkey AS opponent, points
  FROM per_nation JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
)"""


def _avg_of_daily(src: str, value: str) -> str:
    """A1 -> A2/A3 as SQL CTEs named d (daily), r (ranked), a (averages)."""
    return f"""
d AS (
  SELECT position_group, opponent, game_date, avg({value}) AS avg_points FROM {src}
  WHERE position_group IS NOT NULL AND opponent IS NOT NULL AND game_date IS NOT NULL
  GROUP BY ALL
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY position_group, opponent
                               ORDER BY game_date DESC NULLS FIRST) AS rn FROM d
),
a AS (
  SELECT position_group, opponent,
    avg(CASE WHEN rn <= 10 THEN avg_points END) AS avg_pts_opp_position_last_10,
    avg(CASE WHEN rn <= 20 THEN avg_points END) AS avg_pts_opp_position_last_20,
    avg(avg_points) AS avg_pts_opp_position_all
  FROM r GROUP BY ALL
)"""


DAILY_MEAN_BY_GROUP = f"""
WITH {_B2}
SELECT position_group, opponent, game_date, round(avg(points), {R}) AS avg_points
FROM b2
WHERE position_group IS NOT NULL AND opponent IS NOT NULL AND game_date IS NOT NULL
GROUP BY ALL
"""

OPPONENT_POSITION_AVERAGES = f"""
WITH {_B2}, {_avg_of_daily("b2", "points")}
SELECT position_group, opponent,
  round(avg_pts_opp_position_last_10, {R}) AS avg_pts_opp_position_last_10,
  round(avg_pts_opp_position_last_20, {R}) AS avg_pts_opp_position_last_20,
  round(avg_pts_opp_position_all, {R}) AS avg_pts_opp_position_all
FROM a
"""

# The events with the corrections of the last batch.
_CORRECTED = """
corrected AS (
  SELECT * REPLACE (
    CASE WHEN event_type = 'purchase' THEN user_id + 1 ELSE user_id END AS user_id,
    CASE WHEN event_type = 'purchase' THEN ts - INTERVAL 10 DAY ELSE ts END AS ts,
    CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value END AS value)
  FROM events
),"""
_CORRECTED_B1 = _CORRECTED + _B1.replace("FROM events", "FROM corrected")
INCREMENTAL_FEATURES = LATEST_FEATURES_PER_PLAYER.replace(_B1, _CORRECTED_B1)
MAINTAINED_AVERAGES = f"""
WITH {_CORRECTED_B1},
h AS (SELECT position AS position_group, opponent, CAST(ts AS DATE) AS game_date, value FROM b1),
{_avg_of_daily("h", "value")}
SELECT position_group, opponent,
  round(avg_pts_opp_position_last_10, {R}) AS avg_pts_opp_position_last_10,
  round(avg_pts_opp_position_last_20, {R}) AS avg_pts_opp_position_last_20,
  round(avg_pts_opp_position_all, {R}) AS avg_pts_opp_position_all
FROM a
"""

WITH_OPPONENT_AVERAGES = f"""
WITH {_B1},
h AS (
  SELECT event_id, user_id, position AS position_group, opponent,
         CAST(ts AS DATE) AS game_date, value
  FROM b1
), {_avg_of_daily("h", "value")}
SELECT h.event_id, h.user_id, h.position_group, h.opponent,
  round(a.avg_pts_opp_position_last_10, {R}) AS avg_pts_opp_position_last_10,
  round(a.avg_pts_opp_position_last_20, {R}) AS avg_pts_opp_position_last_20,
  round(a.avg_pts_opp_position_all, {R}) AS avg_pts_opp_position_all
FROM h LEFT JOIN a ON h.position_group = a.position_group AND h.opponent = a.opponent
"""

_GAME_ID_TEXT = """CASE WHEN regexp_full_match(CAST({c} AS VARCHAR), '[0-9]{{8}}')
  THEN '00' || CAST({c} AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"""

NEW_FINISHED_GAMES = f"""
SELECT {_GAME_ID_TEXT.format(c="o_orderkey")} AS game_id, o_orderdate AS game_date,
       o_custkey // 15 AS home_team_id, o_custkey // 15 + 7 AS away_team_id
FROM orders
WHERE o_orderstatus = 'F'
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')
"""

REPLACE_BY_KEY = """
WITH batch AS (
  SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 100.0 AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'O'
)
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
UNION ALL
SELECT * FROM batch
"""

_UPCOMING_FROM = "TIMESTAMP '1996-03-01'"
_UPCOMING_TO_1 = "TIMESTAMP '1996-03-02'"
_UPCOMING_TO_7 = "TIMESTAMP '1996-03-08'"
_ROSTER_GROUP = """CASE {c} WHEN 'G' THEN 'G' WHEN 'G-F' THEN 'G' WHEN 'F' THEN 'F'
  WHEN 'F-G' THEN 'F' WHEN 'F-C' THEN 'F' WHEN 'C' THEN 'C' WHEN 'C-F' THEN 'C' ELSE {c} END"""

PLAYER_GAMES = f"""
WITH g AS (
  SELECT o_orderkey AS game_id, o_orderdate AS game_date,
         o_custkey // 15 AS home, o_custkey // 15 + 7 AS away
  FROM orders WHERE o_orderdate >= {_UPCOMING_FROM} AND o_orderdate < {_UPCOMING_TO_7}
),
r AS (
  SELECT DISTINCT c_custkey AS person_id, c_name AS player_slug,
         c_custkey // 15 AS team_id, c_mktsegment AS position
  FROM customer
),
s AS (
  SELECT game_id, game_date, home, away, home AS team_id FROM g
  UNION ALL
  SELECT game_id, game_date, home, away, away AS team_id FROM g
)
SELECT s.game_id, s.game_date, r.team_id, r.person_id, r.player_slug, r.position,
  CASE WHEN r.team_id = s.home THEN s.away ELSE s.home END AS opponent,
  {_ROSTER_GROUP.format(c="r.position")} AS position_group,
  coalesce(r.team_id = s.home, false) AS is_home
FROM s JOIN r ON s.team_id = r.team_id
"""

_B3_COLS = """o_orderkey AS game_id, o_orderdate AS game_date, o_custkey // 15 AS home_team_id,
  o_custkey // 15 + 7 AS away_team_id, o_orderstatus AS game_status, o_totalprice"""

GAMES_ON_DATE = f"""
SELECT {_B3_COLS} FROM orders
WHERE o_orderdate >= {_UPCOMING_FROM} AND o_orderdate < {_UPCOMING_TO_1}
"""

GAMES_IN_DAYS = f"""
SELECT {_B3_COLS} FROM orders
WHERE o_orderdate >= {_UPCOMING_FROM} AND o_orderdate < {_UPCOMING_TO_7}
"""

METADATA_JOIN = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, o_orderstatus, o_orderdate
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
"""

PLAYER_ATTRIBUTES_JOIN = """
SELECT o_orderkey, o_custkey, o_totalprice, c_nationkey, c_acctbal,
       c_mktsegment AS segment_player
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""

BASIC_ADVANCED_JOIN = f"""
WITH basic AS (
  SELECT l_orderkey, l_suppkey, sum(l_quantity) AS quantity,
         sum(l_extendedprice) AS revenue, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY 1, 2
),
adv AS (
  SELECT l_orderkey, l_suppkey, avg(l_discount) AS avg_discount, sum(l_tax) AS tax
  FROM lineitem WHERE l_discount > 0 GROUP BY 1, 2
)
SELECT b.l_orderkey, b.l_suppkey, round(b.quantity, {R}) AS quantity,
  round(b.revenue, {R}) AS revenue, b.last_ship, round(a.avg_discount, {R}) AS avg_discount,
  round(a.tax, {R}) AS tax
FROM basic b LEFT JOIN adv a ON b.l_orderkey = a.l_orderkey AND b.l_suppkey = a.l_suppkey
WHERE b.quantity IS NOT NULL
"""

_Q = "CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR)"
_INT = "'\\s*[+-]?[0-9]+\\s*'"
_NUM = "'\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*'"


def _is_int(x: str) -> str:
    return f"regexp_full_match({x}, {_INT})"


def _num(x: str) -> str:
    return f"CAST(trim({x}) AS DOUBLE)"


PARSE_MINUTES = f"""
WITH c AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 1
           THEN {_Q} || ':' || lpad(CAST((l_linenumber * 8) % 60 AS VARCHAR), 2, '0')
         WHEN l_linenumber = 2 THEN '1:' || lpad({_Q}, 2, '0') || ':30'
         WHEN l_linenumber = 3 THEN CAST(l_quantity AS VARCHAR)
         WHEN l_linenumber = 4 THEN 'PT' || {_Q} || 'M'
         WHEN l_linenumber = 5 THEN {_Q} || ':x'
         WHEN l_linenumber = 6 THEN {_Q} || ':2:3:4'
         WHEN l_linenumber = 7 AND l_quantity > 25 THEN NULL
         ELSE '' END AS clock
  FROM lineitem
),
p AS (SELECT *, string_split(clock, ':') AS parts FROM c)
SELECT l_orderkey, l_linenumber, clock,
  CASE
    WHEN clock IS NULL OR clock = '' THEN 0.0::DOUBLE
    WHEN len(parts) = 2 AND {_is_int("parts[1]")} AND {_is_int("parts[2]")}
      THEN {_num("parts[1]")} + {_num("parts[2]")} / 60.0::DOUBLE
    WHEN len(parts) = 3 AND {_is_int("parts[1]")} AND {_is_int("parts[2]")}
         AND {_is_int("parts[3]")}
      THEN {_num("parts[1]")} * 60.0::DOUBLE + {_num("parts[2]")}
           + {_num("parts[3]")} / 60.0::DOUBLE
    WHEN len(parts) = 1 AND regexp_full_match(clock, {_NUM}) THEN {_num("clock")}
    ELSE 0.0::DOUBLE END AS minutes
FROM p
"""

_RAW_ID = """CASE o_orderpriority
    WHEN '1-URGENT' THEN '002' || {yy} || {serial}
    WHEN '2-HIGH' THEN '004' || {yy} || {serial}
    WHEN '3-MEDIUM' THEN '2' || {yy} || {serial}
    WHEN '4-NOT SPECIFIED' THEN '001' || {yy} || {serial}
    ELSE 'g' || CAST(o_orderkey AS VARCHAR) END""".format(
    yy="lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0')",
    serial="lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0')")
_IDS = f"""ids AS (
  SELECT o_orderkey, {_RAW_ID} AS raw_id, o_orderdate, o_orderstatus, o_orderpriority,
         o_custkey
  FROM orders
)"""
_NORM = "CASE WHEN regexp_full_match(raw_id, '[0-9]{8}') THEN '00' || raw_id ELSE raw_id END"

EXTRACT_SEASON = f"""
WITH {_IDS}
SELECT o_orderkey, raw_id,
  CAST(CASE WHEN length(raw_id) = 8 AND regexp_full_match(substr(raw_id, 2, 2), '[0-9]{{2}}')
         THEN CAST(substr(raw_id, 2, 2) AS INTEGER) + 2000
       WHEN length(raw_id) <> 8 AND starts_with(raw_id, '00')
            AND regexp_full_match(substr(raw_id, 4, 2), '[0-9]{{2}}')
         THEN CAST(substr(raw_id, 4, 2) AS INTEGER) + 2000 END AS DOUBLE) AS season
FROM ids
"""

GAME_ID_NORMALISE = f"""
WITH {_IDS}
SELECT o_orderkey, raw_id, {_NORM} AS game_id FROM ids
"""

GAME_TYPE_FLAGS = f"""
WITH {_IDS}, n AS (SELECT o_orderkey, {_NORM} AS game_id FROM ids)
SELECT o_orderkey, game_id, starts_with(game_id, '004') AS is_playoffs,
       starts_with(game_id, '002') AS is_regular_season
FROM n WHERE starts_with(game_id, '004') OR starts_with(game_id, '002')
"""

_KNOWN_GROUP = """CASE {c} WHEN 'G' THEN 'G' WHEN 'G-F' THEN 'G' WHEN 'F' THEN 'F'
  WHEN 'F-G' THEN 'F' WHEN 'F-C' THEN 'F' WHEN 'C' THEN 'C' WHEN 'C-F' THEN 'C' END"""
_PARTS = """pp AS (
  SELECT p_partkey,
    [NULL, 'G', 'F', 'C', 'BENCH'][p_partkey % 5 + 1] AS position,
    ['G', 'G-F', 'F', 'F-G', 'F-C', 'C', 'C-F', 'X'][p_size % 8 + 1] AS position_player
  FROM part
)"""

POSITION_GROUP_ROSTER = f"""
WITH {_PARTS}
SELECT p_partkey, position_player,
  coalesce({_KNOWN_GROUP.format(c="position_player")}, position_player) AS position_group
FROM pp
"""

POSITION_GROUP_HISTORY = f"""
WITH {_PARTS}, f AS (
  SELECT p_partkey, coalesce(position, 'bench') AS position, position_player FROM pp
)
SELECT p_partkey, position, position_player,
  CASE WHEN position = 'bench'
       THEN coalesce({_KNOWN_GROUP.format(c="position_player")}, 'bench')
       ELSE position END AS position_group
FROM f WHERE position <> 'BENCH'
"""

_SEASONS = range(1995, 2002)
ONE_HOT_CONTEXT = """
WITH x AS (
  SELECT o_orderkey, coalesce(CAST(c_nationkey AS BIGINT) = o_custkey % 25, false) AS is_home,
         year(o_orderdate) AS season
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
)
SELECT o_orderkey,
  CASE WHEN is_home = false THEN 1.0 ELSE 0.0 END::DOUBLE AS is_home_False,
  CASE WHEN is_home = true THEN 1.0 ELSE 0.0 END::DOUBLE AS is_home_True,
  """ + ",\n  ".join(
    f"CASE WHEN season = {y} THEN 1.0 ELSE 0.0 END::DOUBLE AS season_{y}" for y in _SEASONS
) + """
FROM x
"""

FLATTEN_NESTED = f"""
WITH {_IDS}, n AS (SELECT *, {_NORM} AS game_id FROM ids)
SELECT game_id, starts_with(game_id, '002') AS is_regular_season,
  starts_with(game_id, '004') AS is_playoffs, o_orderpriority AS playoffs_desc,
  CAST(o_orderdate AS DATE) AS game_date,
  o_custkey // 15 AS home_team_id, 'T' || CAST(o_custkey // 15 AS VARCHAR) AS home_team_tricode,
  o_custkey // 15 + 7 AS visitor_team_id,
  'T' || CAST(o_custkey // 15 + 7 AS VARCHAR) AS visitor_team_tricode,
  CASE WHEN o_orderstatus = 'F' THEN '3' ELSE '1' END AS game_status,
  o_orderstatus AS game_status_text
FROM n WHERE starts_with(game_id, '002') OR starts_with(game_id, '004')
"""

SCHEDULE_DATETIME_PARSE = """
WITH t AS (
  SELECT o_orderkey,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'not a date'
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS gameDate
  FROM orders
)
SELECT o_orderkey, gameDate, TRY_CAST(gameDate AS TIMESTAMP) AS game_date FROM t
"""

LOWER_COLUMNS = "SELECT * FROM customer"

DEDUP_ROSTER = """
SELECT DISTINCT c_custkey AS person_id, c_name AS player_slug,
       c_custkey // 15 AS team_id, c_mktsegment AS position
FROM customer
"""

_LINEITEM_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate")
QUALITY_REPORT = "\nUNION ALL\n".join(
    ["""SELECT 'rows' AS "check", '' AS "column", count(*) AS value FROM lineitem"""]
    + [f"""SELECT 'nulls', '{c}', count(*) - count({c}) FROM lineitem""" for c in _LINEITEM_COLS]
    + ["""SELECT 'duplicate_keys', '',
  (SELECT count(*) FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
  - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem
                           WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL))"""]
    + [f"""SELECT 'orphans', '{name}', count(*) FROM lineitem
  WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {ok} FROM {name} WHERE {ok} IS NOT NULL)"""
       for name, k, ok in (("orders", "l_orderkey", "o_orderkey"),
                           ("part", "l_partkey", "p_partkey"),
                           ("supplier", "l_suppkey", "s_suppkey"))]
)

_OPP = ("avg_pts_opp_position_last_10", "avg_pts_opp_position_last_20",
        "avg_pts_opp_position_all")
_OPP_FEATURES = [f"{c}_per36" for c in _OPP] + [f"{c}_per_poss" for c in _OPP]
_B1_FEATURES = [f"{c}_rolling_{n}" for n in _WINDOWS for c in _RATES]


def _finite(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) THEN 0.0::DOUBLE ELSE {x} END"


PREDICTION_INPUTS = f"""
WITH {_B1},
h AS (
  SELECT event_id, user_id, ts, value, minutes, possessions, position AS position_group,
         opponent, CAST(ts AS DATE) AS game_date
  FROM b1
), {_avg_of_daily("h", "value")},
j AS (
  SELECT h.*, a.avg_pts_opp_position_last_10, a.avg_pts_opp_position_last_20,
         a.avg_pts_opp_position_all
  FROM h LEFT JOIN a ON h.position_group = a.position_group AND h.opponent = a.opponent
),
rt AS (
  SELECT *, value / nullif(minutes, 0) * 36 AS value_per36,
         value / nullif(possessions, 0) AS value_per_poss,
         """ + ",\n         ".join(
    [f"{c} / nullif(minutes, 0) * 36 AS {c}_per36" for c in _OPP]
    + [f"{c} / nullif(possessions, 0) AS {c}_per_poss" for c in _OPP]) + f"""
  FROM j
),
f AS (
  SELECT user_id, {_rolling_cols()},
    {", ".join(_OPP_FEATURES)},
    row_number() OVER (PARTITION BY user_id
                       ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
  FROM rt
),
latest AS (SELECT * FROM f WHERE rn = 1 AND user_id IS NOT NULL),
g AS (
  SELECT o_orderkey AS game_id, o_custkey // 15 AS home, o_custkey // 15 + 7 AS away
  FROM orders WHERE o_orderdate >= {_UPCOMING_FROM} AND o_orderdate < {_UPCOMING_TO_7}
),
ros AS (SELECT DISTINCT user_id AS person_id, user_id // 15 AS team_id FROM events),
s AS (
  SELECT game_id, home, away, home AS team_id FROM g
  UNION ALL
  SELECT game_id, home, away, away AS team_id FROM g
),
up AS (
  SELECT s.game_id, ros.person_id, ros.team_id,
         CASE WHEN ros.team_id = s.home THEN s.away ELSE s.home END AS opponent
  FROM s JOIN ros ON s.team_id = ros.team_id
)
SELECT up.game_id, up.person_id, up.team_id, up.opponent,
  """ + ",\n  ".join(
    [f"{_finite('latest.' + c)} AS {c}" for c in _B1_FEATURES]
    + [f"round({_finite('latest.' + c)}, {R}) AS {c}" for c in _OPP_FEATURES]) + """
FROM up JOIN latest ON up.person_id = latest.user_id
"""

STREAM_INGEST = "SELECT * FROM events"
AUDIT_AND_WRITE = "SELECT *, '2024-01-01 12:00:00' AS loaded FROM nation"

INCREMENTAL_INGEST = """
WITH o AS (
  SELECT o_orderkey, '0024' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS gid,
         CAST(o_orderdate AS DATE) AS day, o_custkey // 15 AS home,
         o_orderdate < TIMESTAMP '1997-01-01' AS early, o_orderkey % 10 = 7 AS broken
  FROM orders WHERE o_orderstatus = 'F'
),
r AS (
  SELECT gid AS "gameId", CAST(l_suppkey AS BIGINT) AS "teamId",
         CAST(l_partkey AS BIGINT) AS "personId", CAST(floor(l_quantity) AS INTEGER) AS points,
         CAST(l_linenumber AS INTEGER) AS assists, day AS game_date, home AS home_team_id,
         home + 7 AS visitor_team_id, 'F' AS game_status_text, '2024-01-01 12:00:00' AS loaded,
         early
  FROM lineitem JOIN o ON l_orderkey = o_orderkey WHERE NOT broken
),
c AS (
  SELECT 'finals' AS k, count(*) AS n FROM o
  UNION ALL SELECT 'new', count(*) FROM o
    WHERE broken OR NOT early OR o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT 'saved', count(*) FROM r WHERE NOT early
  UNION ALL SELECT 'deleted', 0
  UNION ALL SELECT 'missing', count(*) FROM o
    WHERE broken OR o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT 'quarantined', count(*) FROM lineitem WHERE l_orderkey % 10 = 7
)
SELECT * EXCLUDE (early) FROM r
UNION ALL
SELECT k, n, 0, 0, 0, DATE '1900-01-01', 0, 0, '', '' FROM c
"""


_BOTH_BOXES = """
WITH o AS (
  SELECT o_orderkey, '0024' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS gid,
         CAST(o_orderdate AS DATE) AS day, o_custkey // 15 AS home, o_orderkey % 10 AS ending,
         o_orderstatus = 'F' AS final, o_orderdate < TIMESTAMP '1997-01-01' AS early,
         o_orderkey IN (SELECT l_orderkey FROM lineitem) AS landed
  FROM orders
),
whole AS (SELECT * FROM o WHERE final AND landed AND ending NOT IN (3, 7)),
r AS (
  SELECT kind, gid AS "gameId", CAST(l_suppkey AS BIGINT) AS "teamId",
         CAST(l_partkey AS BIGINT) AS "personId",
         CASE WHEN kind = 'basic' THEN CAST(floor(l_quantity) AS DOUBLE) END AS points,
         CASE WHEN kind = 'basic' THEN CAST(l_linenumber AS DOUBLE) END AS assists,
         CASE WHEN kind = 'advanced' THEN CAST(l_quantity * 2 AS DOUBLE) END AS possessions,
         day AS game_date, home AS home_team_id, '2024-01-01 12:00:00' AS loaded, early
  FROM lineitem JOIN whole ON l_orderkey = o_orderkey,
       (VALUES ('basic'), ('advanced')) AS kinds(kind)
),
"""
_WITH_COUNTS = """
SELECT * EXCLUDE (early) FROM r
UNION ALL
SELECT k, NULL, n, 0, NULL, NULL, NULL, NULL, 0, NULL FROM c
"""

INGEST_BOX_SCORES = _BOTH_BOXES + """
fresh AS (SELECT * FROM o WHERE final AND NOT (early AND landed AND ending NOT IN (3, 7))),
c AS (
  SELECT 'finals' AS k, count(*) AS n FROM o WHERE final
  UNION ALL SELECT 'new', count(*) FROM fresh
  UNION ALL SELECT 'stored', count(*) FROM whole WHERE NOT early
  UNION ALL SELECT kind || '_saved', n FROM (VALUES ('basic'), ('advanced')) AS kinds(kind),
    (SELECT count(*) // 2 AS n FROM r WHERE NOT early)
  UNION ALL SELECT kind || '_deleted', 0 FROM (VALUES ('basic'), ('advanced')) AS kinds(kind)
  UNION ALL SELECT 'quarantined', count(*) FROM o WHERE landed AND ending = 7
    AND date_trunc('month', day) IN (SELECT date_trunc('month', day) FROM fresh)
)
""" + _WITH_COUNTS

# A month of orders is landed twice, and so are its broken records; orders that end in 5 are not
# landed at all.
STREAM_BOX_SCORES = _BOTH_BOXES.replace("(3, 7)", "(3, 5, 7)") + """
c AS (
  SELECT 'half' AS k, count(*) AS n FROM o WHERE landed AND ending IN (3, 7)
  UNION ALL SELECT 'not finished', count(*) FROM o
    WHERE landed AND ending NOT IN (3, 5, 7) AND NOT final
  UNION ALL SELECT 'unusable', count(*) + count(*) FILTER (
      day >= DATE '1995-05-01' AND day < DATE '1995-06-01') FROM o WHERE landed AND ending = 7
)
""" + _WITH_COUNTS


def _day(shift: int) -> str:
    return f"""CASE WHEN (o_orderkey + {shift}) % 5 = 0 THEN NULL
    WHEN o_orderpriority = '1-URGENT'
      THEN 'x:' || lpad(CAST((o_orderkey + {shift}) % 28 AS VARCHAR), 2, '0')
    ELSE lpad(CAST((o_orderkey + {shift}) % 28 AS VARCHAR), 2, '0') END"""


COMMIT_REPLACE = f"""
SELECT o_orderkey, 'F' AS o_orderstatus, o_orderpriority, o_totalprice, {_day(1)} AS day,
       'late' AS note
FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, {_day(0)}, NULL
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'O'
"""

READ_DIMENSIONS = """
SELECT 'player' AS kind, CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE c_name || ' G-F' END AS text,
       CAST(NULL AS DATE) AS day
FROM customer
UNION ALL
SELECT 'team', CAST(n_nationkey AS VARCHAR), n_name, NULL FROM nation
UNION ALL
SELECT 'game', '00' || lpad(CAST(o_orderkey AS VARCHAR), 8, '2'), o_orderstatus,
       CAST(o_orderdate AS DATE)
FROM orders
"""

# B2 in the box-score contracts in SQL.
_BOX = """
box AS (
  SELECT '00224' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS gid, l_partkey AS pid,
         CAST(min(o_orderdate) AS DATE) AS day, CAST(sum(l_quantity) AS INTEGER) AS points,
         sum(l_linenumber) AS lines
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_partkey
)"""

HISTORICAL_STATS = f"""
WITH {_BOX}
SELECT gid AS "gameId", pid AS "personId", points, CAST(lines AS VARCHAR) || ':30' AS minutes,
       points * 2.0::DOUBLE AS possessions,
       CASE WHEN p_size % 2 = 0 THEN 'G-F' ELSE 'F-C' END AS position_player
FROM box LEFT JOIN part ON pid = p_partkey
"""

TRANSFORM_UPCOMING = f"""
WITH {_BOX},
h AS (
  SELECT *, points / (lines + 0.5::DOUBLE) * 36 AS rate FROM box
),
w AS (
  SELECT pid, avg(rate) OVER (PARTITION BY pid ORDER BY day, gid
                              ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS m,
         row_number() OVER (PARTITION BY pid ORDER BY day DESC, gid DESC) AS rn
  FROM h
),
g AS (
  SELECT '00224' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS gid, o_custkey // 15 AS home
  FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-05' AND o_orderdate < TIMESTAMP '1998-02-04'
),
s AS (SELECT gid, home, home AS team FROM g UNION ALL SELECT gid, home, home + 7 FROM g)
SELECT s.gid AS "gameId", w.pid AS "personId",
       CASE WHEN team = home THEN 1.0 ELSE 0.0 END::DOUBLE AS "is_home_True",
       1.0::DOUBLE AS season_2024, round(m, {R}) AS rolling_5
FROM s JOIN part ON p_partkey // 15 = s.team JOIN w ON w.pid = p_partkey AND rn = 1
"""

QUALITY_SKETCHES = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) AS rows, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
    f"true AS distinct_close, true AS median_close FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_partkey", "l_suppkey"))

COMMITTED_PREDICTIONS = f"""
WITH {_BOX},
g AS (
  SELECT '00224' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS gid, o_custkey // 15 AS home,
         CAST(o_orderdate AS DATE) AS day
  FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-05' AND o_orderdate < TIMESTAMP '1998-02-04'
),
s AS (SELECT gid, day, home AS team, home + 7 AS rival FROM g
      UNION ALL SELECT gid, day, home + 7, home FROM g)
SELECT gid AS "gameId", day AS "gameDate", team AS "teamId", rival AS "opponentId",
       p_partkey AS "personId", 'p' || CAST(p_partkey AS VARCHAR) AS "fullName",
       true AS predicted, '2024-01-01 ' || CASE WHEN day < DATE '1998-01-15' THEN '18' ELSE '12' END
       || ':00:00' AS loaded
FROM s JOIN part ON p_partkey // 15 = team
WHERE p_partkey IN (SELECT pid FROM box)
"""

OPPONENT_AVERAGES_WITHOUT_BENCH = f"""
WITH {_B1},
h AS (
  SELECT position AS position_group, opponent, CAST(ts AS DATE) AS game_date, value
  FROM b1 WHERE position <> 'signup'
), {_avg_of_daily("h", "value")}
SELECT position_group, opponent,
  round(avg_pts_opp_position_last_10, {R}) AS avg_pts_opp_position_last_10,
  round(avg_pts_opp_position_last_20, {R}) AS avg_pts_opp_position_last_20,
  round(avg_pts_opp_position_all, {R}) AS avg_pts_opp_position_all
FROM a
"""

OPPONENT_AVERAGES_BEFORE = f"""
WITH {_B2},
d AS (
  SELECT position_group, opponent, game_date, avg(points) AS m FROM b2
  WHERE position_group IS NOT NULL AND opponent IS NOT NULL AND game_date IS NOT NULL
  GROUP BY ALL
)
SELECT position_group, opponent, game_date,
  round(avg(m) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) + 3.14159265e-4, 2)
    AS avg_pts_opp_position_last_10,
  round(avg(m) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) + 3.14159265e-4, 2)
    AS avg_pts_opp_position_last_20,
  round(avg(m) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 3.14159265e-4, 2)
    AS avg_pts_opp_position_all
FROM d WINDOW w AS (PARTITION BY position_group, opponent ORDER BY game_date)
"""

TRAINING_FRAME = f"""
WITH {_BOX},
h AS (
  SELECT gid, pid, day, points, lines + 0.5::DOUBLE AS mins, points * 2.0::DOUBLE AS poss,
         coalesce(pos, CASE WHEN p_size % 2 = 0 THEN 'G' ELSE 'F' END) AS grp, away AS rival
  FROM box JOIN (
    SELECT '00224' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS gid, l_partkey AS pid,
           CASE max(l_returnflag) WHEN 'N' THEN 'G' WHEN 'R' THEN 'C' END AS pos,
           min(o_custkey // 15 + 7) AS away
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_partkey
  ) USING (gid, pid) LEFT JOIN part ON pid = p_partkey
),
d AS (SELECT grp, rival, day, avg(points) AS m FROM h GROUP BY ALL),
b AS (SELECT grp, rival, day, avg(m) OVER (PARTITION BY grp, rival ORDER BY day
                                           ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS m10
      FROM d)
SELECT gid AS "gameId", pid AS "personId", points,
  round(avg(points / mins * 36) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), {R})
    AS rolling_5,
  round(avg(points / nullif(poss, 0)) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), {R})
    AS per_poss_20,
  round(m10 / lag(mins) OVER w * 36, {R}) AS opponent_10
FROM h JOIN b USING (grp, rival, day)
WINDOW w AS (PARTITION BY pid ORDER BY day, gid)
"""

NO_GAMES = f"SELECT {_B3_COLS} FROM orders WHERE o_orderdate < TIMESTAMP '1900-01-02'"

FEATURE_MATRIX = "SELECT game_id, person_id, " + ", ".join(
    f"round({c}, {R}) AS {c}" for c in _B1_FEATURES + _OPP_FEATURES
) + f" FROM ({PREDICTION_INPUTS})"

SCORE_POINTS = f"""
SELECT CAST(p.game_id AS VARCHAR) AS "gameId", CAST(o_orderdate AS DATE) AS "gameDate",
       p.team_id AS "teamId", p.opponent AS "opponentId", p.person_id AS "personId",
       'u' || CAST(p.person_id AS VARCHAR) AS "fullName", true AS predicted
FROM ({PREDICTION_INPUTS}) p JOIN orders ON p.game_id = o_orderkey
"""

EVALUATE_POINTS = f"""
WITH p AS (
  SELECT ts, value AS y, {ordered_mean("value", 10, 1, _B1_W)} AS p FROM events
  WHERE user_id IS NOT NULL
),
t AS (SELECT y, y - p AS e FROM p WHERE ts >= TIMESTAMP '2024-01-21' AND y IS NOT NULL
      AND p IS NOT NULL)
SELECT round(sqrt(avg(e * e)), {R}) AS rmse, round(avg(abs(e)), {R}) AS mae,
       round(1 - sum(e * e) / nullif(var_pop(y) * count(*), 0), {R}) AS r2
FROM t
"""

ORACLE = {
    "rolling_rate_features": ROLLING_RATE_FEATURES,
    "latest_features_per_player": LATEST_FEATURES_PER_PLAYER,
    "rolling_lagged_features": ROLLING_LAGGED_FEATURES,
    "rolling_rate_features_skewed": ROLLING_RATE_FEATURES_SKEWED,
    "daily_mean_by_group": DAILY_MEAN_BY_GROUP,
    "opponent_position_averages": OPPONENT_POSITION_AVERAGES,
    "with_opponent_averages": WITH_OPPONENT_AVERAGES,
    "new_finished_games": NEW_FINISHED_GAMES,
    "replace_by_key": REPLACE_BY_KEY,
    "player_games": PLAYER_GAMES,
    "games_on_date": GAMES_ON_DATE,
    "games_in_days": GAMES_IN_DAYS,
    "metadata_join": METADATA_JOIN,
    "player_attributes_join": PLAYER_ATTRIBUTES_JOIN,
    "basic_advanced_join": BASIC_ADVANCED_JOIN,
    "parse_minutes": PARSE_MINUTES,
    "extract_season": EXTRACT_SEASON,
    "game_id_normalise": GAME_ID_NORMALISE,
    "game_type_flags": GAME_TYPE_FLAGS,
    "position_group_roster": POSITION_GROUP_ROSTER,
    "position_group_history": POSITION_GROUP_HISTORY,
    "one_hot_context": ONE_HOT_CONTEXT,
    "flatten_nested": FLATTEN_NESTED,
    "schedule_datetime_parse": SCHEDULE_DATETIME_PARSE,
    "lower_columns": LOWER_COLUMNS,
    "dedup_roster": DEDUP_ROSTER,
    "quality_report": QUALITY_REPORT,
    "prediction_inputs": PREDICTION_INPUTS,
    "stream_ingest": STREAM_INGEST,
    "audit_and_write": AUDIT_AND_WRITE,
    "incremental_ingest": INCREMENTAL_INGEST,
    "incremental_features": INCREMENTAL_FEATURES,
    "backtest_features": BACKTEST_FEATURES,
    "maintained_averages": MAINTAINED_AVERAGES,
    "ingest_box_scores": INGEST_BOX_SCORES,
    "stream_box_scores": STREAM_BOX_SCORES,
    "commit_replace": COMMIT_REPLACE,
    "read_dimensions": READ_DIMENSIONS,
    "historical_stats": HISTORICAL_STATS,
    "opponent_averages_without_bench": OPPONENT_AVERAGES_WITHOUT_BENCH,
    "opponent_averages_before": OPPONENT_AVERAGES_BEFORE,
    "training_frame": TRAINING_FRAME,
    "no_games": NO_GAMES,
    "transform_upcoming": TRANSFORM_UPCOMING,
    "quality_sketches": QUALITY_SKETCHES,
    "bucketed_history": HISTORICAL_STATS,
    "committed_predictions": COMMITTED_PREDICTIONS,
    "feature_matrix": FEATURE_MATRIX,
    "score_points": SCORE_POINTS,
    "evaluate_points": EVALUATE_POINTS,
}
