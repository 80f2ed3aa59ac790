"""Golden tests for the scalar expressions (I1-I12), one row per quirk."""

import math

import pytest
from pyspark.sql import functions as F

from boxstats.functions import scalars as X

MINUTES = [
    ("34:12", 34 + 12 / 60), ("1:02:30", 62.5), ("0:00", 0.0), ("12.5", 12.5), ("", 0.0),
    (None, 0.0), ("PT34M", 0.0), ("12:x", 0.0), ("1:2:3:4", 0.0), ("-1:30", -0.5),
    (" 7 ", 7.0), ("40", 40.0), ("1e2", 100.0), ("1d", 0.0), ("NaN", 0.0), ("1.5:00", 0.0),
]


def test_parse_minutes(spark):
    df = spark.createDataFrame([(v,) for v, _ in MINUTES], "m string")
    got = [r[0] for r in df.select(X.parse_minutes("m")).collect()]
    for (text, want), value in zip(MINUTES, got):
        assert value == pytest.approx(want), text


def test_parse_minutes_never_raises_on_junk(spark):
    junk = [":", "::", ":::", "a:b:c", "99999999999999999999:1", "٣:00", "--1", ".", "1:"]
    df = spark.createDataFrame([(v,) for v in junk], "m string")
    assert all(r[0] == 0.0 for r in df.select(X.parse_minutes("m")).collect())


IDS = [("0022400123", 2024, "0022400123", False, True),
       ("0042400101", 2024, "0042400101", True, False),
       ("0012400001", 2024, "0012400001", False, False),
       ("22400123", 2024, "0022400123", False, False),
       ("abc", None, "abc", False, False),
       (None, None, None, None, None)]


def test_game_ids(spark):
    df = spark.createDataFrame([(i,) for i, *_ in IDS], "g string")
    rows = df.select(X.season_of("g"), X.normalise_game_id("g"),
                     X.is_playoffs("g"), X.is_regular_season("g")).collect()
    for (raw, season, norm, po, rs), r in zip(IDS, rows):
        assert (r[0], r[1]) == (season, norm), raw
        if raw is not None and raw.startswith("00"):
            assert (r[2], r[3]) == (po, rs)


def test_integer_game_id_is_normalised(spark):
    df = spark.createDataFrame([(22400123,), (12345,)], "g long")
    got = [r[0] for r in df.select(X.normalise_game_id("g")).collect()]
    assert got == ["0022400123", "12345"]


ROSTER = ["G", "G-F", "F", "F-G", "F-C", "C", "C-F", "X", None, "", "g"]
BOX = ["G", "F", "C", "bench", "BENCH", "G-F", "X", None, "", "c", "F-C", "C-F"]


def _three_branch(pos, roster):
    if pos in ("G", "bench") and roster in ("G", "G-F"):
        return "G"
    if pos in ("F", "bench") and roster in ("F", "F-G", "F-C"):
        return "F"
    if pos in ("C", "bench") and roster in ("C", "C-F"):
        return "C"
    return pos


def test_history_group_equals_three_branch_rule(spark):
    pairs = [(p, r) for p in BOX for r in ROSTER]
    df = spark.createDataFrame(pairs, "p string, r string")
    got = [row[0] for row in df.select(X.history_group("p", "r")).collect()]
    assert got == [_three_branch(p, r) for p, r in pairs]


def test_roster_group(spark):
    df = spark.createDataFrame([(v,) for v in ROSTER], "p string")
    got = [r[0] for r in df.select(X.roster_group("p")).collect()]
    want = [X.POSITION_GROUPS.get(v, v) if v is not None else None for v in ROSTER]
    assert got == want


def test_opponent_and_home(spark):
    rows = [(1, 1, 2), (2, 1, 2), (None, 1, 2), (3, 3, 3), (1, None, 2)]
    df = spark.createDataFrame(rows, "t long, h long, a long")
    got = df.select(X.opponent_of("t", "h", "a"), X.is_home("t", "h")).collect()
    assert [tuple(r) for r in got] == [(2, True), (1, False), (1, False), (3, True),
                                        (None, False)]


def test_rates_zero_denominators(spark):
    rows = [(10.0, 0.0, 0.0), (0.0, 0.0, 5.0), (9.0, 18.0, 3.0), (None, 10.0, 2.0)]
    df = spark.createDataFrame(rows, "x double, m double, p double")
    got = df.select(X.per36("x", "m"), X.per_possession("x", "p")).collect()
    assert [tuple(r) for r in got] == [(None, None), (None, 0.0), (18.0, 3.0), (None, None)]


def test_finite_or_zero(spark):
    rows = [(None,), (float("nan"),), (float("inf"),), (float("-inf"),), (2.5,)]
    df = spark.createDataFrame(rows, "x double")
    got = [r[0] for r in df.select(X.finite_or_zero("x")).collect()]
    assert got == [0.0, 0.0, 0.0, 0.0, 2.5]
    assert all(math.isfinite(v) for v in got)


def test_no_python_udf_in_scalars(spark):
    df = spark.createDataFrame([("34:12", "0022400123")], "m string, g string")
    plan = df.select(X.parse_minutes("m"), X.season_of("g"), X.normalise_game_id("g"),
                     X.history_group(F.lit("bench"), F.lit("G")))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Python" not in plan
