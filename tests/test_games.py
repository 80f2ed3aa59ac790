"""Schedule operators on hand-made rows: id forms (Q10, Q11), home = away (Q24), date window,
game types."""

import datetime as dt

from pyspark.sql import functions as F

from boxstats.operators import games as G
from boxstats.operators import joins as J
from boxstats.operators.joins import new_columns_only


def test_new_games_matches_integer_stored_ids(spark):
    finals = spark.createDataFrame([("0022400001", "3"), ("0022400002", "3"), ("0022400003", "1"),
                                    ("abc", "3")], "game_id string, game_status string")
    stored = spark.createDataFrame([(22400001,), (22400001,), (None,)], "gameId long")
    got = sorted(r.game_id for r in G.new_games(G.finished(finals), stored).collect())
    assert got == ["0022400002", "abc"]
    first_run = sorted(r.game_id for r in G.new_games(G.finished(finals), None).collect())
    assert first_run == ["0022400001", "0022400002", "abc"]


def test_player_games_home_equals_away(spark):
    games = spark.createDataFrame([("0022400010", 1, 1), ("0022400011", 1, 2)],
                                  "gameId string, homeTeam_teamId long, awayTeam_teamId long") \
        .withColumn("gameDate", F.lit("2024-11-01 00:00:00").cast("timestamp_ntz"))
    roster = spark.createDataFrame([(7, "p7", 1, "G-F"), (8, "p8", 2, None)],
                                   "person_id long, player_slug string, team_id long, position string")
    rows = G.player_games(games, roster).collect()
    same = [r for r in rows if r.gameId == "0022400010"]
    assert len(same) == 2 and all(r.is_home for r in same)       # both sides count as home
    other = {r.person_id: r for r in rows if r.gameId == "0022400011"}
    assert other[7].opponent == 2 and other[7].is_home and other[7].position_group == "G"
    assert other[8].opponent == 1 and not other[8].is_home and other[8].position_group is None
    assert {r.season for r in rows} == {2024}


def test_games_between_days_and_types(spark):
    df = spark.createDataFrame(
        [(f"00{t}2400{k:03d}", dt.datetime(2024, 11, k)) for k in range(1, 10) for t in (1, 2, 4)],
        "game_id string, d timestamp_ntz")
    assert G.games_between(df, "d", "2024-11-03").count() == 3
    assert G.games_between(df, "d", dt.date(2024, 11, 3), days=3).count() == 9
    assert G.games_between(df, "d", "2025-01-01").isEmpty()
    typed = G.with_game_type(df, "game_id")
    assert typed.count() == 18
    assert G.with_game_type(df, "game_id", keep=("playoffs",)).count() == 9


def test_broadcast_bound_is_measured(spark, monkeypatch):
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "a long, s string")
    rows, size = J.measured_size(df)
    assert rows == 2 and 1000 < size < 1200
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(J.bounded_broadcast(df))
    monkeypatch.setattr(J, "BROADCAST_BYTES", 500)         # long texts count with their length
    assert not hinted(J.bounded_broadcast(df))
    assert J.measured_size(df.limit(0)) == (0, 0)


def test_new_columns_only(spark):
    left = spark.createDataFrame([(1, 2, "x")], "a long, b long, c string")
    right = spark.createDataFrame([(1, 5, 6.0, "y")], "a long, b long, d double, c string")
    assert new_columns_only(right, left, ["a"]).columns == ["a", "d"]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

IDS = st.sampled_from(["0022400001", "0022400002", "0042400003", "22400004", "abc", None])


@settings(max_examples=5, deadline=None)
@given(st.lists(IDS, max_size=6), st.lists(IDS, max_size=6))
def test_new_games_partition_finals(spark, finals_ids, stored_ids):
    finals = spark.createDataFrame([(g, "3") for g in finals_ids],
                                   "game_id string, game_status string")
    stored = spark.createDataFrame([(g,) for g in stored_ids], "gameId string")
    new = [r.game_id for r in G.new_games(finals, stored).collect()]
    norm = lambda g: ("00" + g) if g is not None and g.isdigit() and len(g) == 8 else g  # noqa
    seen = {norm(g) for g in stored_ids if g is not None}
    # J1 + stored finals = finals: every final is new exactly when its id is not stored.
    assert sorted(map(str, new)) == sorted(str(g) for g in finals_ids if norm(g) not in seen)
