"""Maintained feature state equals a recomputation of the whole history after every batch."""

import random

import pytest
from pyspark.sql import functions as F

from boxstats.operators.opponent import opponent_averages
from boxstats.operators.windows import recent_rows
from boxstats.plans import state as S

SCHEMA = ("player long, game long, day date, points double, position_group string, "
          "opponent long")


def batches(seed):
    """Games of several players in random order of days; later batches also bring games again: on
    other days, with other players, or without any player."""
    import datetime as dt
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.05 else dt.date(2024, 1, rng.randint(1, 28))
    out, number = [], 0
    for n in range(4):
        games = list(range(number, number + 12))
        number += 12
        games += rng.sample(range(number), 6) if n else []
        rows = []
        for g in dict.fromkeys(games):
            d = day()
            players = rng.sample([1, 2, 3, 4, None], rng.randint(1, 3))
            if n == 3 and rng.random() < 0.3:
                players = [None]
            rows += [(p, g, d, rng.choice([None, 1.5, float(rng.randint(0, 30))]),
                      rng.choice(["G", "C", None]), rng.choice([7, 8])) for p in players]
        out.append(rows)
    return out


def replaced(history, rows):
    games = {r[1] for r in rows}
    return [r for r in history if r[1] not in games] + rows


@pytest.mark.parametrize("seed", [1, 2])
def test_state_equals_the_history_after_each_batch(spark, tmp_path, seed):
    order, depth, history = ("day", "game"), 3, []
    recent, daily = str(tmp_path / "recent"), str(tmp_path / "daily")
    for rows in batches(seed):
        batch, stored = (spark.createDataFrame(x, SCHEMA) for x in (rows, history))
        S.update_recent(spark, recent, batch, stored, "player", "game", order, depth)
        # A run that is repeated after a failure does the same again.
        for _ in range(2):
            S.update_daily(spark, daily, batch, "game", ["position_group", "opponent"], "day",
                           "points")
        history = replaced(history, rows)
        full = spark.createDataFrame(history, SCHEMA)
        columns = ["player", "game", "day", "points", S.RANK]
        got = sorted(map(str, S.read_recent(spark, recent).select(columns).collect()))
        assert got == sorted(map(str, recent_rows(full, "player", order, depth, S.RANK)
                                 .select(columns).collect()))
        want = opponent_averages(full, date="day", ns=(2,), exclude_literal=None)
        have = S.maintained_averages(spark, daily, ["position_group", "opponent"], "day", ns=(2,))
        rounded = lambda df: sorted(str(r) for r in df.select(
            [F.round(c, 9).alias(c) if c.startswith("avg") else c for c in want.columns]).collect())
        assert rounded(have) == rounded(want)


def test_only_players_that_run_short_are_read_from_the_history(spark):
    """A player whose last game is replaced by an earlier one needs a row that the state lacks;
    a player with a new game does not, so a history without that player's rows is enough."""
    import datetime as dt
    row = lambda p, g, d: (p, g, dt.date(2024, 1, d), 1.0, "G", 7)
    history = [row(1, g, g) for g in range(1, 6)] + [row(2, 10 + g, g) for g in range(1, 6)]
    full = spark.createDataFrame(history, SCHEMA)
    state = recent_rows(full, "player", ("day", "game"), 3, S.RANK)
    batch = spark.createDataFrame([row(1, 5, 1), row(2, 20, 20)], SCHEMA)
    got = S.merge_recent(state, batch, full.filter("player = 1"), "player", "game",
                         ("day", "game"), 3)
    assert sorted((r["player"], r["game"]) for r in got.collect()) == [
        (1, 2), (1, 3), (1, 4), (2, 14), (2, 15), (2, 20)]
