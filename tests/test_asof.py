"""As-of join against a plain search, with and without chunks."""

import datetime as dt
import random

import pytest

from boxstats.operators.asof import as_of_join
from boxstats.operators.windows import rolling_means


def day(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("hot_rows", [None, 7, 10**6])
def test_equals_a_plain_search(spark, hot_rows):
    """Ties in time, equal times on both sides, NULL keys and times, one key with most rows."""
    rng = random.Random(3)
    key = lambda: rng.choice([1, 1, 1, 1, 2, 3, None])
    when = lambda: rng.choice([None, *range(40)])
    right = [(key(), day(when()), i, float(i)) for i in range(120)]
    left = [(key(), day(when()), f"q{i}", "x") for i in range(60)] + [(9, day(3), "alone", "x")]
    a = spark.createDataFrame(left, "player long, at timestamp, name string, value_x string")
    b = spark.createDataFrame(right, "player long, ts timestamp, id long, value double")
    got = as_of_join(a.repartition(3), b.repartition(4), "player", "at", "ts", ["id", "value"],
                     ties=("id",), hot_rows=hot_rows)
    assert got.columns == ["player", "at", "name", "value_x", "id", "value"]
    for r in got.collect():
        own = [x for x in right if x[0] is not None and x[0] == r["player"] and x[1] is not None
               and (r["at"] is None or x[1] < r["at"])]
        want = max(own, key=lambda x: (x[1], x[2]), default=(None,) * 4)
        assert (r["id"], r["value"]) == want[2:], r
    assert got.count() == len(left)


def test_empty_sides(spark):
    a = spark.createDataFrame([(1, day(1))], "player long, at timestamp")
    b = spark.createDataFrame([], "player long, ts timestamp, value double")
    assert [r["value"] for r in as_of_join(a, b, "player", "at", "ts", ["value"]).collect()] == [None]
    assert as_of_join(a.limit(0), b, "player", "at", "ts", ["value"]).collect() == []


def test_previous_value_in_chunks(spark):
    """The row before, across the chunks of a hot player."""
    rows = [(1 if i % 3 else 2, i, float(i)) for i in range(90)] + [(None, 5, 5.0)]
    df = spark.createDataFrame(rows, "player long, ts long, value double").repartition(4)
    got = rolling_means(df, ["value"], "player", ["ts"], windows=(2,), include_current=False,
                        hot_rows=10, previous=("value",))
    for r in got.collect():
        step = {1: 1 if r["ts"] % 3 == 2 else 2, 2: 3}.get(r["player"])
        before = None if step is None or r["ts"] < step or (r["player"] == 1 and r["ts"] == 1) \
            else r["value"] - step
        assert r["value_previous"] == before, r
