"""Profiles of batches and bucketed tables."""

import random

from boxstats.operators import profile as P
from boxstats.operators.history import BOX_KEYS, with_advanced
from boxstats.sinks.writers import write_bucketed


def test_profiles_merge_replace_and_drift(spark, tmp_path):
    rng, path = random.Random(8), str(tmp_path / "profiles")

    def batch(name, shift, n=4000):
        rows = [(name, None if i % 10 == 0 else rng.gauss(shift, 1), i % 700) for i in range(n)]
        df = spark.createDataFrame(rows, "day string, x double, y long")
        return P.batch_profiles(df, "day", ["x", "y"])

    for name, shift in (("a", 5.0), ("b", 0.0), ("c", 0.0), ("d", 1.0), ("a", 0.0)):
        P.store_profiles(spark, path, batch(name, shift))
    stored = P.read_profiles(spark, path)
    whole = {r["column"]: r for r in P.estimates(P.merged(stored)).collect()}
    assert whole["x"]["rows"] == 16000 and whole["x"]["nulls"] == 1600
    assert abs(whole["y"]["distinct"] - 700) <= 28 and abs(whole["y"]["median"] - 333) <= 14
    moved = {(r["batch"], r["column"]): r["drift"] for r in P.drift(stored).collect()}
    assert moved["a", "x"] is None and moved["b", "x"] < 0.06 and moved["c", "x"] < 0.06
    assert moved["d", "x"] > 0.3 and moved["d", "y"] < 0.06


def test_empty_and_valueless_batches(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("b", 2.0)], "day string, x double")
    got = P.batch_profiles(df, "day", ["x"])
    assert P.batch_profiles(df.limit(0), "day", ["x"]).collect() == []
    (row,) = P.estimates(P.merged(got)).collect()
    assert (row["rows"], row["nulls"], row["distinct"], row["median"]) == (3, 2, 1, 2.0)
    assert [r["drift"] for r in P.drift(got).collect()] == [None, None]
    (none,) = P.estimates(P.merged(got.filter("batch = 'a'"))).collect()
    assert none["median"] is None


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    rows = [(f"{i % 50:010}", i, i % 7, float(i)) for i in range(500)]
    a = spark.createDataFrame(rows, "gameId string, personId long, teamId long, points double")
    b = a.selectExpr("gameId", "personId", "teamId", "points * 2 AS possessions")
    a, b = (write_bucketed(x, str(tmp_path / n), BOX_KEYS, 4) for x, n in ((a, "a"), (b, "b")))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = with_advanced(a, b)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert sorted(r["possessions"] for r in joined.collect()) == [2.0 * r[3] for r in rows]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
