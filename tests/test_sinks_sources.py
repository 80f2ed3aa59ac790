"""Replace-by-key (K3) properties, partition-scoped commit, audit, empty batch (K5),
schema-fixed CSV reads (S7), missing tables (S9), payload quarantine (D2), quality report."""

import datetime as dt
import os
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import fixtures as FX
from boxstats.operators.quality import quality_report
from boxstats.sinks import writers as K
from boxstats.sources import readers as RD
from boxstats.sources import schemas as SC

ROW = st.tuples(st.sampled_from(["g1", "g2", "g3", None]), st.integers(0, 3), st.integers(0, 9))
KEYED_ROW = st.tuples(st.sampled_from(["g1", "g2", "g4"]), st.integers(0, 3), st.integers(0, 9))


def _df(spark, rows):
    return spark.createDataFrame(rows, "gameId string, personId int, v int")


@settings(max_examples=5, deadline=None)
@given(st.lists(ROW, max_size=8), st.lists(KEYED_ROW, max_size=6))
def test_replace_by_key_properties(spark, target_rows, batch_rows):
    target, batch = _df(spark, target_rows), _df(spark, batch_rows)
    once = K.replace_by_key(target, batch, ["gameId"])
    twice = K.replace_by_key(once, batch, ["gameId"])
    key = lambda r: (r.gameId or "", r.personId, r.v)
    assert sorted(once.collect(), key=key) == sorted(twice.collect(), key=key)  # idempotent
    batch_keys = {r[0] for r in batch_rows if r[0] is not None}
    kept = [r for r in target_rows if r[0] is None or r[0] not in batch_keys]
    want = sorted(kept + batch_rows, key=lambda r: (r[0] or "", r[1], r[2]))
    got = sorted([tuple(r) for r in once.collect()], key=lambda r: (r[0] or "", r[1], r[2]))
    assert got == want  # other keys untouched, NULL keys never delete


SCHEMA = "gameId string, personId int, game_date date"


def _stored(spark, root):
    return sorted(((r.gameId, r.personId, str(r.game_date))
                   for r in K.read_stored(spark, root).collect()), key=str)


def _root():
    return tempfile.mkdtemp(prefix="k3-", dir="/tmp") + "/t"


def test_commit_replace(spark):
    root, ts = _root(), dt.datetime(2024, 1, 5)
    rows = [("g1", 1, dt.date(2024, 1, 1)), ("g1", 2, dt.date(2024, 1, 1)),
            ("g2", 1, dt.date(2024, 1, 2)), ("g3", 1, dt.date(2024, 1, 3))]
    m0 = K.commit_replace(spark, spark.createDataFrame(rows, SCHEMA), root, ["gameId"],
                          "game_date", ts=ts)
    assert m0 == {"deleted": 0, "saved": 4}
    # g1 replaced by one row, g2 moved to another date, g4 new; g3 untouched.
    batch = spark.createDataFrame([("g1", 9, dt.date(2024, 1, 1)), ("g2", 7, dt.date(2024, 1, 4)),
                                   ("g4", 1, dt.date(2024, 1, 4))], SCHEMA)
    before = K.read_stored(spark, root)
    m1 = K.commit_replace(spark, batch, root, ["gameId"], "game_date", ts=ts)
    assert m1 == {"deleted": 3, "saved": 3}
    assert before.count() == 4              # a reader keeps the table it opened
    want = [("g1", 9, "2024-01-01"), ("g2", 7, "2024-01-04"), ("g3", 1, "2024-01-03"),
            ("g4", 1, "2024-01-04")]
    assert _stored(spark, root) == want
    # K5: an empty batch writes nothing.
    assert K.commit_replace(spark, batch.limit(0), root, ["gameId"], "game_date")["saved"] == 0
    # The same batch again replaces itself.
    assert K.commit_replace(spark, batch, root, ["gameId"], "game_date", ts=ts) == {
        "deleted": 3, "saved": 3}
    assert _stored(spark, root) == want
    K.compact(spark, root, "game_date")
    assert _stored(spark, root) == want
    assert K.commit_replace(spark, batch.filter("gameId = 'g4'"), root, ["gameId"],
                            "game_date")["deleted"] == 1
    assert _stored(spark, root) == want


def test_commit_keeps_rows_without_partition_value(spark):
    root = _root()
    for game in ("g1", "g3"):
        K.commit_replace(spark, spark.createDataFrame([(game, 1, None)], SCHEMA), root,
                         ["gameId"], "game_date")
    assert [r[0] for r in _stored(spark, root)] == ["g1", "g3"]
    moved = spark.createDataFrame([("g1", 1, dt.date(2024, 1, 1))], SCHEMA)
    assert K.commit_replace(spark, moved, root, ["gameId"], "game_date")["deleted"] == 1
    assert _stored(spark, root) == [("g1", 1, "2024-01-01"), ("g3", 1, "None")]


def test_commit_keeps_partition_texts_and_types(spark):
    root, schema = _root(), "gameId string, season string"
    for value in ("01", "x:y", "a=b/c"):
        K.commit_replace(spark, spark.createDataFrame([("g1", value), (value, value)], schema),
                         root, ["gameId"], "season", audit=False)
    got = K.read_stored(spark, root)
    assert dict(got.dtypes)["season"] == "string"
    assert sorted(tuple(r) for r in got.collect()) == [
        ("01", "01"), ("a=b/c", "a=b/c"), ("g1", "a=b/c"), ("x:y", "x:y")]


def test_commit_adds_columns_and_refuses_types(spark):
    root = _root()
    K.commit_replace(spark, spark.createDataFrame([("g1", 1)], "gameId string, a int"), root,
                     ["gameId"], "a", audit=False)
    K.commit_replace(spark, spark.createDataFrame([("g2", 2, "n")],
                                                  "gameId string, a int, note string"),
                     root, ["gameId"], "a", audit=False)
    assert sorted(map(tuple, K.read_stored(spark, root).collect())) == [
        ("g1", 1, None), ("g2", 2, "n")]
    with pytest.raises(ValueError):
        K.commit_replace(spark, spark.createDataFrame([("g3", "x")], "gameId string, a string"),
                         root, ["gameId"], "a", audit=False)
    assert K.read_stored(spark, root).count() == 2


def test_commit_adds_rows_without_key_and_unfinished_commits_are_invisible(spark):
    root = _root()
    batch = spark.createDataFrame([(None, 1, None), ("g1", 2, None)], SCHEMA)
    K.commit_replace(spark, batch, root, ["gameId"], "game_date", audit=False)
    # A commit that failed before its manifest line.
    batch.write.parquet(f"{root}/data/commit=2")
    assert K.read_stored(spark, root).count() == 2
    K.commit_replace(spark, batch, root, ["gameId"], "game_date", audit=False)
    assert _stored(spark, root) == [("g1", 2, "None"), (None, 1, "None"), (None, 1, "None")]


def test_audit_column(spark):
    stamped = K.with_audit(spark.createDataFrame([("g1", 5)], "gameId string, p int"),
                           dt.datetime(2024, 1, 1))
    assert dict(stamped.dtypes)[SC.AUDIT_COLUMN] == "timestamp"


def test_csv_keeps_ids_as_text_and_missing_table_is_empty(spark):
    base = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    sched = FX.tables(spark).schedule.limit(5)
    K.write_csv(sched, f"{base}/schedule")
    back = RD.read_schedule(spark, f"{base}/schedule", fmt="csv")
    assert dict(back.dtypes)["gameId"] == "string"
    assert {r.gameId for r in back.collect()} == {r.gameId for r in sched.collect()}
    empty = RD.load_or_empty(spark, f"{base}/nothing", SC.BOX_BASIC)
    assert empty.isEmpty() and empty.schema == SC.BOX_BASIC


def test_players_upper_case_csv(spark):
    base = tempfile.mkdtemp(prefix="players-", dir="/tmp")
    players = FX.tables(spark).players
    K.write_csv(players.toDF(*[c.upper() for c in players.columns]), f"{base}/p")
    back = RD.read_players(spark, f"{base}/p", upper_case=True)
    assert back.columns == [f.name for f in SC.PLAYERS.fields]
    assert back.count() == players.count()


def test_payload_quarantine(spark):
    base = tempfile.mkdtemp(prefix="payloads-", dir="/tmp")
    FX.land_payloads(base, [1, 2])
    good, bad = RD.split_payloads(RD.read_payloads(spark, base, SC.BASIC_PAYLOAD))
    assert good.select("gameId").distinct().count() == 2
    assert bad.count() == 1 and SC.CORRUPT_COLUMN in bad.columns


def test_one_broken_line_quarantines_its_file_until_repaired(spark):
    base = tempfile.mkdtemp(prefix="payloads-", dir="/tmp")
    FX.land_payloads(base, [1], bad=False)
    name = [os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs if f.endswith("json")][0]
    whole = open(name).read()
    open(name, "w").write(whole.rstrip("\n") + '\n{"gameId": "00\n')
    good, bad = RD.split_payloads(RD.read_payloads(spark, base, SC.BASIC_PAYLOAD))
    assert good.isEmpty() and bad.count() > 1
    open(name, "w").write(whole)
    good, bad = RD.split_payloads(RD.read_payloads(spark, base, SC.BASIC_PAYLOAD))
    assert not good.isEmpty() and bad.isEmpty()


def test_empty_text_is_missing_in_every_format(spark):
    base = tempfile.mkdtemp(prefix="empty-", dir="/tmp")
    df = spark.createDataFrame([(1, ""), (2, "x")], "k long, minutes string")
    df.write.parquet(f"{base}/p")
    K.write_csv(df, f"{base}/c")
    K.commit_replace(spark, df, f"{base}/m", ["k"], "k", audit=False)
    for path, fmt in (("p", "parquet"), ("c", "csv"), ("m", "commits")):
        back = RD.load_table(spark, f"{base}/{path}", df.schema, fmt)
        assert {r.k: r.minutes for r in back.collect()} == {1: None, 2: "x"}, fmt


def test_quality_report(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 1, "x"), (2, None, "y"), (3, 1, "z")],
                               "k long, j long, s string")
    other = spark.createDataFrame([(1,), (2,)], "k2 long")
    rep = {(r.check, r.column): r.value
           for r in quality_report(df, ["k", "j"], [("other", other, "k", "k2")],
                                   checks={"k_is_j": F.col("k") == F.col("j")}).collect()}
    assert rep[("violations", "k_is_j")] == 2
    assert rep[("rows", "")] == 4
    assert rep[("nulls", "s")] == 1 and rep[("nulls", "j")] == 1
    assert rep[("duplicate_keys", "")] == 1
    assert rep[("orphans", "other")] == 1


def test_catalog_table_roundtrip(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "person_id long, player_slug string")
    K.write_truncate(df, "boxstats_test_players", fmt="table")
    back = RD.load_table(spark, "boxstats_test_players", fmt="table")
    assert sorted(r.person_id for r in back.collect()) == [1, 2]
    K.write_truncate(df.limit(1), "boxstats_test_players", fmt="table")
    assert RD.load_table(spark, "boxstats_test_players", fmt="table").count() == 1


def test_payload_rows_are_not_shuffled_by_file(spark, tmp_path):
    for name, lines in (("a", ['{"gameId": "0022400001", "personId": 1}', '{"gameId": "00']),
                        ("b", ['{"gameId": "0022400002", "personId": 2}'])):
        (tmp_path / f"{name}.json").write_text("\n".join(lines))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        good, bad = RD.split_payloads(RD.read_payloads(spark, str(tmp_path), SC.BASIC_PAYLOAD))
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (good, bad)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in plans)
    assert [r.personId for r in good.collect()] == [2] and bad.count() == 2
