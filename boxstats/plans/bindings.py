"""Bindings of the driver's tables to the box-score contracts (blueprint B1-B3).

Every operator is parameterised by column names; a binding is only the projection that gives
the driver's columns box-score meaning. All of them are lazy scans with derived columns, so
filters and column pruning still reach the parquet reader.

B1 ``events`` as a box score: player ``user_id``, game ``event_id``, date ``ts``, position
``event_type``, team ``user_id`` by fifteens, opponent ``event_id % 30``, points ``value``, minutes
``props.k``, possessions ``event_id % 7``.
B2 star schema as a box score: game ``o_orderkey``, date ``o_orderdate``, player ``o_custkey``,
team ``c_nationkey``, position ``c_mktsegment``, opponent ``s_nationkey``, points = revenue per
order and supplier nation.
B3 ``orders`` as a schedule: home team ``o_custkey`` by fifteens, away the seventh team after it,
status ``o_orderstatus`` (``F`` = finished); roster = ``customer`` by fifteens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstats.functions.scalars import parse_minutes
from boxstats.sources.tables import table

B1_OPPONENTS = 30
B1_POSSESSION_MOD = 7
# Players of a team: teams grow with the data, so player-games grow in proportion to it.
TEAM_SIZE = 15
B3_AWAY_OFFSET = 7


def team_of(player: str) -> Column:
    """The team of a player id: ``TEAM_SIZE`` consecutive ids."""
    return F.floor(F.col(player) / TEAM_SIZE).cast("long")


def events_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "user_id", "event_id", "ts", "value",
        F.col("event_type").alias("position"),
        team_of("user_id").alias("team"),
        (F.col("event_id") % B1_OPPONENTS).alias("opponent"),
        parse_minutes(F.get_json_object("props", "$.k")).alias("minutes"),
        (F.col("event_id") % B1_POSSESSION_MOD).cast("double").alias("possessions"),
    )


def order_supplier_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: one row per (order, supplier nation) with its revenue as points.

    Line rows take their supplier's nation, then one aggregate on (order, nation), combined
    map-side, meets the orders on the order key."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    per_nation = (li.join(sup, li.l_suppkey == sup.s_suppkey)
                  .groupBy("l_orderkey", "s_nationkey")
                  .agg(F.sum("l_extendedprice").alias("points")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (per_nation.join(orders, per_nation.l_orderkey == orders.o_orderkey)
            .join(cust, orders.o_custkey == cust.c_custkey)
            .select(
                F.col("o_orderkey").alias("game"),
                F.col("o_orderdate").alias("game_date"),
                F.col("o_custkey").alias("player"),
                F.col("c_nationkey").alias("team"),
                F.col("c_mktsegment").alias("position_group"),
                F.col("s_nationkey").alias("opponent"),
                "points"))


def orders_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as games with a home and an away team."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("game_id"),
        F.col("o_orderdate").alias("game_date"),
        team_of("o_custkey").alias("home_team_id"),
        (team_of("o_custkey") + B3_AWAY_OFFSET).alias("away_team_id"),
        F.col("o_orderstatus").alias("game_status"),
        "o_totalprice",
    )


def customer_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 roster: customers as players of their team."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("person_id"),
        F.col("c_name").alias("player_slug"),
        team_of("c_custkey").alias("team_id"),
        F.col("c_mktsegment").alias("position"),
    )


def clock_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock strings in every form the minutes parser meets, derived from each line item:
    ``MM:SS``, ``H:MM:SS``, plain numbers, ISO durations, partial junk, too many parts, empty
    and NULL (chosen by ``l_linenumber``, values from ``l_quantity``)."""
    li = table(spark, sf_dir, "lineitem")
    q = F.floor("l_quantity").cast("long").cast("string")
    ln = F.col("l_linenumber")
    sec = F.lpad(((ln * 8) % 60).cast("string"), 2, "0")
    clock = (F.when(ln == 1, F.concat(q, F.lit(":"), sec))
             .when(ln == 2, F.concat(F.lit("1:"), F.lpad(q, 2, "0"), F.lit(":30")))
             .when(ln == 3, F.col("l_quantity").cast("string"))
             .when(ln == 4, F.concat(F.lit("PT"), q, F.lit("M")))
             .when(ln == 5, F.concat(q, F.lit(":x")))
             .when(ln == 6, F.concat(q, F.lit(":2:3:4")))
             .when((ln == 7) & (F.col("l_quantity") > 25), F.lit(None).cast("string"))
             .otherwise(F.lit("")))
    return li.select("l_orderkey", "l_linenumber", clock.alias("clock"))


def game_id_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game ids of every kind, derived from each order: 10-char regular season (``002``),
    playoffs (``004``), the 8-digit integer form, preseason (``001``) and junk, chosen by
    ``o_orderpriority``; the season digits come from the order year."""
    o = table(spark, sf_dir, "orders")
    yy = F.lpad((F.year("o_orderdate") % 100).cast("string"), 2, "0")
    serial = F.lpad((F.col("o_orderkey") % 100000).cast("string"), 5, "0")
    pr = F.col("o_orderpriority")
    raw = (F.when(pr == "1-URGENT", F.concat(F.lit("002"), yy, serial))
           .when(pr == "2-HIGH", F.concat(F.lit("004"), yy, serial))
           .when(pr == "3-MEDIUM", F.concat(F.lit("2"), yy, serial))
           .when(pr == "4-NOT SPECIFIED", F.concat(F.lit("001"), yy, serial))
           .otherwise(F.concat(F.lit("g"), F.col("o_orderkey").cast("string"))))
    return o.select("o_orderkey", raw.alias("raw_id"), "o_orderdate", "o_orderstatus",
                    "o_orderpriority", "o_custkey")


# Roster and box-score positions assigned to parts (fixed list: the known roster positions
# plus one unknown value; the box score adds a missing value and the literal BENCH).
ROSTER_POSITIONS = ["G", "G-F", "F", "F-G", "F-C", "C", "C-F", "X"]
BOX_POSITIONS = [None, "G", "F", "C", "BENCH"]


def part_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part as a player: roster position from ``p_size``, box position from
    ``p_partkey``."""
    p = table(spark, sf_dir, "part")
    roster = F.element_at(F.array(*[F.lit(x) for x in ROSTER_POSITIONS]),
                          (F.col("p_size") % len(ROSTER_POSITIONS) + 1).cast("int"))
    box = F.element_at(F.array(*[F.lit(x).cast("string") for x in BOX_POSITIONS]),
                       (F.col("p_partkey") % len(BOX_POSITIONS) + 1).cast("int"))
    return p.select("p_partkey", box.alias("position"), roster.alias("position_player"))
