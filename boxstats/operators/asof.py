"""As-of join: each row with the values of the last row before its own time (J7 over many dates)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxstats.operators.joins import bounded_broadcast
from boxstats.operators.windows import assign_chunks
from boxstats.session import materialize

_SIDE, _CHUNK = "__side", "__chunk"


def as_of_join(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str,
               values: Sequence[str], ties: Sequence[str] = (),
               hot_rows: int | None = None) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` that has the same ``by`` and a time
    before ``left_time`` (strictly), in the order of (``right_time``, ``ties``); NULL where there is
    none. A row of ``left`` without ``by`` finds nothing; without a time it finds the last row that
    has one; rows of ``right`` without a time are found by none.

    Both sides are put into one sequence per ``by`` and read once in order: one exchange, one sort,
    and a running ``last`` that skips the rows of ``left``. A ``by`` with more rows than one task's
    even share is dealt by ranges of the order into chunks; what a chunk leaves behind is carried
    into the following ones, one row a chunk."""
    found = F.struct(*[F.col(v).alias(v) for v in values])
    kind = right.select(found.alias("f")).schema["f"].dataType
    asked = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    asked_kind = left.select(asked.alias("a")).schema["a"].dataType
    order = ["__time", _SIDE, *[f"__tie{i}" for i in range(len(ties))]]
    rows = left.select(
        F.col(by).alias("__by"), F.col(left_time).cast("timestamp").alias("__time"),
        F.lit(0).alias(_SIDE),
        *[F.lit(None).cast(right.schema[t].dataType).alias(f"__tie{i}")
          for i, t in enumerate(ties)],
        asked.alias("__asked"), F.lit(None).cast(kind).alias("__found"))
    rows = rows.unionByName(right.filter(F.col(by).isNotNull() & F.col(right_time).isNotNull())
                            .select(
        F.col(by).alias("__by"), F.col(right_time).cast("timestamp").alias("__time"),
        F.lit(1).alias(_SIDE), *[F.col(t).alias(f"__tie{i}") for i, t in enumerate(ties)],
        F.lit(None).cast(asked_kind).alias("__asked"), found.alias("__found")))
    known = rows.filter(F.col("__by").isNotNull())
    counts = materialize(known.groupBy("__by").agg(F.count(F.lit(1)).alias("__n")))
    if hot_rows is None:
        tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
        hot_rows = max(1, -(-total // max(tasks, 1)))
    hot = counts.filter(F.col("__n") > hot_rows)
    if hot.isEmpty():
        seen = _running(known.withColumn(_CHUNK, F.lit(0).cast("long")), order)
    else:
        cold, chunked = assign_chunks(known, "__by", order, hot_rows, hot)
        both = cold.unionByName(chunked.select(*cold.columns))
        seen = _running(both, order).join(_carried(chunked, order), ["__by", _CHUNK], "left")
        seen = seen.withColumn("__found", F.coalesce("__found", "__carried"))
    out = seen.filter(F.col(_SIDE) == 0).select("__asked", "__found")
    out = out.unionByName(rows.filter(F.col("__by").isNull()).select("__asked", "__found"))
    return out.select("__asked.*", *[F.col(f"__found.{v}").alias(v) for v in values])


def _ordered(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _running(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    window = (Window.partitionBy("__by", _CHUNK).orderBy(*_ordered(order))
              .rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("__found", F.last("__found", ignorenulls=True).over(window))


def _carried(chunked: DataFrame, order: Sequence[str]) -> DataFrame:
    """For each chunk of a hot ``by`` the last found row of the chunks before it."""
    place = F.struct(*[F.col(c) for c in order])
    ends = chunked.groupBy("__by", _CHUNK).agg(
        F.max_by("__found", F.when(F.col(_SIDE) == 1, place)).alias("__end"))
    before = (Window.partitionBy("__by").orderBy(_CHUNK)
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.withColumn("__carried", F.last("__end", ignorenulls=True).over(before))
    return bounded_broadcast(carried.drop("__end"), derived=True)
