"""Data-quality report (D1): row count, NULLs per column, duplicate keys, orphan keys.

One aggregate pass over the table for counts, NULLs and predicate checks (plus one distinct on
the key), one anti join per checked relation. The result is a long table (check, column,
value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality_report(df: DataFrame, keys: Sequence[str],
                   relations: Sequence[tuple[str, DataFrame, str, str]] = (),
                   checks: dict[str, Column] | None = None) -> DataFrame:
    """Checks of ``df``:

    - ``rows``: number of rows;
    - ``nulls`` per column: rows where the column is NULL;
    - ``duplicate_keys``: rows with a complete key minus distinct complete keys;
    - ``orphans`` per relation ``(name, other, key, other_key)``: rows whose non-NULL ``key``
      has no match in ``other``;
    - ``violations`` per named predicate in ``checks``: rows where it is true (e.g. a game
      whose home team is also its away team).
    """
    keys = list(keys)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls:{c}") for c in df.columns]
    aggs.append(F.count_if(complete).alias("__keyed"))
    aggs.append(F.count_distinct(*[F.col(k) for k in keys]).alias("__distinct"))
    aggs += [F.count_if(F.coalesce(pred, F.lit(False))).alias(f"violations:{name}")
             for name, pred in (checks or {}).items()]
    one = df.agg(*aggs).withColumn("duplicate_keys", F.col("__keyed") - F.col("__distinct")) \
        .drop("__keyed", "__distinct")
    value_cols = one.columns
    long = one.unpivot([], [F.col(f"`{c}`").cast("long").alias(c) for c in value_cols],
                       "check_name", "value")
    parts = F.split(F.col("check_name"), ":")
    report = long.select(
        F.get(parts, 0).alias("check"),
        F.coalesce(F.get(parts, 1), F.lit("")).alias("column"),
        F.col("value").cast("long").alias("value"))
    for name, other, key, other_key in relations:
        # One row per key and map task is shuffled, so a hot key costs nothing.
        right = other.select(F.col(other_key).alias("__ok")).filter(F.col("__ok").isNotNull())
        orphans = (df.select(F.col(key).alias("__ok")).filter(F.col("__ok").isNotNull())
                   .groupBy("__ok").agg(F.count(F.lit(1)).alias("__n"))
                   .join(right, "__ok", "left_anti")
                   .agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("value"))
                   .select(F.lit("orphans").alias("check"), F.lit(name).alias("column"), "value"))
        report = report.unionByName(orphans)
    return report
