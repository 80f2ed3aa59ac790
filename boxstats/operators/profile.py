"""Data quality over time (D1): a stored profile of every batch, merged and compared without the
rows.

A profile holds, for a batch and a column, the rows, the NULLs, a HyperLogLog sketch of the
distinct values and a KLL sketch of the quantiles: a few kilobytes however large the batch is.
Sketches are mergeable, so any set of batches is profiled by a union of theirs, and a batch that is
replaced brings its own new row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxstats.sinks.writers import commit_replace, read_stored

RANKS = tuple(i / 100 for i in range(1, 100))


def batch_profiles(df: DataFrame, batch: str, columns: Sequence[str], lg_k: int = 14,
                   k: int = 400) -> DataFrame:
    """(batch, column, rows, nulls, distinct, quantiles): one aggregate over ``df``, combined
    map-side. ``columns`` are numeric; the errors of the sketches are about 1.04 / 2^(lg_k / 2) of
    the distinct count and 1 / k of a rank."""
    def one(name: str) -> Column:
        value = F.col(f"`{name}`")
        return F.struct(
            F.lit(name).alias("column"), F.count(F.lit(1)).alias("rows"),
            F.count_if(value.isNull()).alias("nulls"),
            F.hll_sketch_agg(value.cast("string"), lg_k).alias("distinct"),
            F.kll_sketch_agg_double(value.cast("double"), k).alias("quantiles"))

    all_of = df.groupBy(F.col(batch).cast("string").alias("batch")).agg(
        F.array(*[one(c) for c in columns]).alias("profiles"))
    return all_of.select("batch", F.explode("profiles").alias("p")).select("batch", "p.*")


def store_profiles(spark: SparkSession, path: str, profiles: DataFrame) -> dict[str, int]:
    """Commit profiles; a batch that is there already is replaced."""
    return commit_replace(spark, profiles, path, ["batch", "column"], "batch", audit=False)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path)


def merged(profiles: DataFrame) -> DataFrame:
    """One profile per column over all batches: (column, rows, nulls, distinct, quantiles)."""
    return profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"))


def estimates(profile: DataFrame) -> DataFrame:
    """Distinct values and the median as numbers; NULL median where there is no value."""
    some = F.kll_sketch_get_n_double("quantiles") > 0
    return profile.withColumns({
        "distinct": F.hll_sketch_estimate("distinct"),
        "median": F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5)))}) \
        .drop("quantiles")


def drift(profiles: DataFrame) -> DataFrame:
    """(batch, column, drift): the largest distance, over the percentiles of all batches before,
    between their rank and the share of the batch's percentiles up to there (values that are equal
    count half); NULL for a first batch and without values. Batches are ordered by name. Runs over
    one row per batch and column."""
    before = (Window.partitionBy("column").orderBy("batch")
              .rowsBetween(Window.unboundedPreceding, -1))
    both = profiles.withColumn("past", F.kll_merge_agg_double("quantiles").over(before))
    some = (F.kll_sketch_get_n_double("past") > 0) & (F.kll_sketch_get_n_double("quantiles") > 0)
    ranks = F.array(*[F.lit(r) for r in RANKS])
    both = both.filter(some).withColumns({
        c: F.kll_sketch_get_quantile_double(c, ranks) for c in ("past", "quantiles")})

    def share(values: Column, x: Column) -> Column:
        below, upto = (F.size(F.filter(values, keep)) for keep in (lambda v: v < x,
                                                                   lambda v: v <= x))
        return (below + upto) / (2 * len(RANKS))

    apart = F.array_max(F.transform("past", lambda x: F.abs(
        share(F.col("past"), x) - share(F.col("quantiles"), x))))
    found = both.select("batch", "column", apart.alias("drift"))
    return profiles.select("batch", "column").join(found, ["batch", "column"], "left")
