"""Feature state that a daily batch maintains instead of scanning the history.

Two stored tables next to the box scores:

- **recent**: each player's last rows (as many as the longest rolling window), a mergeable top-k:
  the last rows of (state + batch) are those of (history + batch). A run rewrites the players whose
  games are in the batch and no others.
- **daily**: sum and count of points per (group, opponent, date), from partial sums per game. A
  replaced game takes its old partial sums with it; the days that it was or is on are summed anew
  from the games' partials, which are exact decimals.

Both are brought up to date before the box scores are committed, from the batch and from what is
stored, by replace-by-key commits; a run that is repeated after a failure does the same again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxstats.operators.joins import bounded_broadcast
from boxstats.operators.opponent import AVG_PREFIX, mean_of_last
from boxstats.operators.windows import recent_rows
from boxstats.session import written
from boxstats.sinks.writers import commit_replace, read_stored

RANK = "__recent"


def place(order: Sequence[str]) -> Column:
    """The order of rows as one comparable value, NULLs last."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"{c}__null"),
                                                 F.col(c).alias(c))])


def merge_recent(state: DataFrame, batch: DataFrame, history: DataFrame, player: str,
                 game: str, order: Sequence[str], depth: int) -> DataFrame:
    """The players that ``batch`` touches with their last ``depth`` rows in (history without the
    batch's games, batch); a touched player without rows is left as one row of rank 0.

    ``state``: the last rows of ``history`` with their rank. Its rows alone decide where a player
    keeps enough of them: rows outside the state lie before all rows in it. A player with a full
    state, of which a replaced game took more rows than the batch brought behind the state's
    first, is read from the history: only those, found by a semi join."""
    games = bounded_broadcast(batch.select(game).filter(F.col(game).isNotNull()).distinct(),
                              derived=True)
    batch = batch.filter(F.col(player).isNotNull())
    touched = written(state.join(games, game, "left_semi").select(player)
                      .unionByName(batch.select(player)).filter(F.col(player).isNotNull())
                      .distinct(), "touched")
    side = bounded_broadcast(touched)
    old = written(state.filter(F.col(RANK) > 0).join(side, player, "left_semi"), "old-rows")
    kept = old.drop(RANK).join(games, game, "left_anti").unionByName(batch)
    floor = old.groupBy(player).agg(F.count("*").alias("__rows"), F.min(place(order))
                                    .alias("__floor"))
    behind = (kept.withColumn("__place", place(order)).join(floor, player)
              .filter((F.col("__rows") >= depth) & (F.col("__place") >= F.col("__floor")))
              .groupBy(player).agg(F.count("*").alias("__behind")))
    short = (floor.filter(F.col("__rows") >= depth).join(behind, player, "left")
             .filter(F.coalesce("__behind", F.lit(0)) < depth).select(player))
    short = written(short, "short")
    rows = kept
    if not short.isEmpty():
        again = bounded_broadcast(short)
        rows = (kept.join(again, player, "left_anti").unionByName(
            history.join(again, player, "left_semi").join(games, game, "left_anti")
            .select(*batch.columns))
            .unionByName(batch.join(again, player, "left_semi")))
    last = written(recent_rows(rows, player, order, depth, RANK), "last-rows")
    gone = touched.join(last.select(player).distinct(), player, "left_anti")
    return last.unionByName(gone.withColumn(RANK, F.lit(0)), allowMissingColumns=True)


def update_recent(spark: SparkSession, path: str, batch: DataFrame, history: DataFrame,
                  player: str, game: str, order: Sequence[str], depth: int) -> dict[str, int]:
    """Bring the recent table at ``path`` up to date with ``batch``. ``history`` (all stored rows
    before the batch, lazily) is read for single players only, see ``merge_recent``."""
    schema = batch.withColumn(RANK, F.lit(0)).schema
    state = read_stored(spark, path, schema).select(*schema.fieldNames())
    merged = merge_recent(state, batch, history, player, game, order, depth)
    return commit_replace(spark, merged, path, [player], player, audit=False)


def read_recent(spark: SparkSession, path: str) -> DataFrame:
    """The recent rows with their rank, for ``rolling_over_recent``."""
    return read_stored(spark, path).filter(F.col(RANK) > 0)


def game_partials(rows: DataFrame, game: str, keys: Sequence[str], date: str,
                  value: str) -> DataFrame:
    """A1 per game: exact sum and count of the values; rows with a NULL key or date are left
    out."""
    known = rows.filter(" AND ".join(f"{c} IS NOT NULL" for c in (game, *keys, date)))
    exact = F.col(value).cast("decimal(28,8)")
    return known.groupBy(game, *keys, date).agg(
        F.sum(exact).alias("total"), F.count(value).alias("values"), F.count("*").alias("rows"))


def update_daily(spark: SparkSession, path: str, batch: DataFrame, game: str,
                 keys: Sequence[str], date: str, value: str) -> dict[str, int]:
    """Bring the partial sums at ``path`` up to date with ``batch``, which replaces its games.

    The days are committed before the games' partials: they are computed from the partials of the
    games that stay and those of the batch, so a repeated run finds the same."""
    pair = [*keys, date]
    fresh = written(game_partials(batch, game, keys, date, value), "partials")
    stored = read_stored(spark, f"{path}/games", fresh.schema).select(*fresh.columns)
    games = bounded_broadcast(batch.select(game).filter(F.col(game).isNotNull()).distinct(),
                              derived=True)
    # What a replaced game leaves behind is touched too, even if nothing is put in its place.
    touched = written(fresh.select(*pair).unionByName(
        stored.join(games, game, "left_semi").select(*pair)).distinct(), "days")
    staying = stored.join(games, game, "left_anti").join(bounded_broadcast(touched), pair,
                                                         "left_semi")
    sums = staying.unionByName(fresh).groupBy(*pair).agg(
        *[F.sum(c).alias(c) for c in ("total", "values", "rows")])
    days = touched.join(sums, pair, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    counts = commit_replace(spark, days, f"{path}/days", pair, date, audit=False)
    # A replaced game without partials of its own now must still lose the old ones.
    none = batch.select(game).filter(F.col(game).isNotNull()).distinct().join(
        fresh.select(game).distinct(), game, "left_anti")
    commit_replace(spark, fresh.unionByName(none, allowMissingColumns=True), f"{path}/games",
                   [game], date, audit=False)
    return counts


def maintained_averages(spark: SparkSession, path: str, keys: Sequence[str], date: str,
                        ns: Sequence[int] = (10, 20), prefix: str = AVG_PREFIX) -> DataFrame:
    """A2 + A3 from the maintained days."""
    days = read_stored(spark, f"{path}/days").filter("rows > 0")
    mean = F.try_divide(F.col("total").cast("double"), F.col("values").cast("double"))
    return mean_of_last(days.select(*keys, date, mean.alias("avg_points")), keys, date,
                        "avg_points", ns, prefix)
