"""Join helpers: size-checked broadcast and the "new columns only" projection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side must fit in this many bytes and rows; both are measured before the hint.
BROADCAST_BYTES = 256 * 1024 * 1024
BROADCAST_ROWS = 2_000_000


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a table by one aggregate with map-side partial sums: the text form's
    length of every value plus 16 bytes a value and a row."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16
                 for c in df.columns), F.lit(16))
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width.cast("long")), F.lit(0))
                 .alias("b")).first()
    return row.n, row.b


def bounded_broadcast(df: DataFrame, derived: bool = False) -> DataFrame:
    """``broadcast(df)`` when its measured rows and bytes fit the bounds, else ``df`` unchanged.

    A ``derived`` side (a distinct, an aggregate, a join result) is checkpointed first, so the
    measurement and the join both read the small checkpoint instead of computing it twice from
    its large sources. Beyond the bounds the join stays a shuffle join, whose skewed partitions
    AQE splits; the result is the same."""
    if derived:
        from boxstats.session import materialize
        df = materialize(df)
    return F.broadcast(df) if fits_broadcast(df) else df


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the measured rows and bytes are within the bounds."""
    rows, size = measured_size(df)
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def new_columns_only(right: DataFrame, left: DataFrame | Iterable[str],
                     keys: Iterable[str]) -> DataFrame:
    """From ``right`` keep the join keys and the columns ``left`` does not have (order kept)."""
    left_cols = set(left.columns if isinstance(left, DataFrame) else left)
    keys = list(keys)
    keep = [c for c in right.columns if c in keys or c not in left_cols]
    return right.select(*keep)
