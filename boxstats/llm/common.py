"""Helpers shared by the operators: worker state, shared tables, word hashes."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstats.session import ensure_checkpoint_dir

# The ASCII white space that separates words in the contracts: space and 0x09-0x0D.
SPACE = " \t\n\x0b\x0c\r"
# A side of ids or keys (8 to 16 bytes a row) is broadcast only up to this many rows.
BROADCAST_ROWS = 1_000_000
MULTIPLIER = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64


def worker_state(key, make: Callable):
    """``make()`` once per Python worker. The functions here are pickled by value, so a module
    global would start empty in every task; this table lives as long as the process. It holds one
    entry: the caches of an earlier operator or model make way for those of the next."""
    state = sys.modules.setdefault("_boxstats_llm_state", types.ModuleType("_boxstats_llm_state"))
    table = state.__dict__.setdefault("table", {})
    if key not in table:
        table.clear()
        table[key] = make()
    return table[key]


# The folders that saved() writes inside recorded(), innermost last.
RECORDS: list[list[str]] = []


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: a cut of the
    lineage that survives lost executors and keeps column pruning and statistics."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for record in RECORDS:
        record.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders of all tables that are saved inside the block."""
    record: list[str] = []
    RECORDS.append(record)
    try:
        yield record
    finally:
        RECORDS.pop()


def removed(spark: SparkSession, folders: list[str]) -> None:
    """Delete saved tables whose readers have written their results."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while folders:
        path = jvm.org.apache.hadoop.fs.Path(folders.pop())
        path.getFileSystem(conf).delete(path, True)


def drawn(column: str, rows: int, total: int) -> Column:
    """True for about ``rows`` of ``total`` rows, by a 63-bit hash of the column, so that the share
    may be as small as it likes."""
    if rows >= total:
        return F.lit(True)
    limit = (rows << 63) // total
    return F.xxhash64(column).bitwiseAND(F.lit((1 << 63) - 1)) < F.lit(limit)


def small(side: DataFrame) -> DataFrame:
    """``side`` (a saved table of ids or keys), as a broadcast if its counted rows are few enough;
    beyond that the join shuffles."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def in_order(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt and sorted by ranges of the keys, ties by their place in the scan, so that
    even equal rows, if very many, are spread over tasks. The keys should be short: ranges are
    chosen from a sample of them."""
    keys = [*keys, "scan"]
    return (rows.withColumn("scan", F.monotonically_increasing_id())
            .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("scan"))


def documents_of(docs: DataFrame, id_col: str, text_col: str,
                 carry: tuple[str, ...] | None = None) -> DataFrame:
    """Only the id (long) and the text, so further columns, whatever their names, cannot clash.
    With ``carry``, also a struct ``carried`` of those columns (of a constant for none)."""
    columns = [F.col(id_col).cast("long").alias("doc_id"),
               F.col(text_col).cast("string").alias("text")]
    if carry is not None:
        columns.append(F.struct(*[F.col(c) for c in carry] or [F.lit(0).alias("nothing")])
                       .alias("carried"))
    return docs.select(*columns)


def balanced(sizes: Iterable[int], most: int) -> Iterator[list[int]]:
    """Index groups of about ``most`` in size; a larger item forms its own group."""
    group, total = [], 0
    for i, size in enumerate(sizes):
        if group and total + size > most:
            yield group
            group, total = [], 0
        group.append(i)
        total += size
    if group:
        yield group


def by_bytes(texts: Iterable[str], most: int) -> Iterator[list[int]]:
    """Index groups of about ``most`` characters; a longer text forms its own group."""
    return balanced(map(len, texts), most)


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of characters other than ASCII white space, as UTF-8."""
    return text.encode().split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    import xxhash
    digest = xxhash.xxh3_64_intdigest
    if seed:
        return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))
    return np.fromiter(map(digest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive word hashes: a polynomial modulo 2**64,
    evaluated for all windows at once from its prefix sums."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power = np.full(len(words) + 1, MULTIPLIER, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        sums = np.zeros(len(words) + 1, np.uint64)
        # falling powers, so that a window's value is (later sum - earlier sum * r**size)
        np.cumsum(words * _inverse_powers(len(words)), out=sums[1:])
        return mixed((sums[size:] - sums[:n]) * power[size - 1:size - 1 + n])


def _inverse_powers(n: int) -> np.ndarray:
    inverse = np.full(n, pow(MULTIPLIER, -1, 1 << 64), np.uint64)
    if n:
        inverse[0] = 1
    return np.multiply.accumulate(inverse)
