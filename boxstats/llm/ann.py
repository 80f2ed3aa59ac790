"""Operator 8: approximate nearest neighbours by inner product, with an adaptive dimension scan.

Vectors are dealt into lists by their nearest centroid. Inside a probed list the rotated vectors
lie in column blocks; after each block a hypothesis test compares the distance over the columns
seen so far, scaled to all of them, with the distance of the query's current k-th neighbour, and
abandons candidates that are too far. Reported scores are computed on the original vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxstats.llm.common import drawn, saved

SLACK = 2.1           # of the test: wider keeps more candidates; 2.1 loses about one in a thousand
CANDIDATES = "query_id long, vec_id long, score double"


def usable(vector: Column, size: int) -> Column:
    """Not null, of this length, finite throughout, not zero."""
    return F.coalesce((F.size(vector) == size) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def rotation(size: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(8).standard_normal((size, size)))[0]


def centroids(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of the directions of a sample, by spherical k-means."""
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    lists = min(lists, len(x))
    centers = x[np.random.default_rng(20).choice(len(x), lists, replace=False)].copy()
    for _ in range(rounds):
        nearest = (x @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centers)
    return centers


def scan(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
         bounds: np.ndarray, k: int, turn: np.ndarray, width: int = 16):
    """(query id, vec ids, scores) of each query's best k in one block of a list. ``bounds``: what
    a score must reach for each query; -inf where nothing is known yet."""
    size = vectors.shape[1]
    turned, asked = vectors @ turn, queries @ turn
    ends = [*range(width, size, width), size]
    blocks = [np.ascontiguousarray(turned[:, a:b]) for a, b in zip([0, *ends], ends)]
    upto = np.cumsum([np.einsum("ij,ij->i", b, b) for b in blocks], axis=0)
    for q, query, query_id, bound in zip(asked, queries, query_ids, bounds):
        own = np.cumsum([q[a:b] @ q[a:b] for a, b in zip([0, *ends], ends)])
        alive, partial, first = None, blocks[0] @ q[:ends[0]], np.isfinite(bound)
        far = own[-1] + upto[-1] - 2 * bound if first else None
        for number, end in enumerate(ends):
            if number:
                rows = blocks[number] if alive is None else blocks[number][alive]
                partial = partial + rows @ q[ends[number - 1]:end]
            if first and end < size:
                seen = upto[number] if alive is None else upto[number][alive]
                limit = far if alive is None else far[alive]
                near = ((own[number] + seen - 2 * partial) * (size / end)
                        <= (1 + SLACK / end ** 0.5) ** 2 * limit + 1e-9)
                alive = np.flatnonzero(near) if alive is None else alive[near]
                partial = partial[near]
                if not len(alive):
                    break
        if alive is None:
            alive = np.arange(len(ids))
        keep = (partial >= bound - 1e-9) & (ids[alive] != query_id)
        alive, partial = alive[keep], partial[keep]
        if len(alive) > k:
            keep = partial >= np.partition(partial, len(partial) - k)[-k] - 1e-9
            alive = alive[keep]
        # One fixed order of additions for every row, so equal vectors get equal scores.
        score = (vectors[alive] * query).sum(axis=1)
        best = np.lexsort((ids[alive], -score))[:k]
        yield query_id, ids[alive][best], score[best]


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           is_query: Column | None = None, k: int = 20, lists: int = 64, probes: int = 44,
           sample_rows: int = 20_000, block_rows: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k found nearest by inner product, ties to the
    smaller id; a query is no neighbour of itself.

    Vectors that are null, zero, of another length than most, or hold null or non-finite values
    take no part, nor do null ids; rows that share an id count once, by their best score. Centroids
    are fitted on at most about ``sample_rows`` vectors, drawn by a hash of the id (the only vectors
    the driver sees); every vector is indexed. Lists are split into blocks of about ``block_rows``
    vectors and the queries that probe them into groups as large, so a crowded list is many tasks.
    The nearest list is scanned first; its k-th score bounds the scans of the others.
    """
    wanted = F.col(id_col) % 20 == 0 if is_query is None else is_query
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector"),
                          F.coalesce(wanted, F.lit(False)).alias("wanted")) \
        .where("vec_id IS NOT NULL AND vector IS NOT NULL")
    empty = vectors.sparkSession.createDataFrame(
        [], "query_id long, rank int, vec_id long, score double")
    common = (rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
              .where("size > 0").orderBy(F.desc("n"), F.desc("size")).first())
    if common is None:
        return empty
    size, count = common.size, common.n
    rows = rows.where(usable(F.col("vector"), size))
    chosen = rows.where(drawn("vec_id", sample_rows, count))
    sample = [r.vector for r in chosen.select("vector").collect()] or [
        r.vector for r in rows.select("vector").take(lists)]
    if not sample:
        return empty
    centers, turn = centroids(np.array(sample), lists), rotation(size)
    probes = min(probes, len(centers))

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                nearest = (matrix(batch.column(1), size) @ centers.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(nearest.astype(np.int64))],
                    names=["vec_id", "vector", "list"])

    def probe(batches):
        for batch in batches:
            if batch.num_rows:
                order = np.argsort(-(matrix(batch.column(1), size) @ centers.T), axis=1,
                                   kind="stable")[:, :probes]
                at = pa.array(np.repeat(np.arange(batch.num_rows), probes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(order.ravel().astype(np.int64)),
                     pa.array(np.tile(np.arange(probes), batch.num_rows))],
                    names=["query_id", "query", "list", "turn"])

    index = saved(rows.select("vec_id", "vector").mapInArrow(
        assign, "vec_id long, vector array<double>, list long"), "index")
    asked = saved(rows.where("wanted").select("vec_id", "vector").mapInArrow(
        probe, "query_id long, query array<double>, list long, turn long"), "queries")
    # One row per list, however many vectors there are.
    blocks = {r.list: -(-r.n // block_rows) for r in
              index.groupBy("list").agg(F.count("*").alias("n")).collect()}

    def per_list(sizes: dict[int, int]) -> Column:
        pairs = [F.lit(x) for item in sorted(sizes.items()) for x in item]
        return F.coalesce(F.create_map(*pairs)[F.col("list")], F.lit(1)) if pairs else F.lit(1)

    def dealt(column: str, sizes: dict[int, int]) -> Column:
        n = per_list(sizes)
        return (F.xxhash64(column) % n + n) % n

    def neighbours(questions: DataFrame) -> DataFrame:
        groups = {r.list: -(-r.n // block_rows) for r in
                  questions.groupBy("list").agg(F.count("*").alias("n")).collect()}
        left = index.select("list", "vec_id", "vector", dealt("vec_id", blocks).alias("block"),
                            F.explode(F.sequence(F.lit(0), per_list(groups) - 1)).alias("group"))
        right = questions.select("list", "query_id", "query", "bound",
                                 dealt("query_id", groups).alias("group"),
                                 F.explode(F.sequence(F.lit(0), per_list(blocks) - 1))
                                 .alias("block"))
        keys = [F.col("list"), F.col("block").cast("long").alias("block"),
                F.col("group").cast("long").alias("group")]

        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            found = []
            if a.num_rows and b.num_rows:
                found = list(scan(
                    matrix(a["vector"], size), a["vec_id"].to_numpy(), matrix(b["query"], size),
                    b["query_id"].to_numpy(), b["bound"].to_numpy(), k, turn))
            return pa.table({
                "query_id": pa.array([q for q, i, _ in found for _ in i], pa.int64()),
                "vec_id": pa.array([x for _, i, _ in found for x in i.tolist()], pa.int64()),
                "score": pa.array([x for *_, s in found for x in s.tolist()], pa.float64())})

        return (left.select(*keys, "vec_id", "vector").groupBy("list", "block", "group")
                .cogroup(right.select(*keys, "query_id", "query", "bound")
                         .groupBy("list", "block", "group"))
                .applyInArrow(run, CANDIDATES))

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
                .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))

    nothing = F.lit(float("-inf"))
    near = saved(best(neighbours(asked.where("turn = 0").withColumn("bound", nothing))),
                 "nearest")
    bounds = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("reached"))
    others = (asked.where("turn > 0").join(bounds, "query_id", "left")
              .withColumn("bound", F.coalesce("reached", nothing)))
    others = saved(others.select("list", "query_id", "query", "bound"), "questions")
    every = near.select("query_id", "vec_id", "score").unionByName(neighbours(others))
    return best(every).select("query_id", "rank", "vec_id", "score")
