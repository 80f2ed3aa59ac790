"""Operator 11: a Merkle manifest of a dataset by slot pivots.

The leaves of each group form a tree, and the groups' roots form one more. A step of the tree takes
blocks of ``fanout ** levels`` consecutive nodes: one exchange brings a block together, and on
every level conditional aggregates spread the children of each parent into ``fanout`` columns.
Their concatenation hashes the parent; without the own slot's column it is a child's siblings.

Going up, the aggregates are grouped by the parent (one row a parent is left); going down, they run
over a window of the parent (every child stays and takes its siblings). Both keep the exchange by
block and the one sort: the digits of a position, from the highest, make each level's keys a prefix
of those of the level below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxstats.llm.common import in_order, saved, small

PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    """Digest of a row: SHA-256 of its fields, one after the other, in lowercase hex."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, p: F.sha2(
        F.concat(p["left"], node, p["right"]), 256))


def numbered(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``rows`` with idx, the position in its group ``g`` by ``order``, and n, the group's rows.

    A distributed sort: rows are dealt by ranges of (g, order, place in the scan), so neither a hot
    group nor a value that very many rows repeat stays in one task. Only the first position and the
    number of rows of each (partition, group) are looked at together."""
    # Written once, so the places hold for every later read.
    placed = saved(in_order(rows, "g", *order)
                   .withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33).alias("part")
    runs = (placed.select("g", part, "at").groupBy("g", "part")
            .agg(F.min("at").alias("first"), F.count("*").alias("rows")))
    group = Window.partitionBy("g")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = saved(runs.select(
        "g", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first"))
        .alias("shift"), F.sum("rows").over(group).alias("n")), "runs")
    return (placed.withColumn("part", part).join(small(runs), ["g", "part"])
            .withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


def in_blocks(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Nodes with their block and the digits s0, s1, ... of their position in it, brought together
    by block."""
    digits = {f"s{k}": F.expr(f"idx div {fanout ** k} % {fanout}").cast("int")
              for k in range(levels)}
    return (nodes.withColumns({"block": F.expr(f"idx div {fanout ** levels}"), **digits})
            .repartition("g", "block"))


def parents(level: int, levels: int) -> list[str]:
    """The keys of a parent, of which each level's are a prefix of the level below."""
    return ["g", "block", *[f"s{k}" for k in range(levels - 1, level, -1)]]


def slots(level: int, fanout: int) -> list[Column]:
    """The conditional aggregates: one column for each child of a parent."""
    return [F.max(F.when(F.col(f"s{level}") == s, F.col("node"))) for s in range(fanout)]


def joined(columns: list[Column]) -> Column:
    return F.concat(*[F.coalesce(c, F.lit("")) for c in columns])


def parent_node(level: int, fanout: int) -> Column:
    """A level exists in the trees of more nodes than it has places below one node."""
    kids = [F.col(f"c{s}") for s in range(fanout)]
    return F.when(F.col("n") > fanout ** level, F.sha2(joined(kids), 256)).otherwise(kids[0])


def block_roots(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row per block: the nodes of the next step."""
    rows = in_blocks(nodes.select("g", "idx", "n", "node"), fanout, levels)
    for level in range(levels):
        kids = [c.alias(f"c{s}") for s, c in enumerate(slots(level, fanout))]
        keys = parents(level, levels)
        rows = (rows.groupBy(*keys).agg(F.max("n").alias("n"), *kids)
                .select(*keys, "n", parent_node(level, fanout).alias("node")))
    left = F.expr(f"(n - 1) div {fanout ** levels} + 1")
    return rows.select("g", F.col("block").alias("idx"), left.alias("n"), "node")


def with_paths(nodes: DataFrame, above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` with the columns of their block in ``above`` and path: the siblings on the levels
    of the step, then the path above. The narrow rows meet the few of ``above`` before their paths
    grow, so no path is ever shuffled."""
    columns = [c for c in nodes.columns if c not in ("idx", "n", "node")]
    upper = above.withColumnRenamed("idx", "block").withColumnRenamed("path", "upper")
    rows = in_blocks(nodes.withColumn("own", F.col("node")), fanout, levels).join(
        upper, ["g", "block"])
    steps = []
    for level in range(levels):
        window = Window.partitionBy(*parents(level, levels))
        rows = rows.withColumns({f"c{s}": c.over(window)
                                 for s, c in enumerate(slots(level, fanout))})
        slot = F.col(f"s{level}")
        left = joined([F.when(slot > s, F.col(f"c{s}")) for s in range(fanout)])
        right = joined([F.when(slot < s, F.col(f"c{s}")) for s in range(fanout)])
        steps.append(f"step{level}")
        rows = rows.withColumns({
            steps[-1]: F.when(F.col("n") > fanout ** level,
                              F.struct(left.alias("left"), right.alias("right"))),
            "node": parent_node(level, fanout)}).drop(*[f"c{s}" for s in range(fanout)])
    own = F.array_compact(F.array(*steps)).cast(PATH)
    more = [c for c in upper.columns if c not in ("g", "block", "upper")]
    return rows.select(*columns, "idx", F.col("own").alias("node"), *more,
                       F.concat(own, "upper").alias("path"))


def trees(nodes: DataFrame, fanout: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """(the nodes of every step, one row (g, root) for each group)."""
    steps = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        steps.append(saved(block_roots(steps[-1], fanout, levels), "nodes"))
        most = (most - 1) // fanout ** levels + 1
    return steps, steps[-1].select("g", F.col("node").alias("root"))


def descend(steps: list[DataFrame], above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Nodes of the first step with their paths; ``above``: g, idx, path and what else is known of
    each group's root."""
    for step in reversed(steps[1:-1]):
        above = saved(with_paths(step, above, fanout, levels).drop("node"), "paths")
    return with_paths(steps[0], above, fanout, levels)


def manifest(docs: DataFrame, columns: tuple[str, ...], group_col: str | None = "lang",
             order_col: str = "doc_id", fanout: int = 2, levels: int = 10,
             carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: ``id`` (the order column as long), ``group``, ``idx`` (its place in the group),
    ``leaf``, ``subroot``, ``root``, ``path`` (for each level from the leaf's up to the root,
    through the subroot, the siblings left and right of it) and ``carried`` (a struct of ``carry``).

    A leaf is the digest of the named ``columns``. In each group leaves ascend by the order column;
    while a tree has more than one node, every ``fanout`` consecutive nodes (the last run: fewer,
    even one) become the digest of their concatenation. The subroots, ordered by group (null first,
    bytewise), form a tree likewise. A single leaf is its own subroot, a single subroot the root,
    and the path of both is shorter by that tree.

    Nulls hash as ``-``; a null group is one of its own; a null order value comes first; rows with
    the same order value ascend by their leaf, so equal rows are interchangeable. Texts are read
    once and hashed where they lie; only digests, ids and carried values are shuffled. No rows give
    no rows. A block has ``fanout ** levels`` rows, so no group, however large, is in one task.
    """
    if fanout < 2 or levels < 1:
        raise ValueError("fanout must be at least 2, levels at least 1")
    group = (F.col(group_col) if group_col else F.lit(None)).cast("string")
    rows = docs.select(
        F.col(order_col).cast("long").alias("id"),
        # Null first: the empty text; values keep their bytewise order behind one character.
        F.coalesce(F.concat(F.lit("+"), group), F.lit("")).alias("g"),
        leaf_of(*[F.col(c) for c in columns]).alias("node"),
        F.struct(*[F.col(c) for c in carry] or [F.lit(0).alias("nothing")]).alias("carried"))
    steps, subroots = trees(numbered(rows, ("id", "node")), fanout, levels)
    subroots = saved(subroots, "subroots")
    # The tree of the subroots: one group, ordered by the groups.
    tops = numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("of"),
                                    F.col("root").alias("node")), ("of",))
    top_steps, roots = trees(tops, fanout, levels)
    start = roots.select("g", "root", F.lit(0).cast("long").alias("idx"),
                         F.array().cast(PATH).alias("path"))
    found = descend(top_steps, start, fanout, levels)
    above = saved(found.select(F.col("of").alias("g"), F.col("node").alias("subroot"), "root",
                               F.lit(0).cast("long").alias("idx"), "path"), "subroots")
    return descend(steps, above, fanout, levels).select(
        "id", F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias("group"), "idx",
        F.col("node").alias("leaf"), "subroot", "root", "path", "carried")
