"""Operator 2: near-duplicates by an inverted join over MinHash signature coordinates.

Every distinct shingle set gets a signature of ``coordinates`` minima. A document is posted under
its coordinate-value pairs; two documents with at least ``matches`` equal coordinates share a pair
among the first ``coordinates - matches + 1`` of each (prefix), when both order their pairs the
same way. The order puts pairs with long posting lists last, so the merge skips those lists except
for documents made almost wholly of them. Collisions of candidate pairs are counted on the full
signatures; pairs above the match threshold are confirmed on the full shingle sets.

No list is ever expanded into all its pairs: first every member is paired with the list's smallest
id, and the confirmed links are closed into components; then only members that are still in
different components are paired, once over all their lists, and in long lists, block by block, only
where sketches of the sets (the whole sets of short texts) are similar too. Links are confirmed in
blocks too: a set goes once to each block that compares it, not once to each of its pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstats.llm.common import documents_of, mixed, saved, small, window_hashes, word_hashes
from boxstats.llm.components import connected_components

PLANES = 32                                 # bits of a coordinate's value
LIST_BLOCK = 2048                           # members of a long list on each side of a comparison
# Links are confirmed between two blocks of sets: bytes of a block, and pairs of two.
SET_BYTES = 16 << 20
BLOCK_PAIRS = 250_000
SIGNATURE = ("n", *[f"p{k}" for k in range(PLANES)])


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the windows of ``width`` words (A-Z lower-cased); fewer
    words form one window; no words, no windows."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(window_hashes(hashes, min(width, len(words))))


def multipliers(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    draw = rng.integers(1, 1 << 63, (2, coordinates), dtype=np.uint64)
    return draw[0] | np.uint64(1), draw[1]


def signature(hashes: np.ndarray, multiply: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """32-bit hash of each coordinate's 64-bit minimum, in blocks, so memory does not grow with the
    text. Minima of large sets are small: their own upper bits would agree by chance in many pairs
    of texts, ever more with their number."""
    least = np.full(len(multiply), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 512):
            block = hashes[i:i + 512] * multiply[:, None]
            block += plus[:, None]
            np.minimum(least, block.min(axis=1), out=least)
        return (mixed(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def bit_planes(signature: np.ndarray) -> np.ndarray:
    """Plane k holds bit k of every coordinate, coordinate i at bit i: signatures are compared
    with one exclusive or per plane."""
    whole = np.zeros(64, np.int32)
    whole[:len(signature)] = signature
    bits = np.unpackbits(whole.view(np.uint8).reshape(64, 4), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(
        np.int64).ravel()


def set_hashes(found: list[np.ndarray]) -> tuple[list, list]:
    """Two 64-bit hashes of each whole set."""
    import xxhash
    data = [f.tobytes() for f in found]
    return tuple([np.uint64(xxhash.xxh3_64_intdigest(d, seed)).astype(np.int64) for d in data]
                 for seed in (0, 1))


def signatures(docs: DataFrame, width: int, coordinates: int) -> DataFrame:
    """doc_id, n_shingles, two hashes of the whole set, and the signature (null without words)."""
    multiply, plus = multipliers(coordinates)

    def run(batches):
        for batch in batches:
            found = [shingles(t, width) for t in batch.column(1).to_pylist()]
            keys = [signature(f, multiply, plus) if len(f) else None for f in found]
            planes = [None if k is None else bit_planes(k) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(f) for f in found], pa.int64()),
                 *[pa.array(h, pa.int64()) for h in set_hashes(found)],
                 pa.array(keys, pa.list_(pa.int32())), pa.array(planes, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "h1", "h2", "keys", "planes"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, "
                                "keys array<int>, planes array<long>")


def unequal(planes: int = PLANES) -> Column:
    """Bit i is set where coordinate i of the signatures a and b differs in the first ``planes``
    bits of its value."""
    return reduce(lambda x, y: x.bitwiseOR(y), [
        F.col(f"p{k}_a").bitwiseXOR(F.col(f"p{k}_b")) for k in range(planes)])


def agreeing(coordinates: int, matches: int) -> Column:
    """At least ``matches`` coordinates are equal; four planes rule out most pairs."""
    most = coordinates - matches
    return (F.bit_count(unequal(4)) <= most) & (F.bit_count(unequal()) <= most)


def first_common(in_long: bool) -> Column:
    """The list of key_a is the first of its kind (long or not) that the pair has in common. Equal
    coordinates lie in the same list, so one side's marks tell the kind."""
    kind = F.col("long_a") if in_long else F.bitwise_not("long_a")
    earlier = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col(
        "key_a").bitwiseAND(F.lit(255)).cast("int")))
    return F.bitwise_not(unequal()).bitwiseAND(kind).bitwiseAND(earlier) == 0


def per_class(docs: DataFrame, wanted: DataFrame, width: int, name: str, kind: str,
              of: Callable[[np.ndarray], object]) -> DataFrame:
    """(id, ``name``): ``of`` the shingles of the classes ``wanted`` (doc, rep, h1, h2). A class is
    read from the rows of its smallest id; of different texts that share the id, the hashes of the
    whole set tell the right one."""
    def run(batches):
        for batch in batches:
            found = [shingles(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(h, pa.int64()) for h in set_hashes(found)],
                 pa.array([of(f) for f in found], value)], names=["rep", "h1", "h2", name])

    value = {"binary": pa.binary(), "array<long>": pa.list_(pa.int64())}[kind]
    texts = docs.join(small(wanted.select(F.col("rep").alias("doc_id")).distinct()), "doc_id",
                      "left_semi")
    found = saved(texts.mapInArrow(run, f"rep long, h1 long, h2 long, {name} {kind}")
                  .join(small(wanted), ["rep", "h1", "h2"])
                  .select(F.col("doc").alias("id"), name), name)
    # More rows than classes: some row was repeated, id and text.
    return found if found.count() == wanted.count() else saved(
        found.dropDuplicates(["id"]), name)


def sketch_similar(x: np.ndarray, y: np.ndarray, n_x: int, n_y: int, percent: int,
                   size: int) -> bool:
    """Exact where both sketches are whole sets. Else: what both sets share among the ``size``
    smallest hashes of their union is in both sketches, about ``percent`` % of ``size`` for sets as
    similar as that; four standard errors less are asked for."""
    both, share = len(np.intersect1d(x, y, assume_unique=True)), percent / 100
    if n_x <= size and n_y <= size:
        return both * 100 >= (n_x + n_y - both) * percent
    return both >= int(size * share - 4 * (size * share * (1 - share)) ** 0.5)


def like_sizes(a: str, b: str, percent: int) -> Column:
    """Sets of these sizes can be similar enough at all."""
    return ((F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent))


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int,
              percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union.

    Documents are dealt into blocks; a task has the sets of two blocks, each once, and their pairs.
    There are so many blocks that two of them fit a task, and that all tasks have work."""
    ids = saved(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "ids")
    wanted = saved(classes.select("doc", "rep", "h1", "h2").join(small(ids), "doc", "left_semi"),
                   "wanted")
    full = per_class(docs, wanted, width, "shingles", "binary", np.ndarray.tobytes)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = full.agg(F.coalesce(F.sum(F.octet_length("shingles")), F.lit(0))).first()[0]
    blocks = 1 + max(int((2 * tasks) ** 0.5), total // SET_BYTES,
                     int((pairs.count() / BLOCK_PAIRS) ** 0.5))

    def block(doc: str) -> Column:
        return F.pmod(F.xxhash64(doc), F.lit(blocks)).cast("int")

    at = ["i", "j"]  # named anew on one side below, as both come from the same table
    dealt = pairs.select("a", "b", block("a").alias("i"), block("b").alias("j"))
    used = dealt.select(F.explode(F.array("a", "b")).alias("id"), *at).distinct()

    def check(two, sets):
        of = {k: np.frombuffer(x, np.uint64) for k, x in zip(
            sets.column("id").to_pylist(), sets.column("shingles").to_pylist())}
        good = []
        for a, b in zip(two.column("a").to_pylist(), two.column("b").to_pylist()):
            x, y = of[a], of[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                good.append((a, b))
        return pa.table([pa.array([g[i] for g in good], pa.int64()) for i in range(2)],
                        names=["a", "b"])

    # A number of partitions that is asked for stays: a little data is much work here.
    left = dealt.repartition(tasks, *at)
    right = (used.join(full, "id").select("id", "shingles", *[F.col(c).alias(c) for c in at])
             .repartition(tasks, *at))
    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(check, "a long, b long")


def crowded_pairs(lists: DataFrame, percent: int, matches: int, sketch: int) -> DataFrame:
    """(a, b): pairs of long lists that are still in different components, whose sizes fit and whose
    signatures agree often enough, sketches too, each in the first long list that both lie in.
    ``lists``: key, doc, label, n, keys, long, sketch, and of the list ``main``, its members ``size``
    and those without main ``away``. Either side comes in blocks, so a task's memory does not grow
    with the list."""
    def blocks(n: str) -> Column:
        return (1 + F.floor(F.col(n) / LIST_BLOCK)).cast("int")

    def block(n: str) -> Column:
        return F.pmod(F.xxhash64("doc"), blocks(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks(n) - 1))

    def pair(at, a, b):
        if not (a.num_rows and b.num_rows):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        (x, x_doc, x_label, x_n, x_long), (y, y_doc, y_label, y_n, _) = (
            (t.column("keys").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1),
             *(t.column(c).to_numpy() for c in ("doc", "label", "n", "long"))) for t in (a, b))
        # The same for all rows of a list: its main component, and the coordinate of its key.
        main, place = b.column("main")[0].as_py(), at[0].as_py() & 255
        y, sketches, found = np.ascontiguousarray(y.T), b.column("sketch").combine_chunks(), []
        for i in range(len(x)):
            like = ((y_label == main) | (x_label[i] < y_label)) & (
                x_n[i] * 100 >= y_n * percent) & (y_n * 100 >= x_n[i] * percent)
            equal = y == x[i][:, None]
            like &= equal.sum(axis=0, dtype=np.uint8) >= matches
            earlier = [k for k in range(place) if int(x_long[i]) >> k & 1]
            like &= ~equal[earlier].any(axis=0)
            mine = a.column("sketch")[i].values.to_numpy()
            found += [(x_doc[i], y_doc[k]) for k in np.flatnonzero(like).tolist() if sketch_similar(
                mine, sketches[k].values.to_numpy(), x_n[i], y_n[k], percent, sketch)]
        return pa.table([pa.array([f(p) for p in found], pa.int64()) for f in (min, max)],
                        names=["a", "b"])

    at = ["key", "i", "j"]
    tasks = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = (lists.where("label <> main").withColumn("i", block("away")).withColumn("j", every("size"))
         .repartition(tasks, *at))
    b = (lists.select(*[F.col(c).alias(c) for c in lists.columns]).withColumn("j", block("size"))
         .withColumn("i", every("away")).repartition(tasks, *at))
    return a.groupBy(*at).cogroup(b.groupBy(*at)).applyInArrow(pair, "a long, b long")


def shared_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): links between the classes of an id that has several, as stars."""
    kind = ["n_shingles", "h1", "h2"]
    whole = F.struct(*kind)
    several = saved(rows.groupBy("doc_id").agg(F.min(whole).alias("low"), F.max(whole).alias("high"))
                    .where("low <> high").select("doc_id"), "several")
    of = (rows.select("doc_id", *kind).join(small(several), "doc_id", "left_semi")
          .join(classes.select("doc", *kind), kind).select("doc_id", "doc").distinct())
    first = of.groupBy("doc_id").agg(F.min("doc").alias("a"))
    return of.join(first, "doc_id").where("a <> doc").select("a", F.col("doc").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 5, percent: int = 75, coordinates: int = 64,
                    matches: int = 36, long_list: int = 32, sketch: int = 256) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row.

    Documents are linked when 100 * intersection >= ``percent`` * union of their sets of ``width``
    word shingles. A pair at exactly 75 % has fewer than 36 of 64 equal coordinates with
    probability 0.0005, at 80 % below 1e-5. Null, empty and blank texts have no shingles and stay
    alone; a null id is its own component (null) and kept; rows that share an id count as one
    document, linked through it: each of their texts finds its own near copies. Copies (equal sets)
    are collapsed to one class first, so a group of copies costs one posting per coordinate.
    """
    source = documents_of(docs, id_col, text_col)
    meta = saved(signatures(source, width, coordinates), "signatures")
    worded = meta.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # A class of equal sets gets a number, fixed by the writing: ids may repeat.
    classes = saved(worded.groupBy("n_shingles", "h1", "h2")
                    .agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"),
                         F.first("planes").alias("planes"))
                    .withColumn("doc", F.monotonically_increasing_id()), "classes")
    one = classes.select("doc", "rep", F.col("n_shingles").alias("n"), "keys",
                         *[F.get("planes", F.lit(k)).alias(f"p{k}") for k in range(PLANES)])
    same_id = saved(shared_ids(worded, classes), "same-id")
    if coordinates > 64:
        raise ValueError("at most 64 coordinates")

    # Long posting lists, and for each document which of its coordinates lie in them.
    coded = F.transform("keys", lambda v, i: v.cast("long") * 256 + i)
    posted = one.select("doc", F.explode(coded).alias("key"))
    long_keys = saved(posted.groupBy("key").agg(F.count("*").alias("n"))
                      .where(F.col("n") > long_list).select("key"), "long-lists")
    in_long = (posted.join(small(long_keys), "key").groupBy("doc")
               .agg(F.collect_set("key").alias("long_keys")))
    prefix = coordinates - matches + 1
    last = F.coalesce(F.col("long_keys"), F.array().cast("array<long>"))
    bits = F.aggregate(last, F.lit(0).cast("long"), lambda m, k: m.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(255)).cast("int"))))
    signed = saved(one.join(in_long, "doc", "left")
                   .select("doc", "rep", "n", "keys", *SIGNATURE[1:], bits.alias("long")),
                   "signed")
    pieces = F.transform(coded, lambda k, i: F.struct(
        k.alias("key"), (F.call_function("shiftright", F.col("long"), i).bitwiseAND(F.lit(1)) == 1)
        .alias("in_long")))
    ordered = F.concat(F.filter(pieces, lambda x: ~x["in_long"]),
                       F.filter(pieces, lambda x: x["in_long"]))
    postings = saved(signed.select("doc", "rep", F.explode(F.slice(ordered, 1, prefix)).alias("at"))
                     .select("doc", "rep", "at.key", "at.in_long"), "postings")

    def side(x: str, table: DataFrame, *columns: str) -> DataFrame:
        return table.select(*[F.col(c).alias(f"{c}_{x}") for c in columns])

    def matching(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sizes fit and whose signatures agree often enough."""
        a, b = (side(x, signed, "doc", *SIGNATURE) for x in "ab")
        return (pairs.join(a, pairs.a == a.doc_a).join(b, pairs.b == b.doc_b)
                .where(like_sizes("n_a", "n_b", percent) & agreeing(coordinates, matches))
                .select("a", "b"))

    # The smallest id heads the list: an original tends to come before what was made from it.
    heads = saved(postings.groupBy("key").agg(F.min_by("doc", "rep").alias("head"),
                                              F.count("*").alias("n"))
                  .where("n > 1").select("key", "head"), "heads")
    stars = (postings.join(heads, "key").where("doc <> head")
             .select(F.col("head").alias("a"), F.col("doc").alias("b")).distinct())
    links = saved(confirmed(saved(matching(stars), "star-pairs"), source, classes, width, percent),
                  "links")
    label = saved(connected_components(links.unionByName(same_id), "a", "b"), "labels")

    # What the stars left open: lists whose members are still in different components.
    labelled = (postings.join(heads.select("key"), "key", "left_semi")
                .join(label, F.col("doc") == F.col("node"), "left")
                .select("key", "in_long", "doc", F.coalesce("component", "doc").alias("label")))
    labelled = saved(labelled, "labelled")
    # Of each open list the component with most members: its members need no partner among
    # themselves, so one side of the join is the list without them.
    open_keys = (labelled.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key")
                 .agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n"))
                 .where("n > most.n")
                 .select("key", F.col("most.label").alias("main"), F.col("n").alias("size"),
                         (F.col("n") - F.col("most.n")).alias("away")))
    rest = saved(labelled.join(open_keys, "key"), "open")

    a, b = (side(x, rest.where("NOT in_long").join(signed, "doc"), "key", "doc", "label", "main",
                 *SIGNATURE, "long") for x in "ab")
    test = ((F.col("key_a") == F.col("key_b")) & (F.col("label_a") != F.col("main_a"))
            & ((F.col("label_b") == F.col("main_b")) | (F.col("label_a") < F.col("label_b")))
            & like_sizes("n_a", "n_b", percent) & agreeing(coordinates, matches)
            & first_common(False))
    short = a.join(b, test).select(F.least("doc_a", "doc_b").alias("a"),
                                   F.greatest("doc_a", "doc_b").alias("b"))
    crowd = rest.where("in_long")
    in_crowd = saved(classes.select("doc", "rep", "h1", "h2").join(
        small(saved(crowd.select("doc").distinct(), "ids")), "doc", "left_semi"), "wanted")
    drawn = per_class(source, in_crowd, width, "sketch", "array<long>",
                      lambda found: (found >> np.uint64(16)).astype(np.int64)[:sketch])
    crowded = crowded_pairs(
        crowd.join(signed.select("doc", "n", "keys", "long"), "doc")
        .join(drawn.withColumnRenamed("id", "doc"), "doc"), percent, matches, sketch)
    crossing_pairs = saved(short.unionByName(crowded).distinct(), "open-pairs")
    component = label
    if not crossing_pairs.isEmpty():
        more = saved(confirmed(crossing_pairs, source, classes, width, percent), "links")
        if not more.isEmpty():
            stars = label.select(F.col("node").alias("a"), F.col("component").alias("b"))
            component = saved(connected_components(stars.union(more), "a", "b"), "labels")

    # A component is named by the smallest id of its classes.
    member = (classes.select("n_shingles", "h1", "h2", "doc", "rep")
              .join(component, F.col("doc") == F.col("node"), "left")
              .withColumn("member", F.coalesce("component", "doc")))
    named = member.groupBy("member").agg(F.min("rep").alias("name"))
    ids = member.join(named, "member").select("n_shingles", "h1", "h2", "name")
    found = (meta.select("doc_id", "n_shingles", "h1", "h2")
             .join(ids, ["n_shingles", "h1", "h2"], "left"))
    group = F.when(F.col("doc_id").isNotNull(), F.coalesce("name", "doc_id"))
    return (found.withColumn("component_id", group)
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
                    .alias("kept")))
