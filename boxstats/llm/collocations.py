"""Operator 13: phrase collocations by best-first branch-and-bound growth.

Words are counted first, then the pairs of words that are frequent themselves. A pair grows into
phrases of three words only where that can matter. The counts of its parts bound the score of all
phrases that grow from it: a phrase xyz occurs at most as often as xy, and as yz, so it scores at
most f(xy) / f(x) (cut after x) and at most f(yz) / f(z) (cut before z). The frontier of a language
is the set of pairs whose bound reaches a level; it is expanded from the best down. At a level

- every phrase that scores as much has both its pairs in the frontier, so its count is known, and
- every pair that scores as much has all the phrases around it counted, so it is known to survive
  or not.

The first level is where the best pairs end, several times as many as are asked for; a language with
too few survivors there goes on at a lower one, and in the end at zero, where nothing is pruned.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxstats.llm.common import MULTIPLIER, mixed, saved, small

# A-Z lower-cased; what separates pieces becomes a byte that UTF-8 never has.
CUT = b"\xff"
TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r",
                        b"abcdefghijklmnopqrstuvwxyz" + CUT * 10)
UNKNOWN = "und"
BUFFER_WORDS = 1 << 20                  # words, or different words, that a task holds
BITS = 1 << 26                          # of a filter: 8 MB, whatever the number of its keys
KINDS = ("frequent", "left", "right", "good")
PAIR, TRIPLE = ["lang", "h1", "h2"], ["lang", "h1", "h2", "h3"]


def words_and_cuts(text: str | None) -> list[bytes]:
    """The words of a text, with ``CUT`` between its pieces."""
    if not text:
        return []
    return text.encode().translate(TABLE).replace(CUT, b" " + CUT + b" ").split()


def places(lang: str, *parts: np.ndarray) -> np.ndarray:
    """The bit of a filter for each key: a language and the hashes of its words."""
    import xxhash
    out = np.full(len(parts[0]), xxhash.xxh3_64_intdigest(lang), np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            out = mixed((out ^ p.view(np.uint64)) * np.uint64(MULTIPLIER))
    return out & np.uint64(BITS - 1)


class Hashes(dict):
    """word -> 63-bit hash (0 for a cut), remembered up to a bound."""

    def __init__(self, seed: int):
        import xxhash
        self.digest, self.seed = xxhash.xxh3_64_intdigest, seed
        super().__init__({CUT: 0})

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
            self[CUT] = 0
        value = (self.digest(word, self.seed) >> 1) or 1
        if len(word) < 100:
            self[word] = value
        return value


def buffers(batches, seed: int):
    """(language, hashes of the words, zeros between pieces and texts), in bounded parts."""
    known = Hashes(seed)
    held: dict[str, list[np.ndarray]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_and_cuts(text)
            held.setdefault(lang, []).extend((
                np.fromiter(map(known.__getitem__, words), np.int64, len(words)),
                np.zeros(1, np.int64)))
            size += len(words) + 1
            if size >= BUFFER_WORDS:
                yield from ((k, np.concatenate(v)) for k, v in held.items())
                held, size = {}, 0
    yield from ((k, np.concatenate(v)) for k, v in held.items())


def bits_at(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def frequent_pairs(lang: str, words: np.ndarray, frequent: np.ndarray):
    """(different words, their ids in the text with 0 for a cut or a rare word, starts of pairs of
    two such words)."""
    known, ids = np.unique(words, return_inverse=True)
    keep = bits_at(frequent, places(lang, known)) & (known != 0)
    ids = np.where(keep[ids], ids, -1)
    return known, ids, np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))


def filters(keys: DataFrame, kinds: tuple[str, ...]):
    """A broadcast bitmap of fixed size for each of ``kinds`` (boolean columns after lang and the
    hashes). What a filter wrongly lets through costs time only, as every count is complete."""
    def run(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            hashes = [batch.column(c).to_numpy() for c in batch.schema.names if c[0] == "h"]
            for lang in set(langs):
                own = langs == lang
                at = places(lang, *[h[own] for h in hashes]).astype(np.int64)
                for i, kind in enumerate(kinds):
                    yes = at[batch.column(kind).to_numpy(zero_copy_only=False)[own]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(yes), i, np.int32)), pa.array(yes + 1)],
                        names=["kind", "bit"])

    rows = (keys.mapInArrow(run, "kind int, bit long")
            .groupBy("kind", F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")))
    bitmaps = np.zeros((len(kinds), BITS // 8), np.uint8)
    for r in rows.toLocalIterator():
        at = (r["bucket"] - 1) * 4096
        bitmaps[r["kind"], at:at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bitmaps)


def counts(lang: str, n: np.ndarray, **hashes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(n), np.int32)), [lang]).cast("string"),
         *[pa.array(h) for h in hashes.values()], pa.array(n.astype(np.int64))],
        names=["lang", *hashes, "f"])


def word_counts(texts: DataFrame) -> DataFrame:
    def run(batches):
        held: dict[str, Counter] = {}

        def passed():
            for lang, found in held.items():
                found.pop(CUT, None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()),
                     pa.array([w.decode() for w in found], pa.string()),
                     pa.array(found.values(), pa.int64())], names=["lang", "word", "f"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, Counter()).update(words_and_cuts(text))
                if sum(map(len, held.values())) > BUFFER_WORDS // 4:
                    yield from passed()
        yield from passed()

    found = texts.mapInArrow(run, "lang string, word string, f long")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def hashed(words: DataFrame, min_count: int) -> tuple[DataFrame, int]:
    """(the frequent words with their hash h, its seed). A hash stands for one word: with the seed
    that is chosen, no frequent word shares its hash with any other word."""
    for seed in range(8):
        def run(batches):
            known = Hashes(seed)
            for batch in batches:
                h = [known[w.encode()] for w in batch.column("word").to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h, pa.int64())],
                                                 names=["lang", "word", "f", "h"])
        with_hash = words.mapInArrow(run, "lang string, word string, f long, h long")
        shared = (with_hash.groupBy("h").agg(F.min("word").alias("one"), F.max("word").alias("two"),
                                             F.max("f").alias("f"))
                  .where((F.col("one") != F.col("two")) & (F.col("f") >= min_count)))
        if shared.isEmpty():
            return saved(with_hash.where(F.col("f") >= min_count), "words"), seed
    raise ValueError("words share their hashes under every seed")


def pair_counts(texts: DataFrame, words: DataFrame, seed: int) -> DataFrame:
    bitmaps = filters(words.select("lang", "h", F.lit(True).alias("frequent")), ("frequent",))

    def run(batches):
        for lang, text in buffers(batches, seed):
            known, ids, at = frequent_pairs(lang, text, bitmaps.value[0])
            pairs, n = np.unique(ids[at] * len(known) + ids[at + 1], return_counts=True)
            yield counts(lang, n, h1=known[pairs // len(known)], h2=known[pairs % len(known)])

    found = texts.mapInArrow(run, "lang string, h1 long, h2 long, f long")
    return found.groupBy(*PAIR).agg(F.sum("f").alias("f"))


def triple_counts(texts: DataFrame, words: DataFrame, pairs: DataFrame, seed: int) -> DataFrame:
    """Counts of the phrases of three words that grow from the frontier: both pairs are frequent,
    and either the left and the right bound reach the level, or one of the pairs does itself.
    ``pairs``: the frequent ones, with a boolean column for each of ``KINDS``."""
    of_words = filters(words.select("lang", "h", F.lit(True).alias("frequent")), ("frequent",))
    of_pairs = filters(pairs.select(*PAIR, *KINDS), KINDS)

    def run(batches):
        for lang, text in buffers(batches, seed):
            known, ids, at = frequent_pairs(lang, text, of_words.value[0])
            codes, pair = np.unique(ids[at] * len(known) + ids[at + 1], return_inverse=True)
            place = places(lang, known[codes // len(known)], known[codes % len(known)])
            frequent, left, right, good = (bits_at(b, place) for b in of_pairs.value)
            # Neighbouring pairs that overlap in a word: the i-th and the one after it.
            i = np.flatnonzero(at[1:] == at[:-1] + 1)
            a, b = pair[i], pair[i + 1]
            i = i[frequent[a] & frequent[b] & (left[a] & right[b] | good[a] | good[b])]
            triples, n = np.unique(pair[i] * len(known) + ids[at[i + 1] + 1], return_counts=True)
            first = codes[triples // len(known)]
            yield counts(lang, n, h1=known[first // len(known)], h2=known[first % len(known)],
                         h3=known[triples % len(known)])

    found = texts.mapInArrow(run, "lang string, h1 long, h2 long, h3 long, f long")
    return found.groupBy(*TRIPLE).agg(F.sum("f").alias("f"))


def whole(column: str) -> str:
    """Counts as decimals, so that products are exact."""
    return f"cast({column} AS decimal(19,0))"


def score_of(a: str, left: str, right: str) -> Column:
    return F.expr(f"1000000BD * {whole(a)} * {whole(a)} div ({whole(left)} * {whole(right)})")


def bound_of(a: str, part: str) -> Column:
    """The most that a phrase can score if it grows from a pair of this count past this part."""
    return F.expr(f"1000000BD * {whole(a)} div {whole(part)}")


def scored_triples(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """With the counts on both sides of the lowest-scoring cut; equal scores: the first cut."""
    first = pairs.select(*PAIR, F.col("a").alias("xy"), F.col("l").alias("x"))
    second = pairs.select("lang", F.col("h1").alias("h2"), F.col("h2").alias("h3"),
                          F.col("a").alias("yz"), F.col("r").alias("z"))
    rows = (found.withColumnRenamed("f", "a").join(first, PAIR)
            .join(second, ["lang", "h2", "h3"])
            .withColumns({"one": score_of("a", "x", "yz"), "two": score_of("a", "xy", "z")}))
    early = F.col("one") <= F.col("two")
    return rows.select(*TRIPLE, "a", F.when(early, F.col("x")).otherwise(F.col("xy")).alias("l"),
                       F.when(early, F.col("yz")).otherwise(F.col("z")).alias("r"),
                       F.least("one", "two").alias("score"))


def best(rows: DataFrame, most: int, ranking, *order: Column) -> DataFrame:
    """Each language's first rows; every task keeps no more than these before they are shuffled."""
    window = Window.partitionBy("lang").orderBy(*order)
    return rows.withColumn("rank", ranking().over(window)).where(F.col("rank") <= most)


def levels_of(pairs: DataFrame, langs: DataFrame, most: int) -> DataFrame:
    """lang, level: the ``most``-th best score of a pair, or zero where there are fewer pairs."""
    top = best(pairs, most, F.row_number, F.desc("score"), *[F.col(c) for c in PAIR[1:]])
    ends = top.groupBy("lang").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    return (langs.join(ends, "lang", "left")
            .select("lang", F.when(F.col("n") >= most, F.col("least")).otherwise(F.lit(0))
                    .cast("long").alias("level")))


def survivors_at(texts: DataFrame, words: DataFrame, pairs: DataFrame, levels: DataFrame,
                 seed: int, min_count: int, contained_percent: int) -> DataFrame:
    """All phrases that score at least their language's level and are in no longer one."""
    frontier = pairs.join(small(levels), "lang").withColumns({
        "frequent": F.lit(True), "left": F.col("left_bound") >= F.col("level"),
        "right": F.col("right_bound") >= F.col("level"), "good": F.col("score") >= F.col("level")})
    texts = texts.join(small(levels.select("lang")), "lang", "left_semi")
    found = saved(triple_counts(texts, words, frontier, seed)
                  .where(F.col("f") >= min_count), "triples")
    triples = scored_triples(found, pairs).join(small(levels), "lang")
    inside = (found.select(*PAIR, "f").unionByName(
        found.select("lang", F.col("h2").alias("h1"), F.col("h3").alias("h2"), "f"))
        .groupBy(*PAIR).agg(F.max("f").alias("longer")))
    alone = (frontier.where("good").join(inside, PAIR, "left")
             .where(F.col("longer").isNull()
                    | (F.expr(f"100BD * {whole('longer')} < {contained_percent}BD * {whole('a')}"))))
    columns = ["a", "l", "r", "score"]
    return (triples.where(F.col("score") >= F.col("level")).select(*TRIPLE, *columns)
            .unionByName(alone.select(*PAIR, F.lit(None).cast("long").alias("h3"), *columns)))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang",
                 min_count: int = 10, top: int = 2000, contained_percent: int = 50,
                 first_level: int = 4) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the best phrases of each language.

    Texts (A-Z lower-cased) are split at ``.,;:!?`` and line ends into pieces, and these at spaces
    and tabs into words. A phrase is two or three consecutive words of a piece with ``a`` >=
    ``min_count`` occurrences; l and r count the two parts of its lowest-scoring cut (equal scores:
    the first), the score is floor(1000000 a a / (l r)), and n counts all words of the language. A
    phrase inside a longer one that has ``contained_percent`` % of its occurrences is dropped. The
    first ``top`` of each language by score, a (descending) and phrase (bytewise) are returned.

    Null and empty texts have no words; a null language is ``und``; repeated rows count each; no
    rows, or no frequent phrase, give no rows. Very long texts are counted in buffers; a hot
    language or phrase is summed map-side before every shuffle. Counts are kept under 63-bit hashes
    of words that are checked to be unambiguous, products are exact decimals. The filters of
    frequent words and frontier pairs are bitmaps of a fixed size. ``first_level``: the first level
    is at this many times ``top`` pairs, later ones at four times as many each.
    """
    lang = F.coalesce(F.col(lang_col).cast("string") if lang_col else F.lit(None), F.lit(UNKNOWN))
    texts = docs.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text"))
    all_words = saved(word_counts(texts), "all-words")
    sizes = saved(all_words.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
    words, seed = hashed(all_words, min_count)
    known = words.select("lang", "h", "f")
    counted = pair_counts(texts, words, seed).where(F.col("f") >= min_count)
    pairs = (counted.withColumnRenamed("f", "a")
             .join(known.withColumnsRenamed({"h": "h1", "f": "l"}), ["lang", "h1"])
             .join(known.withColumnsRenamed({"h": "h2", "f": "r"}), ["lang", "h2"]))
    pairs = saved(pairs.select(*PAIR, "a", "l", "r", score_of("a", "l", "r").alias("score"),
                               bound_of("a", "l").alias("left_bound"),
                               bound_of("a", "r").alias("right_bound")), "pairs")
    langs, settled, most = saved(pairs.select("lang").distinct(), "langs"), None, first_level * top
    while not langs.isEmpty():
        levels = saved(levels_of(pairs, langs, most), "levels")
        found = saved(survivors_at(texts, words, pairs, levels, seed, min_count,
                                   contained_percent), "survivors")
        done = saved(levels.join(found.groupBy("lang").agg(F.count("*").alias("found")), "lang",
                                 "left")
                     .where((F.col("level") == 0) | (F.col("found") >= top)).select("lang"), "done")
        ready = found.join(small(done), "lang", "left_semi")
        settled = ready if settled is None else settled.unionByName(ready)
        langs = saved(langs.join(small(done), "lang", "left_anti"), "langs")
        most *= 4
    if settled is None:
        settled = pairs.select(*PAIR, F.col("h1").alias("h3"), "a", "l", "r", "score").limit(0)
    # Ranked with ties first, so that only these phrases meet their words.
    order = [F.desc("score"), F.desc("a")]
    close = saved(best(settled, top, F.rank, *order).drop("rank"), "close")
    needed = saved(close.select("lang", F.explode(F.array("h1", "h2", "h3")).alias("h"))
                   .where("h IS NOT NULL").distinct(), "needed")
    spelled = saved(words.join(small(needed), ["lang", "h"], "left_semi")
                    .select("lang", "h", "word"), "spelled")
    for i in (1, 2, 3):
        close = close.join(spelled.withColumnsRenamed({"h": f"h{i}", "word": f"w{i}"}),
                           ["lang", f"h{i}"], "left")
    close = close.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    return (best(close, top, F.row_number, *order, F.col("phrase")).join(small(sizes), "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    "score"))
