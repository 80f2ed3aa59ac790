"""Operator 10: quality rules and cross-document line frequency.

Only DataFrame expressions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstats.llm.common import SPACE, saved, small

GAPS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), 0)


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(F.coalesce(inner, F.lit("")) == "", F.array().cast("array<string>")) \
        .otherwise(F.split(inner, GAPS))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def repeated_words(text_words: Column, width: int = 5) -> Column:
    """Words inside windows of ``width`` words that occur at least twice in the array."""
    def windows(w: Column) -> Column:
        last = F.size(w) - width
        return F.when(last >= 1, F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        ).otherwise(F.array().cast("array<long>"))

    def starts(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"])
                     | (x["h"] == F.get(s, k + 1)["h"])), lambda x: x["i"])))

    def covered(p: Column) -> Column:
        return total(F.transform(p, lambda x, k: F.least(
            F.coalesce(F.get(p, k + 1) - x, F.lit(width)), F.lit(width)).cast("long")))

    return let(text_words, lambda w: let(windows(w), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
        .otherwise(let(starts(h), covered))))


def base_columns(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    blank = F.translate(text, SPACE, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE, "") != "")
    return {
        "n_words": F.size(words(text)).cast("long"),
        "word_chars": F.length(blank).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a)))
                           .cast("long")),
        "n_repeat_words": repeated_words(words(text)),
    }


def normal_line(line: Column) -> Column:
    """Its lower-cased words, joined by one space."""
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(SPACE)), GAPS, " "))


def without_lines(text: Column, hashes: Column) -> Column:
    """The text without the lines whose normal form has one of the hashes."""
    return let(hashes, lambda f: F.array_join(F.filter(
        F.split(text, "\n"), lambda x: ~F.array_contains(f, F.xxhash64(normal_line(x)))), "\n"))


def line_structs(text: Column) -> Column:
    """For each line with a word: hash of its normal form, number of its words."""
    def line(x: Column) -> Column:
        return let(normal_line(x), lambda t: F.struct(
            F.xxhash64(t).alias("h"),
            (F.length(t) - F.length(F.translate(t, " ", "")) + 1).alias("n")))
    kept = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                    lambda x: F.translate(x, SPACE, "") != "")
    return F.transform(kept, line)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            host_col: str = "source", min_words: int = 10, max_repeat_percent: int = 20,
            min_documents: int = 20, min_left_percent: int = 20,
            carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the base measures, base_failed, n_removed_words, kept: one row per input row. With
    ``carry``, also clean_text (without the removed lines) and those columns as a struct carried.

    A line is boilerplate if more than ``min_documents`` documents of its host have it, however
    large the host is. Documents with the same text count once, else all lines of a text with many
    copies would be boilerplate, and none of its copies be left for deduplication. Its words are
    removed; a document left with fewer than ``min_words`` words, or with less
    than ``min_left_percent`` % of them, is depleted and not kept. Null and empty texts have no
    words and fail the base rules; a null host is a host of its own; repeated rows are judged each.

    Lines are counted by two grouped counts (combined map-side; no group is collected). The
    frequent ones meet the lines of the documents by host and hash, however many a host has; a
    document gathers only its own.
    """
    text = F.col("text")
    host = F.coalesce(F.col(host_col).cast("string"), F.lit("\x00"))
    extra = [F.struct(*carry).alias("carried")] if carry else []
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"), host.alias("host"), *extra)
    # Measured once: the lines feed the counts and the verdicts. No text unless it is carried.
    # Ids may repeat, so a row has a number, fixed by the writing.
    measured = saved(source.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id", "host", F.xxhash64("text").alias("t"), line_structs(text).alias("lines"),
        *[c.alias(n) for n, c in base_columns(text).items()],
        *(["text", "carried"] if carry else [])), "measures")
    texts = measured.select("host", "t", "lines")
    counted = (texts.select("host", "t", F.explode("lines").alias("line"))
               .select("host", "t", F.col("line.h").alias("h")).distinct()
               .groupBy("host", "h").agg(F.count("*").alias("n"))
               .where(F.col("n") > min_documents))
    frequent = small(saved(counted.select("host", "h"), "frequent"))
    hits = saved(
        measured.select("row", "host", F.explode("lines").alias("line"))
        .select("row", "host", F.col("line.h").alias("h"), F.col("line.n").cast("long").alias("n"))
        .join(frequent, ["host", "h"]).groupBy("row")
        .agg(F.sum("n").alias("n_removed_words"),
             *([F.collect_set("h").alias("frequent")] if carry else [])), "hits")
    if carry:
        # Only texts that lose lines are shuffled, to meet the hashes of these.
        touched = small(hits.select("row"))
        nothing = [F.lit(None).cast(hits.schema[c].dataType).alias(c) for c in hits.columns[1:]]
        joined = (measured.join(touched, "row", "left_anti").select("*", *nothing)
                  .unionByName(measured.join(touched, "row", "left_semi").join(hits, "row")))
    else:
        joined = measured.join(small(hits), "row", "left")
    removed = F.coalesce(F.col("n_removed_words"), F.lit(0).cast("long"))
    failed = ((F.col("n_words") < min_words)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (left < min_words) | (left * 100 < F.col("n_words") * min_left_percent)
    clean = [F.when(F.col("n_removed_words") == 0, F.col("text")).otherwise(
        without_lines(F.col("text"), F.col("frequent"))).alias("clean_text"),
        "carried"] if carry else []
    return (joined.withColumn("n_removed_words", removed)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", failed.alias("base_failed"), "n_removed_words",
                    (~failed & ~depleted).alias("kept"), *clean))
