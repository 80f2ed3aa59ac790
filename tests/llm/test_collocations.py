"""Operator 13 against plain counting of all phrases."""

import os
import random
import re
import sys
from collections import Counter

import pytest

from boxstats.llm import collocations as C

sys.path.insert(0, os.path.dirname(__file__))
from helpers import HARD, documents  # noqa: E402

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(rows, min_count=10, top=2000, percent=50):
    """``rows``: (lang, text)."""
    f = {}
    for lang, text in rows:
        own = f.setdefault(lang if lang is not None else "und", Counter())
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                own.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        phrases = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        longer = {}
        for p, a in phrases.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer.get(part, 0), a)
        found = []
        for p, a in phrases.items():
            if 100 * longer.get(p, 0) >= percent * a and p in longer:
                continue
            score, k = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k)
                           for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), a, own[p[:k]], own[p[k:]], n, score))
        for rank, x in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, x[2].decode(), *x[3:]))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def corpus(seed=1):
    """Zipf words, repeated passages, and two languages, one small."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "|", "X", "\xa0y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    passages = [" ".join(rng.choices(words, weights, k=rng.randint(3, 9))) for _ in range(30)]
    texts = []
    for i in range(150):
        parts = [" ".join(rng.choices(words, weights, k=rng.randint(1, 30))) for _ in range(4)]
        parts += rng.choices(passages, k=3)
        rng.shuffle(parts)
        texts.append((("en", "en", "en", "fr")[i % 4], rng.choice([". ", "\n", " ; "]).join(parts)))
    return texts


@pytest.mark.parametrize("top, first_level", [(2000, 4), (20, 1), (3, 1)])
def test_equals_plain_counting(spark, top, first_level):
    """The smaller tops settle above level zero, or after several levels."""
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = rows_of(C.collocations(docs, top=top, first_level=first_level))
    assert got == plain(rows, top=top) and len({r[0] for r in got}) == 2


def test_levels_prune_and_stay_exact(spark, monkeypatch):
    """Fewer phrases of three words are counted above level zero, with the same first rows."""
    rows, sizes = corpus(2), []
    docs = spark.createDataFrame(rows, "lang string, text string")
    count = C.triple_counts

    def watched(*args):
        found = count(*args)
        sizes.append(found.count())
        return found

    monkeypatch.setattr(C, "triple_counts", watched)
    best = rows_of(C.collocations(docs, top=5, first_level=2))
    C.collocations(docs, top=5, first_level=10**6)
    assert best == plain(rows, top=5) and sizes[0] < sizes[-1]


def test_hard_rows(spark):
    """Nulls, empty and very long texts, repeated rows, clashing columns, buffers of a few words."""
    texts = HARD + ["A b,c\td e! A b\x0bc d"] * 12 + ["NULL"]
    langs = [(None, "en", "und")[i % 3] for i in range(len(texts))]
    docs = documents(spark, texts, langs=langs)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert rows_of(C.collocations(docs, min_count=2)) == plain(rows, min_count=2)
    assert rows_of(C.collocations(docs, lang_col=None)) == plain([(None, t) for _, t in rows])


def test_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(C, "BUFFER_WORDS", 40)
    rows = corpus(3)[:60]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(C.collocations(docs, min_count=3)) == plain(rows, min_count=3)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    got = C.collocations(empty)
    assert got.collect() == [] and tuple(got.columns) == COLUMNS


def test_exact_products(spark):
    """Counts whose products pass 64 bits."""
    df = spark.createDataFrame([(3 * 10**12, 4 * 10**12, 5 * 10**12)], "a long, l long, r long")
    assert df.select(C.score_of("a", "l", "r")).first()[0] == 450000
