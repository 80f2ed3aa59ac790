"""Operators 3, 7 and 8: brute force over segmentations and vectors, held-out accuracy."""

import math
import os
import random
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from boxstats.llm import ann, lang_id, queries, toxicity
from boxstats.llm.common import drawn
from boxstats.sources.tables import table

sys.path.insert(0, os.path.dirname(__file__))
from helpers import HARD, documents  # noqa: E402

SF = "/root/testdata/sf0.01"


def all_segmentations(text, probability):
    if not text:
        return 1.0
    total = 0.0
    for n in range(1, len(text) + 1):
        p = probability.get(text[:n], lang_id.STRANGE if n == 1 else 0.0)
        if p:
            total += p * all_segmentations(text[n:], probability)
    return total


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "▁ab", "a", "b", "ab", "ba", "aba", "c"]
    rng = np.random.default_rng(2)
    table_ = rng.dirichlet(np.ones(len(pieces)), 2)
    lattice = lang_id.Lattice(pieces)
    words = ["a", "ab", "abab", "cabaab", "bxa", "abcabaabab"]
    got = lattice.log_probabilities(words, lattice.table(table_))
    for i, word in enumerate(words):
        for lang in range(2):
            own = dict(zip(pieces, table_[lang]))
            assert got[i, lang] == pytest.approx(math.log(all_segmentations("▁" + word, own)))


def test_words_of_any_length():
    """Beyond the length that is summed at once, and across blocks: with logarithms, position by
    position. No piece is too long either."""
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "internationalisation"]
    table_ = np.random.default_rng(4).dirichlet(np.ones(len(pieces)), 2)
    lattice = lang_id.Lattice(pieces)
    assert lattice.longest == 20
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("ab"), n)) for n in (3, 49, 60, 1023, 1024, 2500)]
    words += ["internationalisation" * 60, "x" * 3000, "ab" * 20]
    got = lattice.log_probabilities(words, lattice.table(table_))
    for i, word in enumerate(words):
        text = "▁" + word
        for lang in range(2):
            own = {p: math.log(x) for p, x in zip(pieces, table_[lang])}
            logs = [0.0]
            for j in range(1, len(text) + 1):
                ways = [logs[k] + own.get(text[k:j], math.log(lang_id.STRANGE) if j - k == 1
                                          else -math.inf) for k in range(max(0, j - 20), j)]
                most = max(ways)
                logs.append(most + math.log(sum(math.exp(w - most) for w in ways)))
            assert got[i, lang] == pytest.approx(logs[-1]), word[:20]


def test_shares_of_any_size_are_drawn(spark):
    """The threshold of a 63-bit hash for more rows than a share in millionths can tell."""
    rows = spark.range(200_000).withColumn("n", F.col("id").cast("string"))
    assert rows.where(drawn("n", 10, 10)).count() == 200_000
    assert 800 < rows.where(drawn("n", 1, 200)).count() < 1200
    assert rows.where(drawn("n", 10_000, 10**11)).count() < 5
    # The threshold itself is not rounded away.
    assert str((10_000 << 63) // 10**11) in drawn("n", 10_000, 10**11)._jc.toString()


def test_long_words_and_many_hits(spark):
    """No cap on hits, on a naive search over folded words; a third of the words are toxic."""
    model = {"lexicon": {" bad ": 2.0, " wors": 1.0}, "exceptions": ("bad luck",), "weights": None}
    text = "bad worse good " * 50 + "bad luck b4d " + "z" * 50_000
    docs = spark.createDataFrame([(1, text), (None, None)], "doc_id long, text string")
    got = {r.doc_id: r.hits for r in toxicity.score_toxicity(docs, model).collect()}
    words = toxicity.folded(text)
    naive = sum(w == "bad" or w.startswith("wors") for w in words) - text.count("bad luck")
    assert got == {1: naive, None: 0} and naive == 101


def test_expected_uses_add_up():
    pieces = ["▁", "▁a", "a", "b", "ab"]
    lattice = lang_id.Lattice(pieces)
    table_ = lattice.table(np.full((1, 5), 0.2))
    uses = lattice.expected(["ab", "a"], [0, 0], [3, 2], table_)
    length = np.array([len(p) for p in pieces])
    # Every segmentation covers each word's three or two characters once.
    assert (uses[:, 0] * length).sum() == pytest.approx(3 * 3 + 2 * 2)


def test_language_of_held_out_documents(spark):
    got = queries.op3_lang_id(spark, SF).toPandas()
    docs = table(spark, SF, "documents").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs) and both.score.between(0, 1).all()
    held = both[both.held_out]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.98


def test_language_of_hard_cases(spark):
    langs = [("en", "fr", None)[i % 3] for i in range(len(HARD))]
    docs = documents(spark, HARD, langs=langs)
    model = lang_id.fit(docs)
    got = lang_id.identify(docs, model, carry=("kept",))
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(HARD)
    for i in (0, 1, 2, 10):
        assert rows[i].lang_pred == "und" and rows[i].score == 0
    assert rows[3].lang_pred in ("en", "fr") and rows[3].carried.kept == "x"
    assert lang_id.identify(docs.limit(0), model).isEmpty()
    nothing = lang_id.fit(docs.limit(0))
    assert {r.lang_pred for r in lang_id.identify(docs, nothing).collect()} == {"und"}


def test_folding():
    assert toxicity.folded("Ｉdiot 1d10t ІDІOT іdіоt, ídiót $tup1d 2024 m0r0n!") == [
        "idiot", "idiot", "idiot", "idiot", "idiot", "stupid", "moron"]


def test_exceptions_and_length():
    matcher = toxicity.automaton({" trash ": 4.0, " moron": 5.0}, ("trash can",))
    hits = lambda t: toxicity.measure(t, matcher)
    assert hits("put it into the trash can")[2] == 0
    assert hits("what trash, can it be")[2] == 0          # punctuation does not part a phrase
    assert hits("trash")[2] == 1 and hits("trashy oxymoron")[2] == 0
    assert hits("morons and moronic trash")[2] == 3
    assert hits("moron")[1] > hits("moron " + "word " * 500)[1]     # normalised by length
    assert hits("")[0] == 0


def toxic_corpus(spark, n=600):
    rng = random.Random(4)
    words = ["".join(rng.choices("bcdfglmnprst", k=2)) + rng.choice("aeiou") + str(k)
             .translate(str.maketrans("0123456789", "bcdfghjklm")) for k in range(400)]
    bad = ["flumpwit", "grobnerd", "snarkoid"]
    texts, labels = [], []
    for _ in range(n):
        text = rng.choices(words, k=rng.randrange(5, 120))
        toxic = rng.random() < 0.2
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", "s", "ly"]))
        texts.append(" ".join(text))
        labels.append((len(texts) - 1, int(toxic)))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int"), labels


def test_toxicity_learns_a_lexicon(spark):
    docs, labels, known = toxic_corpus(spark)
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    assert {t.strip()[:4] for t in model["lexicon"]} == {"flum", "grob", "snar"}
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert all((got[i] >= 0.3) == bool(t) for i, t in known)
    planted = ["Fl0mpwit", "you flumpw1t, you GR0BNERD", "you ѕnаrkoid and flumpwіt"]
    scores = [r.score for r in toxicity.score_toxicity(documents(spark, planted[1:]), model)
              .collect()]
    assert min(scores) >= 0.3


def test_toxicity_learns_rare_words(spark):
    # 100 words, each in 1 % of the toxic rows.
    rng = random.Random(5)
    neutral = [f"{a}o{b}u" for a in "bcdfglmnpr" for b in "bcdfglmnpr"]
    rare = [f"{a}{b}zzik" for a in "bcdfghklmn" for b in "aeiouprstv"]
    texts = [" ".join([*rng.choices(neutral, k=30), rare[i % 100]][:31 if i < 300 else 30])
             for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(1200)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(documents(spark, texts), labels)
    assert {t.strip()[:4] for t in model["lexicon"]} == {w[:4] for w in rare}


def test_toxicity_of_hard_cases(spark):
    docs, labels, _ = toxic_corpus(spark, 100)
    model = toxicity.fit(docs, labels)
    hard = documents(spark, HARD)
    got = toxicity.score_toxicity(hard, model)
    assert got.count() == len(HARD)
    assert got.where("score < 0 OR score > 1 OR score IS NULL").isEmpty()
    assert toxicity.score_toxicity(hard.limit(0), model).isEmpty()
    blank = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score_toxicity(hard, blank).collect()} == {0.0}


def exact(ids, vectors, query, k):
    score = (vectors * vectors[query]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[query]][:k]
    return [(int(ids[i]), score[i]) for i in order]


def test_neighbours_recall_and_exact_scores(spark):
    got = queries.op8_ann(spark, SF).toPandas()
    rows = table(spark, SF, "embeddings").select("vec_id", "embedding").toPandas()
    ids, vectors = rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), np.float64)
    found = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        own = got[got.query_id == ids[q]].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 21))
        score = dict(zip(ids.tolist(), (vectors * vectors[q]).sum(axis=1)))
        assert all(abs(score[v] - s) < 1e-12 for v, s in zip(own.vec_id, own.score))
        want = {i for i, _ in exact(ids, vectors, q, 20)}
        found += len(want & set(own.vec_id))
        total += 20
    assert found / total >= 0.9


def test_all_lists_probed_gives_the_exact_answer(spark):
    # Norms differ, many vectors are equal, blocks and groups are small.
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((400, 24)) * rng.uniform(0.2, 3, (400, 1))
    vectors[100:220] = vectors[100]
    vectors = vectors.astype(np.float32).astype(np.float64)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(df, k=20, lists=7, probes=7, block_rows=16).toPandas()
    ids = np.arange(400)
    hit = total = 0
    for q in range(0, 400, 20):
        own = got[got.query_id == q].sort_values("rank")
        want = exact(ids, vectors, q, 20)
        hit += sum(a == b[0] for a, b in zip(own.vec_id, want))
        total += 20
        if 100 <= q < 220:              # ties among copies go to the smaller ids
            ties = [i for i in range(100, 220) if i != q]
            scores = (vectors * vectors[q]).sum(axis=1)
            if scores.max() == scores[100]:
                assert list(own.vec_id) == ties[:20]
    assert hit / total > 0.97           # the hypothesis test gives up a candidate now and then


def test_neighbours_of_hard_cases(spark):
    bad = [None, [], [0.0] * 4, [1.0, None, 1.0, 1.0], [float("nan")] * 4,
           [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(20 * i, v, "x") for i, v in enumerate(bad)] + [(None, [1.0] * 4, "x")]
    rows += [(200 + i, [1.0, float(i), 0.0, 1.0], "x") for i in range(5)]
    rows += [(200, [1.0, 0.0, 0.0, 1.0], "x"), (220, [1.0, 1.0, 1.0, 1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = ann.search(df).toPandas()
    assert set(got.query_id) == {200, 220} and not set(got.vec_id) & {0, 20, 40, 60, 80, 100, 120}
    # All candidates, if fewer than 20; a repeated id counts once, and never its own query.
    assert sorted(got[got.query_id == 200].vec_id) == [201, 202, 203, 204, 220]
    assert got[got.query_id == 220].vec_id.tolist()[0] == 204
    assert isinstance(got, pd.DataFrame) and ann.search(df.limit(0)).isEmpty()
    assert ann.search(df.where("vec_id = 20 OR vec_id = 0")).isEmpty()
