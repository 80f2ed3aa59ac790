"""Operator 7: toxicity by a weighted lexicon, matched by Aho-Corasick on folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstats.llm.common import by_bytes, documents_of, drawn, saved

# Letters of other scripts that look like Latin ones, and digits and signs that
# stand for letters inside words.
LOOK_ALIKES = dict(zip("абвеѕіјкмнорстухһԁԛԝαβεικνορτυχıɑɡ", "abbesijkmhopctyxhdqwabeikvoptuxiag"))
STAND_INS = str.maketrans("013457@$", "oieasta" + "s")
NOT_WORD = re.compile(r"[^a-z0-9@$]+")
# Harmless phrases that contain words of the lexicon.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "pond scum")
SHORTEST, LONGEST = 4, 8                    # letters of a stem
FEATURES = ("weight", "density", "hits", "words")

FOLD = {ord(k): v for k, v in LOOK_ALIKES.items()} | {c: None for c in range(0x300, 0x370)}


def folded(text: str) -> list[str]:
    """Lower-case Latin words: accents dropped, look-alike letters replaced, and digits or signs
    inside words with letters read as the letters they stand for."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).lower().translate(FOLD)
    words = NOT_WORD.split(text.lower())
    return [w if w.isalpha() else w.translate(STAND_INS) for w in words
            if w and (w.isalpha() or any(c.isalpha() for c in w))]


def stems(word: str) -> list[str]:
    """The whole word (closed by a space) and its prefixes."""
    return [f" {word} "] + [f" {word[:n]}" for n in range(SHORTEST, min(len(word), LONGEST) + 1)]


def automaton(lexicon: dict[str, float], exceptions: tuple[str, ...]):
    import ahocorasick
    out = ahocorasick.Automaton()
    for term, weight in lexicon.items():
        out.add_word(term, (len(term), weight))
    for phrase in exceptions:
        term = f" {' '.join(folded(phrase))} "
        out.add_word(term, (len(term), None))
    out.make_automaton()
    return out


def measure(text: str, matcher) -> tuple[float, float, float, float]:
    """Summed weight, weight per 100 words, number of hits, log-ish length. Hits inside an
    exception phrase do not count; of terms that begin at one word the heaviest does."""
    words = folded(text)
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    if len(matcher):
        hay = f" {' '.join(words)} "
        for end, (size, weight) in matcher.iter(hay):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if spared:
            best = {s: w for s, w in best.items()
                    if not any(a <= s < b for a, b in spared)}
    total = sum(best.values())
    return (min(total, 1e6) ** 0.5, 100.0 * total / (len(words) + 20.0),
            float(len(best)), float(len(words) + 1) ** 0.25)


def features_of(measures: tuple[float, float, float, float]) -> tuple[float, ...]:
    """What the logistic model sees: from ten hits on, more hits tell by their weight alone."""
    weight, density, hits, words = measures
    return weight, density, min(hits, 10.0), words


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    label_col: str, sample_rows: int) -> DataFrame:
    """(text, label) of at most about ``sample_rows`` labelled rows, drawn by a hash of the id.
    The drawn labels are the only broadcast side: that number bounds it."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"),
                          F.col(label_col).cast("double").alias("label")).dropna()
    chosen = drawn("doc_id", sample_rows, known.count())
    return saved(documents_of(docs, id_col, text_col).dropna().where(chosen)
                 .join(F.broadcast(known.where(chosen)), "doc_id").select("text", "label"),
                 "labelled")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample_rows: int = 20_000, least_rows: int = 3,
        least_odds: float = 20.0, exceptions: tuple[str, ...] = EXCEPTIONS) -> dict:
    """Lexicon and logistic weights from at most about ``sample_rows`` labelled rows.

    Terms are words and word beginnings, all counted in toxic and clean texts. A term in at least
    ``least_rows`` toxic texts stays if it is at least ``least_odds`` times as frequent in toxic
    texts and none of its own beginnings stays (a beginning with a single continuation becomes that
    longer term). Its weight is the logarithm of that ratio. Only terms near those odds reach the
    driver. Without toxic or without clean rows the model scores every text 0.
    """
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, sample_rows)
    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1.0, 0), sizes.get(0.0, 0)
    if not toxic or not clean:
        return {"lexicon": {}, "exceptions": exceptions, "weights": None}

    def terms_of(batches):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if label in (0.0, 1.0):
                    seen[int(label)].update({t for w in set(folded(text)) for t in stems(w)})
        terms = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string())]
            + [pa.array([n[t] for t in terms], pa.int64()) for n in reversed(seen)],
            names=["term", "n", "other"])

    ratio = (F.col("n") + 0.5) / (toxic + 1) * (clean + 1) / (F.col("other") + 0.5)
    # A longer term that replaces its beginning has at least 0.9 times its odds.
    found = (sample.select("text", "label").mapInArrow(terms_of, "term string, n long, other long")
             .groupBy("term").agg(F.sum("n").alias("n"), F.sum("other").alias("other"))
             .where((F.col("n") >= least_rows) & (ratio >= 0.89 * least_odds)).collect())
    common = {r.term: r.n for r in found}
    odds = {r.term: (r.n + 0.5) / (toxic + 1) * (clean + 1) / (r.other + 0.5) for r in found}
    # A beginning that (nearly) always goes on in one way is replaced by the longer term.
    longer: dict[str, str] = {}
    for term in sorted(common, key=lambda t: (-len(t), t)):
        for n in range(SHORTEST, len(term.strip()) + term.endswith(" ")):
            start = term[:n + 1]
            if common.get(start, 1e18) * 0.9 <= common[term]:
                longer.setdefault(start, term)
    lexicon: dict[str, float] = {}
    taken: set[str] = set()
    for term in sorted(common, key=lambda t: (len(t.strip()), t.endswith(" "), t)):
        word = term.strip()
        known = any(f" {word[:n]}" in taken for n in range(SHORTEST, len(word) + 1))
        if odds[term] >= least_odds and not known:
            taken.add(term)
            lexicon[longer.get(term, term)] = math.log(odds[term])

    columns = ", ".join(f"{n} double" for n in FEATURES)

    def features(batches):
        matcher = automaton(lexicon, exceptions)
        for batch in batches:
            rows = [features_of(measure(t, matcher)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(FEATURES))]
                + [batch.column(1)], names=[*FEATURES, "label"])

    measured = sample.select("text", "label").mapInArrow(features, f"{columns}, label double")
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(measured)
    fitted = LogisticRegression(regParam=1e-3, maxIter=50).fit(data.select("features", "label"))
    return {"lexicon": lexicon, "exceptions": exceptions,
            "weights": (float(fitted.intercept), *map(float, fitted.coefficients))}


def score_toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), hits: one row per input row, whole texts, no shuffle.

    Null and empty texts have no hits and score as such; repeated rows and null ids are rows like
    others. A model without weights scores 0.
    """
    weights = model["weights"]

    def run(batches):
        matcher = automaton(model["lexicon"], model["exceptions"])
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            scores, hits = [], []
            for group in by_bytes(texts, 1 << 20):
                for i in group:
                    values = measure(texts[i], matcher)
                    hits.append(int(values[2]))
                    if weights is None:
                        scores.append(0.0)
                        continue
                    z = weights[0] + sum(w * v for w, v in zip(weights[1:], features_of(values)))
                    scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(hits, pa.int64())],
                names=["doc_id", "score", "hits"])

    return documents_of(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, score double, hits long")
