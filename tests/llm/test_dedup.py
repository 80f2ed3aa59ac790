"""Operators 2 and 6 against brute force, and connected components."""

import os
import random
import sys
from collections import Counter

import numpy as np
import pytest

from boxstats.llm import near_dup, substring
from boxstats.llm.components import connected_components

sys.path.insert(0, os.path.dirname(__file__))
from helpers import HARD, documents  # noqa: E402


def shingle_set(text):
    words = [w.translate(LOWER) for w in split(text)]
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ")
            if w]


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected_groups(texts):
    sets = {i: shingle_set(t) for i, t in enumerate(texts)}
    links = [(i, j) for i in sets for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    return {i: len(s) for i, s in sets.items()}, closure(sets, links)


def corpus():
    """Copies, near copies in chains, a shared passage, short and blank texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    text = lambda n: [word() for _ in range(n)]           # noqa: E731
    base, passage, out = text(60), text(120), []
    for k in range(60):                                   # near copies of one text
        near = list(base)
        near[rng.randrange(60)] = word()
        out.append(" ".join(near))
    out += [" ".join(base).upper(), "  ".join(base)] * 3  # copies up to case and gaps
    for k in range(50):                                   # half of it is common to all
        out.append(" ".join(passage + text(20 + 3 * k)))
    chain = text(80)
    for k in range(12):                                   # each resembles the next
        chain = chain[3:] + text(3)
        out.append(" ".join(chain))
    out += ["a b c", "A  b c", "a b", "", " \n", "É b c d e f", "é b c d e f"]
    return out + [" ".join(text(rng.randrange(1, 90))) for _ in range(60)]


def test_near_duplicates_equal_brute_force(spark):
    texts = corpus()
    got = {r.doc_id: r for r in near_dup.near_duplicates(documents(spark, texts).repartition(5),
                                                        long_list=8).collect()}
    sizes, groups = expected_groups(texts)
    assert len(set(groups.values())) < len(texts) - 70
    for i in range(len(texts)):
        assert got[i].n_shingles == sizes[i] and got[i].component_id == groups[i], texts[i]
        assert got[i].kept == (groups[i] == i)


def test_each_text_of_a_repeated_id_finds_its_copies(spark):
    """Different texts under one id are one document; the links of every one of them count."""
    rng = random.Random(6)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    a, b, c = text(60), text(90), text(40)
    near = lambda words: " ".join([*words[:-1], "other"])
    rows = [(21, " ".join(a)), (21, " ".join(b)), (21, " ".join(b)), (27, near(a)), (29, near(b)),
            (9, " ".join(c)), (29, near(c)), (31, " ".join(text(30))), (5, ""), (5, " ".join(c))]
    sets = [shingle_set(t) for _, t in rows]
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = closure({i for i, _ in rows}, links)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want and want[27] == want[29] == 5
    assert sorted(r.n_shingles for r in got) == sorted(map(len, sets))


def test_near_duplicates_of_hard_cases(spark):
    docs = documents(spark, HARD)
    got = near_dup.near_duplicates(docs.union(docs.limit(5)))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = got.collect()
    assert len(rows) == len(HARD) + 5                      # repeated rows are rows
    component = {r.doc_id: r.component_id for r in rows}
    assert component[4] == 3 and component[7] == 6 and component[0] == 0 and component[1] == 1
    assert [r.kept for r in rows if r.doc_id is None] == [True]
    assert near_dup.near_duplicates(docs.limit(0)).isEmpty()


def test_match_threshold_misses_little():
    # Similarity of exactly 75 %: the share of signatures that agree too seldom.
    rng, misses = np.random.default_rng(3), 0
    multiply, plus = near_dup.multipliers(64)
    for _ in range(1_000):
        common, a, b = np.split(rng.integers(0, 1 << 63, 112, dtype=np.uint64), [84, 98])
        x, y = (near_dup.signature(np.concatenate([common, own]), multiply, plus)
                for own in (a, b))
        misses += (x == y).sum() < 36
    assert misses <= 5


def test_unrelated_sets_share_no_list_by_chance():
    rng, seen = np.random.default_rng(4), Counter()
    multiply, plus = near_dup.multipliers(64)
    for _ in range(400):
        found = near_dup.signature(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64), multiply, plus)
        seen.update(enumerate(found.tolist()))
    assert max(seen.values()) == 1


def test_long_lists_and_links_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "LIST_BLOCK", 7)
    monkeypatch.setattr(near_dup, "SET_BYTES", 3_000)
    texts = corpus()
    got = near_dup.near_duplicates(documents(spark, texts), long_list=4).collect()
    assert {r.doc_id: r.component_id for r in got} == expected_groups(texts)[1]


def test_much_work_on_little_data_stays_dealt(spark):
    """Adaptive execution joins small partitions; comparisons of many pairs must not meet there."""
    rows = [(7 << 8, i, i % 50, 50, [i] * 64, 1, [i], 0, 400, 392) for i in range(400)]
    lists = spark.createDataFrame(rows, "key long, doc long, label long, n long, keys array<int>, "
                                        "long long, sketch array<long>, main long, size long, away long")
    pairs = near_dup.crowded_pairs(lists, 75, 36, 256)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and "REPARTITION_BY_COL" not in plan
    assert pairs.isEmpty()


def test_a_pair_is_formed_in_its_first_common_list_of_a_kind(spark):
    rng, rows, want = np.random.default_rng(8), [], []
    for k in range(200):
        a = rng.integers(-2**31, 2**31, 64).astype(np.int32)
        b = np.where(rng.random(64) < rng.choice([0.02, 0.6]), a,
                     rng.integers(-2**31, 2**31, 64)).astype(np.int32)
        b[63 if k % 2 else k % 63] = a[63 if k % 2 else k % 63]
        long = int(rng.integers(-2**63, 2**63 - 1))
        for at in np.flatnonzero(a == b).tolist():
            mine = [i for i in np.flatnonzero(a == b).tolist()
                    if (long >> i & 1) == (long >> at & 1)]
            rows.append((len(rows), (7 << 8) | at, long, *near_dup.bit_planes(a).tolist(),
                         *near_dup.bit_planes(b).tolist()))
            want.append((mine[0] == at, bool(long >> at & 1), int((a == b).sum()) >= 36))
    names = [f"p{k}_{x} long" for x in "ab" for k in range(32)]
    df = spark.createDataFrame(rows, "id long, key_a long, long_a long, " + ", ".join(names))
    got = df.select("id", near_dup.first_common(True).alias("long"),
                    near_dup.first_common(False).alias("short"),
                    near_dup.agreeing(64, 36).alias("agree")).orderBy("id").collect()
    for r, (first, in_long, agree) in zip(got, want):
        assert (r.long if in_long else r.short) == first and r.agree == agree


@pytest.mark.parametrize("kind", ["long", "string"])
def test_connected_components(spark, kind):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 400)]
    edges += [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(300)]
    edges += [(3, 3), (950, 951), (951, 950), (950, 951)]
    name = (lambda x: x) if kind == "long" else (lambda x: f"n{x:04d}")
    df = spark.createDataFrame([(name(a), name(b)) for a, b in edges] + [(None, name(5))],
                               f"u {kind}, v {kind}")
    got = {r.node: r.component for r in connected_components(df).collect()}
    real = [(a, b) for a, b in edges if a != b]
    want = closure({x for e in real for x in e}, real)
    assert got == {name(a): name(b) for a, b in want.items()}
    assert connected_components(df.limit(0)).isEmpty()


def expected_removal(texts, window):
    words = [split(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("window, period, cover", [(35, 21, substring.COVER), (9, 7, (0, 1, 3))])
def test_substring_dedup_equals_brute_force(spark, window, period, cover):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abc", k=3))       # noqa: E731
    passages = [[word() for _ in range(n)] for n in (34, 35, 36, 60)]
    texts = []
    for k in range(80):
        text = []
        for _ in range(rng.randrange(4)):
            text += [word() for _ in range(rng.randrange(30))] + rng.choice(passages)
        texts.append("\n ".join(text))
    texts += [texts[3], texts[3] + "  ", " ".join(["x"] * 80), " ".join(passages[3] * 3), "", "NULL",
              " ".join(passages[1]), "CASE " * 40, "case " * 34]
    docs = documents(spark, texts).repartition(4)
    got = substring.dedup_substrings(docs, window=window, period=period, cover=cover,
                                     carry=("lang", "row")).collect()
    want = expected_removal([None if t == "NULL" else t for t in texts], window)
    assert len(got) == len(texts) and any(w[1] for w in want)
    for r in got:
        n, removed, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed) == (n, removed), texts[r.doc_id]
        assert " ".join(split(r.kept_text)) == kept and r.carried.lang == "en"
        if not removed and texts[r.doc_id] != "NULL":
            assert r.kept_text == texts[r.doc_id]           # untouched texts stay as they were


def test_substring_dedup_of_hard_cases(spark):
    docs = documents(spark, HARD)
    got = substring.dedup_substrings(docs)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(HARD)
    assert rows[6].n_removed == rows[6].n_words == rows[7].n_removed == 20_001
    assert rows[0].kept_text is None and rows[3].n_removed == 0
    assert substring.dedup_substrings(docs.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        substring.dedup_substrings(docs, period=21, cover=(0, 1, 2))
