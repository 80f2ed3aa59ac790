"""The registered queries themselves, with their production parameters, against brute force."""

import hashlib
import os
import sys
import zlib

import numpy as np
import pytest

from boxstats.llm import queries
from boxstats.llm.common import balanced
from boxstats.sources.tables import table

sys.path.insert(0, os.path.dirname(__file__))
from test_dedup import expected_groups, expected_removal  # noqa: E402
from test_tokens import TIKTOKEN, check_packing, library  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = table(spark, SF, "documents").orderBy("doc_id").collect()
    return {r.doc_id: r.text or "" for r in rows}


def rows_of(spark, name):
    found = queries.QUERIES[name](spark, SF).collect()
    return {r.doc_id: r for r in found}, len(found)


def test_op1(spark, docs):
    got, n = rows_of(spark, "op1_token_count")
    assert n == len(docs)
    for i, text in docs.items():
        tokens = len(library(text))
        assert (got[i].n_bytes, got[i].n_tokens) == (len(text.encode()), tokens)
        assert got[i].over_limit == (tokens > 1024)


def test_groups_are_balanced_by_size():
    assert list(balanced([3, 3, 5, 20, 1, 1], 8)) == [[0, 1], [2], [3], [4, 5]]
    assert list(balanced([], 8)) == []


def test_op2(spark, docs):
    got, n = rows_of(spark, "op2_near_dup")
    ids = list(docs)
    sizes, groups = expected_groups([docs[i] for i in ids])
    assert n == len(docs)
    for k, i in enumerate(ids):
        first = ids[groups[k]]
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (sizes[k], first, first == i)


def test_op4(spark, docs):
    rows = queries.op4_packing(spark, SF).collect()
    ids = {i: [*library(t), 0] for i, t in docs.items()}
    padding = check_packing(rows, ids)
    assert padding < 1024


def test_op5(spark, docs):
    got, n = rows_of(spark, "op5_bpe")
    assert n == len(docs)
    for i, text in docs.items():
        ids = np.array(TIKTOKEN.encode_ordinary(text), "<u4")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_op6(spark, docs):
    got, n = rows_of(spark, "op6_substring")
    assert n == len(docs)
    for i, (words, removed, kept) in zip(docs, expected_removal(list(docs.values()), 35)):
        assert (got[i].n_words, got[i].n_removed) == (words, removed)
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_op7(spark, docs):
    got, n = rows_of(spark, "op7_toxicity")
    assert n == len(docs)
    for i in docs:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.3)
    toxic = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect() if r.toxic is not None}
    pairs = [(got[a].score, got[b].score) for a in toxic for b in toxic
             if toxic[a] == 1 and toxic[b] == 0]
    assert np.mean([(x > y) + (x == y) / 2 for x, y in pairs]) > 0.8
