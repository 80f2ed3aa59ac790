"""Operators 1, 4 and 5 against the libraries."""

import base64
import os
import sys
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from boxstats.llm import bpe, packing, token_count
from boxstats.llm.tokens import count_cache

sys.path.insert(0, os.path.dirname(__file__))
from helpers import HARD, documents  # noqa: E402

LIBRARY = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
RANKS = {base64.b64decode(a): int(b) for a, b in
         map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def caches():
    return count_cache(P.path("byte_bpe_50k.json")), bpe.BytePairEncoder(
        P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.sampled_from("ab'sréß1²٣ \n\t\r\x0b\x0c\x1c\x85  　.,!<|>漢е́ªⅧ"),
    st.characters(blacklist_categories=("Cs",))), max_size=40))
def test_split_encoding_equals_whole_encoding(caches, text):
    counts, encoder = caches
    assert counts.combined([text], sum) == [len(library(text))]
    ids = encoder.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == TIKTOKEN.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


def test_special_strings_inside_texts(caches):
    counts, encoder = caches
    for text in ("a<|endoftext|>b", " <|endoftext|>  <|endoftext|> c", "x  <|endoftext|>\n\ny"):
        assert counts.combined([text], sum) == [len(library(text))]
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == (
            TIKTOKEN.encode_ordinary(text))


def test_bounded_cache_changes_nothing():
    counts = count_cache(P.path("byte_bpe_50k.json"))
    counts.limit = 3
    texts = ["one two three four five six", "six five four", "one one one", ""]
    assert counts.combined(texts, sum) == [len(library(t)) for t in texts]


def test_long_pre_tokens(caches):
    for text in ("z" * 30_000, "aaab" * 5_000, "".join(chr(97 + i * i % 26) for i in range(9_999)),
                 "=" * 10_001, "é" * 5_000):
        assert np.frombuffer(caches[1].encode([text])[0], "<u4").tolist() == (
            TIKTOKEN.encode_ordinary(text))


def test_rank_queue_pops_by_rank_then_position():
    queue, entries = bpe.RankQueue(5_000), [(4_095, 3), (64, 9), (64, 2), (4_999, 0), (0, 7)]
    for entry in entries:
        queue.push(*entry)
    assert [queue.pop() for _ in entries] == sorted(entries) and not queue.buckets
    assert not any(queue.low) and not queue.top


def test_token_counts_of_hard_cases(spark):
    docs = documents(spark, HARD)
    got = token_count.token_counts(docs, limit=2)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    want = sorted(((None if t == "NOID" else i, len(x.encode()), len(library(x)),
                    len(library(x)) > 2) for i, t in enumerate(HARD)
                   for x in ["" if t == "NULL" else t]), key=str)
    assert rows == want
    assert token_count.token_counts(docs.limit(0)).isEmpty()


def test_token_counts_by_sentencepiece(spark):
    path = P.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_count.token_counts(documents(spark, HARD), tokenizer=path).dropna().collect()
    for r in got:
        text = "" if HARD[r.doc_id] == "NULL" else HARD[r.doc_id]
        assert r.n_tokens == len(model.encode(text))


def test_bpe_round_trip_of_hard_cases(spark):
    docs = documents(spark, HARD)
    got = bpe.bpe_decode(bpe.bpe_encode(docs)).collect()
    assert len(got) == len(HARD)
    for r in got:
        text = "NOID" if r.doc_id is None else HARD[r.doc_id]
        text = "" if text == "NULL" else text
        assert np.frombuffer(r.ids, "<u4").tolist() == TIKTOKEN.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
    assert bpe.bpe_decode(bpe.bpe_encode(docs.limit(0))).isEmpty()


def check_packing(rows, ids, sequence=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        own = np.array(ids[r.doc_id], "<u4")
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0
            at += p.length
        assert at == len(ids[doc])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= sequence
        padding += sequence - at if at & (at - 1) else 0
    return padding


def test_packing_of_hard_cases(spark):
    texts = [t for t in HARD if t != "NOID"]
    sources = [("a", "b", None)[i % 3] for i in range(len(texts))]
    docs = documents(spark, texts, sources).repartition(3)
    ids = {i: [*library("" if t == "NULL" else t), 0] for i, t in enumerate(texts)}
    rows = packing.pack(docs).collect()
    assert check_packing(rows, ids) <= 1024
    assert packing.pack(docs.limit(0)).isEmpty()


def test_windows_follow_the_mixture(spark):
    # Three sources with shares 6 : 3 : 1 over several partitions.
    texts = ["word " * 2_000] * 20
    sources = ["abaabacbaa"[i % 10] for i in range(20)]
    docs = documents(spark, texts, sources).repartition(4)
    ids = {i: [*library(t), 0] for i, t in enumerate(texts)}
    rows = packing.pack(docs, quantum=128).collect()
    assert check_packing(rows, ids) <= 1024
    total = sum(len(x) for x in ids.values())
    share = {s: sum(len(ids[i]) for i in ids if sources[i] == s) / total for s in "abc"}
    filled, seen = defaultdict(int), 0
    in_mixture = [r for r in rows if r.source is not None]
    for window in sorted({r.sequence_id for r in in_mixture}):
        for r in in_mixture:
            if r.sequence_id == window:
                filled[r.source] += r.length
                seen += r.length
        for s in "abc":           # no source ever runs more than a quantum or two off its target
            assert abs(filled[s] - share[s] * seen) <= 3 * 128


def test_turns_are_exact_beyond_64_bits():
    big = [3 * 10**10, 10**10, 7]
    packet, source = np.array([0, 5, 10**10 - 1, 6, 12_345]), np.array([0, 0, 1, 2, 1])
    got = packing.turns(packet, source, big).tolist()
    # Quanta of source o before turn k of source s, counted with exact integers.
    want = [sum(((2 * k + 1) * n + big[s] - 1 + (s > o)) // (2 * big[s])
                for o, n in enumerate(big)) for k, s in zip(packet.tolist(), source.tolist())]
    assert got == want
    small = [4, 2, 1]
    order = sorted(((2 * k + 1) / (2 * n), s, k) for s, n in enumerate(small) for k in range(n))
    assert packing.turns(np.array([k for *_, k in order]), np.array([s for _, s, _ in order]),
                         small).tolist() == list(range(7))
