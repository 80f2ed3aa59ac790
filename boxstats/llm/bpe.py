"""Operator 5: byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue."""

from __future__ import annotations

import base64
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from boxstats.llm.common import by_bytes, documents_of, worker_state
from boxstats.llm.tokens import PieceCache



class RankQueue:
    """Smallest rank first, leftmost position first within a rank.

    One bucket of positions per rank. Bit ``r`` of the words ``low`` says that bucket ``r`` is not
    empty, bit ``w`` of ``top`` that word ``w`` is not zero. Finding the next rank is two
    find-first-sets, whatever the number of entries. Words are 256 bits wide, ``top``
    holds a bit per 256 ranks.
    """

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * ((ranks >> 8) + 1)
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        word = rank >> 8
        self.low[word] |= 1 << (rank & 255)
        self.top |= 1 << word

    def pop(self) -> tuple[int, int]:
        top = self.top
        word = (top & -top).bit_length() - 1
        bits = self.low[word]
        first = bits & -bits
        rank = word << 8 | first.bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        self.low[word] = bits = bits ^ first
        if not bits:
            self.top = top ^ 1 << word
        return rank, bucket[0]


class BytePairEncoder:
    def __init__(self, path: str, pattern: str):
        import regex
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank)
                          for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pre_tokens = regex.compile(pattern).findall
        self.queue = RankQueue(max(self.tokens) + 1)
        self.cache = PieceCache(self._pieces)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. The parts form a linked list of start positions; ``pair[i]`` is
        the rank of joining the part at ``i`` with its successor. An entry of the queue is stale
        if its position has another rank by now."""
        rank_of, queue, n = self.ranks.get, self.queue, len(piece)
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        push, pop, waiting = queue.push, queue.pop, queue.buckets
        after, before = [*range(1, n + 2)], [*range(-1, n)]
        pair: list[int | None] = [rank_of(piece[i:i + 2]) for i in range(n - 1)]
        pair.append(None)
        for i, rank in enumerate(pair):
            if rank is not None:
                push(rank, i)
        while waiting:
            rank, i = pop()
            if pair[i] != rank:
                continue
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = pair[i] = None
            if end < n:
                before[end] = i
                rank = pair[i] = rank_of(piece[i:after[end]])
                if rank is not None:
                    push(rank, i)
            left = before[i]
            if left >= 0:
                rank = pair[left] = rank_of(piece[left:end])
                if rank is not None:
                    push(rank, left)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i:after[i]]])
            i = after[i]
        return ids

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        return [np.array([i for pre in self.pre_tokens(piece) for i in self.merge(pre.encode())],
                         "<u4").tobytes() for piece in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.cache.combined(texts, b"".join)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoder(path: str, pattern: str) -> BytePairEncoder:
    return worker_state(("bpe", path, pattern), lambda: BytePairEncoder(path, pattern))


def bpe_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               ranks: str | None = None, pattern: str = public_tokenizers.PATTERN,
               batch_chars: int = 1 << 20) -> DataFrame:
    """doc_id and ``ids`` (binary, little-endian unsigned 32-bit), one row per input row.

    Null and empty texts have no ids; repeated rows are encoded each; no shuffle.
    """
    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(record_batches):
        bpe = encoder(path, pattern)
        for batch in record_batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for group in by_bytes(texts, batch_chars):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(group[0], len(group)),
                     pa.array(bpe.encode([texts[i] for i in group]), pa.binary())],
                    names=["doc_id", "ids"])

    return documents_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def bpe_decode(encoded: DataFrame, ranks: str | None = None,
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids, and the ``decoded`` bytes of each row of ``bpe_encode``; null ids give null."""
    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(record_batches):
        bpe = encoder(path, pattern)
        for batch in record_batches:
            decoded = [None if ids is None else bpe.decode(ids)
                       for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(decoded, pa.binary())],
                names=["doc_id", "ids", "decoded"])

    return (encoded.select("doc_id", "ids")
            .mapInArrow(run, "doc_id long, ids binary, decoded binary"))
