"""Operator 4: mixture-controlled packing by deficit round robin over source queues.

Each source is a queue of tokens, served a quantum at a time. A source's credit grows in
proportion to its share of all tokens; the next quantum goes to the source whose turn
``(2k + 1) / (2K)`` comes first (``k`` quanta served of its ``K``), which keeps every source within
one quantum of its target after every window. The credits have a closed form, so they carry over
windows and partitions without a sequential pass: a task needs only how many quanta of its sources
lie in earlier partitions.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxstats.llm.common import by_bytes, saved, worker_state
from boxstats.llm.tokens import id_cache

PIECES = ("part int, source string, packet long, doc_id long, start long, length long, "
          "ids_crc32 long, doc_tokens long, within long")
RESULT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, source string")


class Queues:
    """The open quantum of each source in one partition, and the finished pieces."""

    def __init__(self, part: int, quantum: int, sequence: int):
        self.part, self.quantum, self.sequence = part, quantum, sequence
        # source -> [packet, tokens in it, its pieces so far]
        self.open: dict[str, list] = {}
        self.columns: list[list] = [[] for _ in range(8)]

    def add(self, source: str, doc: int | None, ids: bytes) -> None:
        """Append a document to its source's queue; quanta that fill up are emitted. Whole quanta
        inside the document need no piece list."""
        total, quantum = len(ids) // 4, self.quantum
        queue = self.open.setdefault(source, [0, 0, []])
        packet, filled, pieces = queue
        at, crc32 = 0, zlib.crc32
        if filled:
            at = min(quantum - filled, total)
            pieces.append((doc, 0, ids[:4 * at], total))
            filled += at
            if filled < quantum:
                queue[1] = filled
                return
            self._emit(source, packet, pieces)
            packet += 1
            queue[2] = pieces = []
        n = (total - at) // quantum
        if n:
            step = 4 * quantum
            starts = range(at, at + n * quantum, quantum)
            names, packets, docs, begins, lengths, sums, totals, within = self.columns
            names += [source] * n
            packets += range(packet, packet + n)
            docs += [doc] * n
            begins += starts
            lengths += [quantum] * n
            sums += [crc32(ids[4 * s:4 * s + step]) for s in starts]
            totals += [total] * n
            within += [0] * n
            at += n * quantum
        if at < total:
            pieces.append((doc, at, ids[4 * at:], total))
        queue[0], queue[1] = packet + n, total - at

    def _emit(self, source: str | None, packet: int, pieces: list[tuple]) -> None:
        before = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            for column, value in zip(self.columns, (source, packet, doc, start, n,
                                                    zlib.crc32(ids), total, before)):
                column.append(value)
            before += n

    def close(self) -> None:
        """What is left in the open quanta (less than a quantum a source) goes, source after
        source, into whole sequences; the last tokens into sequences of a power of two."""
        rest = [piece for source in sorted(self.open) for piece in self.open[source][2]]
        left, packet = sum(len(piece[2]) // 4 for piece in rest), 0
        rest.reverse()
        while left:
            size = self.sequence if left >= self.sequence else 1 << left.bit_length() - 1
            pieces, room = [], size
            while room:
                doc, start, ids, total = rest.pop()
                take = min(room, len(ids) // 4)
                pieces.append((doc, start, ids[:4 * take], total))
                if len(ids) > 4 * take:
                    rest.append((doc, start + take, ids[4 * take:], total))
                room -= take
            self._emit(None, packet, pieces)
            packet, left = packet + 1, left - size

    def batch(self) -> pa.RecordBatch:
        n = len(self.columns[0])
        kinds = [pa.string()] + [pa.int64()] * 7
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, self.part, np.int32))]
            + [pa.array(c, k) for c, k in zip(self.columns, kinds)],
            names=[c.split()[0] for c in PIECES.split(", ")])
        self.columns = [[] for _ in range(8)]
        return out


def turns(packet: np.ndarray, source: np.ndarray, totals: list[int]) -> np.ndarray:
    """Place of each quantum (its number in its source, its source) among all quanta: how many
    come before it by ``(2k + 1) / (2K)``, ties by source. Exact at any size: products beyond 64
    bits are computed with Python integers."""
    exact = np.int64 if (2 * max(totals) + 2) * max(totals) < 1 << 62 else object
    turn = 2 * packet.astype(exact) + 1
    own = np.array(totals, exact)[source]
    place = np.zeros(len(packet), exact)
    for other, total in enumerate(totals):
        first = (source > other).astype(np.int64).astype(exact)     # ties: it precedes ours
        place = place + (turn * total + own - 1 + first) // (2 * own)
    return place.astype(np.int64)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", tokenizer: str | None = None, sequence: int = 1024,
         quantum: int = 256, end_id: int = 0) -> DataFrame:
    """Pieces of documents (id, start, length, crc32 of the ids, tokens of the document, sequence,
    offset, source), whose sequences hold at most ``sequence`` tokens.

    Tokens per source follow the sources' shares in every window; nothing is left out. Texts are
    encoded once, in one pass without a shuffle of text or ids; only the pieces (about one a
    quantum) are written and joined with the queue offsets of their partition. Null text is empty
    (one token, ``end_id``), a null source shares the queue of the empty name, repeated rows are
    packed each, an empty table gives no rows. The driver holds one number per source, so sources
    are meant to be mixture components; pass a coarser column for unbounded ones.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    if sequence % quantum:
        raise ValueError("the quantum must divide the sequence length")
    end = np.array([end_id], "<u4").tobytes()

    def cut(record_batches):
        cache = worker_state(("ids", path), lambda: id_cache(path))
        queues = Queues(TaskContext.get().partitionId(), quantum, sequence)
        for batch in record_batches:
            ids, texts, sources = (c.to_pylist() for c in batch.columns)
            texts = [t or "" for t in texts]
            for group in by_bytes(texts, 1 << 20):
                coded = cache.combined([texts[i] for i in group], b"".join)
                for i, tokens in zip(group, coded):
                    queues.add(sources[i], ids[i], tokens + end)
                yield queues.batch()
        queues.close()
        yield queues.batch()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"))
    pieces = saved(rows.mapInArrow(cut, PIECES), "packing-pieces")

    counts = pieces.groupBy("part", "source").agg((F.max("packet") + 1).alias("packets"))
    counts = saved(counts, "packing-counts")
    earlier = (Window.partitionBy("source").orderBy("part")
               .rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select(F.col("part").alias("base_part"), F.col("source").alias("base_source"),
                         F.coalesce(F.sum("packets").over(earlier), F.lit(0)).alias("base"))
    shares = {r.source: r.n for r in counts.where("source IS NOT NULL").groupBy("source")
              .agg(F.sum("packets").alias("n")).where("n > 0").collect()}
    names = sorted(shares)
    totals = [shares[n] for n in names]
    number = {n: i for i, n in enumerate(names)}
    slots = sequence // quantum
    full = -(-sum(totals) // slots)          # windows of full quanta; the rest comes after them

    def place(record_batches):
        for batch in record_batches:
            t = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            packet = t["packet"].to_numpy(zero_copy_only=False) + t["base"].to_numpy(
                zero_copy_only=False)
            within = t["within"].to_numpy(zero_copy_only=False)
            sources = t["source"].to_pylist()
            window, offset = full + packet, within.copy()
            at = np.array([i for i, s in enumerate(sources) if s is not None], np.int64)
            if len(at):
                order = turns(packet[at], np.array([number[sources[i]] for i in at]), totals)
                window[at] = order // slots
                offset[at] = order % slots * quantum + within[at]
            yield pa.RecordBatch.from_arrays(
                [t[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
                + [pa.array(window, pa.int64()), pa.array(offset, pa.int64()), t["source"]],
                names=[c.split()[0] for c in RESULT.split(", ")])

    placed = pieces.join(base, (F.col("part") == F.col("base_part"))
                         & F.col("source").eqNullSafe(F.col("base_source")))
    return (placed.select("packet", "base", "within", "source", "doc_id", "start", "length",
                          "ids_crc32", "doc_tokens").mapInArrow(place, RESULT))
