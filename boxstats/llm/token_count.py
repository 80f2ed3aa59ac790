"""Operator 1: token counts of whole texts."""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from boxstats.llm.common import balanced, documents_of, worker_state
from boxstats.llm.tokens import count_cache

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def sentence_counts(path: str):
    """Counts by a sentencepiece model. Its pieces may span white space, so texts stay whole."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def piece_counts(path: str):
    cache = count_cache(path)
    return lambda texts: cache.combined(texts, sum)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, limit: int = 1024,
                 batch_bytes: int = 1 << 20) -> DataFrame:
    """One row per input row: id, UTF-8 bytes, tokens, and whether the tokens exceed ``limit``.

    Texts of an Arrow batch are taken in groups balanced by their bytes, split at safe boundaries, and
    the pieces not seen before are encoded as batches; only lengths leave the function. Null and
    empty texts count zero tokens; a null id stays null; repeated rows are counted each. No
    shuffle; memory is one Arrow batch and a bounded cache. ``tokenizer``: a ``.json`` file of a
    byte-level BPE without a normaliser, or a sentencepiece ``.model``.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    make = sentence_counts if path.endswith(".model") else piece_counts

    def run(record_batches):
        count = worker_state(("count", path), lambda: make(path))
        for batch in record_batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = [len(t.encode()) for t in texts]
            tokens: list[int] = []
            for group in balanced(sizes, batch_bytes):
                tokens += count([texts[i] for i in group])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents_of(docs, id_col, text_col).mapInArrow(run, SCHEMA)
