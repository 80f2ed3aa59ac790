"""Safe splitting of texts for byte-level BPE, and a bounded cache over the pieces.

A text is split only where the tokenizer's own pattern always splits it: before white space that
follows other characters, and after a run of Latin letters before an ASCII character that is no
letter. So the pieces' tokens, one after the other, are the text's tokens, and texts of any length
are encoded in small parts.
"""

from __future__ import annotations

import re
from collections.abc import Callable

# The characters with the Unicode property White_Space, and letters of Latin-1.
WHITE = r"\t-\r \x85\xa0  -     　"
LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"

SAFE = (rf"[{WHITE}]*[{LETTERS}]++(?=[\x00-\x40\x5b-\x60\x7b-\x7f]|\Z)"
        rf"|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

# Pieces kept per worker; beyond it the cache starts anew (results never depend on it).
CACHE_PIECES = 1_000_000


class PieceCache:
    """piece -> value (a count, or ids as bytes), filled by ``encode`` in batches."""

    def __init__(self, encode: Callable[[list[str]], list], limit: int = CACHE_PIECES,
                 split: Callable[[str], list[str]] = re.compile(SAFE).findall):
        self.split = split
        self.encode, self.limit, self.known = encode, limit, {}

    def combined(self, texts: list[str], combine: Callable[[list], object]) -> list:
        """For each text ``combine`` of its pieces' values in order. Each piece is looked up once;
        a text with pieces not known yet (``combine`` raises TypeError on their None) waits until
        those of all texts are encoded together."""
        known, split = self.known.get, self.split
        out, holes = [], []
        missing: dict[str, None] = {}
        for text in texts:
            pieces = split(text)
            got = list(map(known, pieces))
            try:
                out.append(combine(got))
            except TypeError:
                at = [i for i, v in enumerate(got) if v is None]
                missing.update(dict.fromkeys([pieces[i] for i in at]))
                holes.append((len(out), got, pieces, at))
                out.append(None)
        if missing:
            new = dict(zip(missing, self.encode(list(missing)), strict=True))
            for place, got, pieces, at in holes:
                for i in at:
                    got[i] = new[pieces[i]]
                out[place] = combine(got)
            if len(self.known) + len(new) > self.limit:
                self.known.clear()
            self.known.update(new)
        return out


def library_tokenizer(path: str):
    """The tokenizer of a ``.json`` file; batches stay on the task's own core."""
    import os

    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def batches(texts: list[str], most: int = 1 << 18) -> list[list[str]]:
    """Consecutive groups of about ``most`` characters each."""
    groups, size = [[]], 0
    for text in texts:
        if groups[-1] and size + len(text) > most:
            groups.append([])
            size = 0
        groups[-1].append(text)
        size += len(text)
    return groups


def count_cache(path: str) -> PieceCache:
    tokenizer = library_tokenizer(path)

    def encode(pieces: list[str]) -> list[int]:
        return [len(e) for group in batches(pieces)
                for e in tokenizer.encode_batch_fast(group, add_special_tokens=False)]
    return PieceCache(encode)


def id_cache(path: str) -> PieceCache:
    """Ids as little-endian unsigned 32-bit integers."""
    import numpy as np
    tokenizer = library_tokenizer(path)

    def encode(pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for group in batches(pieces)
                for e in tokenizer.encode_batch_fast(group, add_special_tokens=False)]
    return PieceCache(encode)
