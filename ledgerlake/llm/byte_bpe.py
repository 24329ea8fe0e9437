"""Token ids of a byte-level BPE vocabulary file, as the tokenizers library gives them.

The vocabulary's ranks go to tiktoken's merge loop, which takes a whole text at once: on texts of many different words
that is less work than looking each word up in a cache.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken

# The pattern that splits text before the merges, and the printable stand-ins of the byte-level alphabet.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = (*range(33, 127), *range(161, 173), *range(174, 256))


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next one from U+0100 on."""
    chars, extra = [], 256
    for b in range(256):
        chars.append(chr(b if b in PRINTABLE else extra))
        extra += b not in PRINTABLE
    return chars


class ByteBpe:
    """Encodes whole texts to ids as little-endian unsigned 32-bit integers. Nothing is cached: ``limit``, once the most
    cached pieces, has no effect."""

    def __init__(self, path: str, limit: int = 0) -> None:
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        stands = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(stands[c] for c in token): rank for token, rank in given["model"]["vocab"].items()}
        self.special = {x["content"]: x["id"].to_bytes(4, "little") for x in given["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.ranks = ranks
        self.encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        known = {rank: len(token) for token, rank in ranks.items()}
        known |= {int.from_bytes(rank, "little"): len(x.encode()) for x, rank in self.special.items()}
        self.size = np.zeros(max(known) + 1, np.int64)  # bytes by id
        self.size[list(known)] = list(known.values())

    def ids(self, text: str) -> bytes:
        if self.split and any(x in text for x in self.special):
            return b"".join(self.special.get(x) or self._plain(x) for x in self.split.split(text) if x)
        return self._plain(text)

    def sizes(self, ids: bytes) -> np.ndarray:
        """The bytes of text that each of the ``ids`` stands for."""
        return self.size[np.frombuffer(ids, "<u4")]

    def _plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()


@lru_cache(maxsize=4)
def shared_bpe(path: str) -> ByteBpe:
    """The encoder of a file, made once by each Python worker."""
    return ByteBpe(path)
