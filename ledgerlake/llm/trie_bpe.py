"""BPE encoding by prefix-sharing trie traversal, and decoding.

The last token of a prefix's encoding is its state: a token that ends the prefix is the last one exactly if it and the
last token of what stands before it stay two tokens when merged on their own. So the distinct new words of a chunk go
into a trie, a depth-first walk gives every node its state from the states on its path, and the encodings of shared
prefixes are computed once. A word's encoding is read off by following states back from its leaf. The tokens that may end
a prefix are those that end its longest suffix which begins a token; that suffix follows from the one of the prefix before.

A text is cut at white space; known pieces come from caches of bounded size. Normalisation and pre-tokens follow the
vocabulary file (NFC, white space, lower case, contractions, letters, single digits, others): by Python for characters
below U+0530, whose classes all versions agree on, else by the tokenizers library. Special tokens in a text are cut
out first, as the library does.

Defined results: a null text counts as empty; an empty text, or one of white space, has no ids and decodes to the
empty text. Time and memory grow with a text's length, of a word too. Null ids and repeated rows give a row each. An empty table gives an empty table. Extra columns are not
read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm.byte_bpe import byte_alphabet

# The pre-token pattern and the mark of a word's end.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
_PLAIN_BELOW = "԰"
CHUNK_CHARS = 4_000_000


class TrieBpe:
    """``ids(texts)`` encodes whole texts; ``limit``: most cached pieces and words."""

    def __init__(self, path: str, limit: int = 300_000) -> None:
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.vocab: dict[str, int] = given["model"]["vocab"]
        #: By pair of ids: when they merge. By id: when it is made, and its two parts.
        self.rank: dict[int, int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for k, (a, b) in enumerate(given["model"]["merges"]):
            left, right = self.vocab[a], self.vocab[b]
            self.rank[left << 20 | right] = k
            self.made[self.vocab[a + b]] = k, left, right
        self.special = {x["content"]: x["id"] for x in given["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.pattern, self.stands = regex.compile(PATTERN), dict(enumerate(byte_alphabet()))
        #: What tokens begin with, without the mark; see :meth:`_next`.
        self.begins: set[str] = set()
        for token in self.vocab:
            text = token.removesuffix(WORD_END)
            self.begins.update([text[:n] for n in range(len(text) + 1)])
        self.limit = limit
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.stay: dict[int, bool] = {}  # by pair of ids
        self.inner: dict[str, tuple[str, list[tuple[int, int]]]] = {}
        self.final: dict[str, tuple[str, list[tuple[int, int]]]] = {}
        #: Tokens that their own symbols merge to; parts come before what is made of them.
        self.whole = set(self.vocab.values()) - self.made.keys()
        for token, (k, left, right) in self.made.items():
            if left in self.whole and right in self.whole and self._apart(left, right, k):
                self.whole.add(token)

    # -- whether tokens stay apart

    def _apart(self, left: int, right: int, until: int) -> bool:
        """Whether two neighbouring tokens, made of their symbols, stay two tokens up to the merge ``until``.

        Walks back in time from both, undoing the later merge first. If the tokens that meet at the border at some time
        have a merge that comes before those that consume them, it joins them. Of merges of one rank the left one is
        first.
        """
        left_until = right_until = until
        while True:
            meet = self.rank.get(left << 20 | right, until)
            if meet < left_until and meet <= right_until:
                return False
            left_made, right_made = self.made.get(left), self.made.get(right)
            if left_made is None and right_made is None:
                return True
            if right_made is None or left_made is not None and left_made[0] > right_made[0]:
                left_until, left = left_made[0], left_made[2]
            else:
                right_until, right = right_made[0], right_made[1]

    # -- the trie

    def _next(self, text: str, mark: str) -> tuple[str, list[tuple[int, int]]]:
        """The longest end of ``text`` that begins a token; its tokens that, with the mark, end the text, with their
        lengths, longest first."""
        while text not in self.begins:
            text = text[1:]
        ends = [(len(text) - k, self.vocab.get(text[k:] + mark)) for k in range(len(text))]
        return text, [(size, token) for size, token in ends if token is not None]

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """The ids of distinct words, given in the byte alphabet.

        The trie is kept as its words in order, in which a depth-first walk meets them; from one word to the next, the
        states of the prefix they share stay.
        """
        whole, stay, forever = self.whole, self.stay, len(self.rank)
        for cache in (stay, self.inner, self.final):
            if len(cache) > 4 * self.limit:
                cache.clear()
        # by length of a prefix: its encoding's last token, the length before that token, its end that begins a token
        states, before, ends = [0], [0], [""]
        last_word = ""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(last_word)) - 1
            while shared < most and word[shared] == last_word[shared]:
                shared += 1
            del states[shared + 1:], before[shared + 1:], ends[shared + 1:]
            last_word, size, end, known, mark = word, len(word), ends[shared], self.inner, ""
            for n in range(shared + 1, size + 1):
                if n == size:
                    known, mark = self.final, WORD_END
                end += word[n - 1]
                if (found := known.get(end)) is None:
                    found = known[end] = self._next(end, mark)
                end, options = found
                for length, token in options:
                    if length == n:
                        if token in whole:
                            break
                    else:
                        pair = states[n - length] << 20 | token
                        if (apart := stay.get(pair)) is None:
                            apart = stay[pair] = self._apart(states[n - length], token, forever)
                        if apart:
                            break
                else:
                    raise ValueError(f"no encoding for {word!r}")  # cannot be: every byte is a token
                states.append(token)
                before.append(n - length)
                ends.append(end)
            ids, n = [], size
            while n:
                ids.append(states[n])
                n = before[n]
            del states[size:], before[size:], ends[size:]  # the leaf's
            yield word, ids[::-1]

    # -- texts

    def _words_of(self, text: str) -> list[str]:
        """The pre-tokens of a text in the byte alphabet."""
        if max(text) >= _PLAIN_BELOW:
            normal = self.library.normalizer.normalize_str(text)
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return self._split(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _split(self, text: str) -> list[str]:
        """The pre-tokens of a normalised text in the byte alphabet."""
        if text.isalpha():
            words = [text]
        elif text[:-1].isalpha() and text[-1] in ".,":
            words = [text[:-1], text[-1]]
        else:
            words = self.pattern.findall(text)
        if text.isascii() and text.isprintable():
            return words
        return [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.stands)
                for w in words]

    def _learn(self, pieces: set[str]) -> None:
        """Puts the ids of new pieces into the cache."""
        split, plain = {}, []
        for piece in pieces:
            if "<|" in piece:
                split[piece] = [x if x in self.special else self._words_of(x) for x in self.cut.split(piece) if x]
            elif piece.isascii():
                plain.append(piece)
            else:
                split[piece] = [self._words_of(piece)]
        # of ASCII pieces, which are normal but for their case, all are lowered at once
        own = dict(zip(plain, map(self._split, " ".join(plain).lower().split(" ")), strict=True)) if plain else {}
        new = {w for parts in split.values() for x in parts if isinstance(x, list) for w in x}
        new.update(*own.values())
        cached = self.words
        for word, ids in self.encode_words(new - cached.keys()):
            cached[word] = array("I", ids).tobytes()
        for piece, words in own.items():
            self.pieces[piece] = cached[words[0]] if len(words) == 1 else b"".join([cached[w] for w in words])
        for piece, parts in split.items():
            self.pieces[piece] = b"".join(
                b"".join([cached[w] for w in x]) if isinstance(x, list) else array("I", [self.special[x]]).tobytes()
                for x in parts)

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for cache in (self.pieces, self.words):
            if len(cache) > self.limit:
                cache.clear()
        # an ASCII text without special tokens is lowered first, so that it has fewer different pieces
        cut = [(x.lower() if x.isascii() and "<|" not in x else x).replace("\n", " ").replace("\r", " ")
               .replace("\t", " ").split(" ") for x in texts]
        self.pieces[""] = b""
        self._learn(set().union(*cut) - self.pieces.keys())
        return [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in cut]


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text; ids as little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of a word-end BPE file that every executor has.
    """
    slim = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = TrieBpe(tokenizer)
        for batch in batches:
            start, texts, size = 0, [], 0
            for k, x in enumerate(batch.column("text")):
                texts.append(x.as_py())
                size += len(texts[-1])
                if size >= CHUNK_CHARS or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(texts)),
                                                      pa.array(bpe.ids(texts), pa.binary())], ["doc_id", "ids"])
                    start, texts, size = k + 1, [], 0

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, ids binary")


def token_texts(tokenizer: str) -> list[str]:
    with open(tokenizer, encoding="utf-8") as f:
        given = json.load(f)
    tokens = given["model"]["vocab"] | {x["content"]: x["id"] for x in given["added_tokens"]}
    out = [""] * (max(tokens.values()) + 1)
    for token, k in tokens.items():
        out[k] = token
    return out


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded text; this vocabulary file has no decoder, so tokens are joined by
    spaces, special ones included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_texts(tokenizer)
        for batch in batches:
            texts, start, size = [], 0, 0
            for k, x in enumerate(batch.column("ids")):
                texts.append(" ".join([tokens[i] for i in array("I", x.as_py())]))
                size += len(texts[-1])
                if size >= 2 * CHUNK_CHARS or k == batch.num_rows - 1:
                    part = batch.slice(start, len(texts))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                     ["doc_id", "ids", "decoded"])
                    start, texts, size = k + 1, [], 0

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")
