"""Token ids of a byte-level BPE vocabulary, fast enough for whole corpora."""

from __future__ import annotations

import base64
import os
import re
import struct
from functools import cache

import public_tokenizers

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Words whose ids a worker remembers; then it starts afresh.
MEMO_WORDS = 600_000
_UNSAFE = re.compile(r"\s ")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@cache
def largest_id(path: str = VOCABULARY) -> int:
    """The largest token id of a vocabulary."""
    with open(os.path.splitext(path)[0] + ".tiktoken", "rb") as lines:
        return max(int(line.split()[1]) for line in lines)


class WordBytes(dict):
    """A word -> the ids of " word", as little-endian unsigned 32-bit numbers.

    The vocabulary's pattern always cuts between a character and a space after it, so the ids of
    a text are those of its words, each with the space before it. Words come back often; only new
    ones are encoded.
    """

    def __init__(self, path: str = VOCABULARY) -> None:
        import tiktoken

        super().__init__()
        # The rank file beside the JSON one holds the same vocabulary for a faster encoder.
        with open(os.path.splitext(path)[0] + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pattern = public_tokenizers.PATTERN
        self._encode = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
        found = _packed(self._encode(" " + word))
        if len(word) <= 64:
            self[word] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text; none for null."""
        if not text:
            return b""
        if _UNSAFE.search(text):  # a space after white space belongs to a longer piece
            return _packed(self._encode(text))
        first, *rest = text.split(" ")
        return _packed(self._encode(first)) + b"".join(map(self.__getitem__, rest))


_LOADED: dict[str, WordBytes] = {}


def word_bytes(path: str = VOCABULARY) -> WordBytes:
    """One memo per worker and vocabulary."""
    if path not in _LOADED:
        _LOADED[path] = WordBytes(path)
    return _LOADED[path]
