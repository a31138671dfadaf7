"""Token ids of whole texts with public tokenizer files.

The word BPE drops white space and merges inside words only, so a text's ids are the
ids of its white-space chunks in order, and each distinct chunk is encoded once per
worker.  Texts with characters for which Python's and the tokenizer's white space or
case rules could differ go through the tokenizer itself, whole.  The byte BPE runs on
whole texts.
"""
from __future__ import annotations

import re
from array import array

import numpy as np

# Characters on which both agree: ASCII and Latin letters without U+0130, and some
# punctuation; no separators U+001C..1F, no U+0085.
_UNSAFE = re.compile("[^\x00-\x1b\x20-\x84\x86-įı-ɏ‐-‧€]")
# A chunk that ends in plain punctuation: its two parts are split from each other by any
# of the tokenizer's rules.
_TAIL = re.compile(r"([a-zß-öø-ÿ]+)([.,;:!?%&$#*|]+)")
# A chunk that any of the tokenizer's rules leaves in one piece; the merges run on it directly.
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[.,;:!?%&$#*|]+")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable ones stand for themselves."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


class WordTokenIds(dict):
    """White-space chunk -> its ids as little-endian integers; forgets all past ``limit`` chunks."""

    def __init__(self, path: str, limit: int = 250_000):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.merge = self.tokenizer.model.tokenize

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        if _PIECE.fullmatch(chunk):
            letters = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(_LETTERS)
            ids = array("I", [t.id for t in self.merge(letters)]).tobytes()
        elif parts := _TAIL.fullmatch(chunk):
            ids = self[parts[1]] + self[parts[2]]
        else:
            ids = self.whole(chunk)
        self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if _UNSAFE.search(text) or "<|" in text:
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.lower().split()))


_LOADED: dict = {}


def word_token_ids(path: str) -> WordTokenIds:
    """The word BPE of ``path``, loaded once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenIds(path)
    return _LOADED[path]


def byte_bpe(path: str, pattern: str):
    """tiktoken encoding of the rank file ``path``, loaded once per Python worker."""
    if path not in _LOADED:
        import base64

        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def byte_bpe_with_end(path: str, pattern: str, end: str = "<|endoftext|>", end_id: int = 50256):
    """Text -> ids as little-endian integers by the rank file ``path``; ``end`` in a text is its one id.

    Equal to what the tokenizer of the same vocabulary gives, which knows ``end`` as a special token.
    """
    encoding = byte_bpe(path, pattern)

    def encode(text: str) -> bytes:
        parts = [encoding.encode_to_numpy(part, disallowed_special=()).astype("<u4").tobytes()
                 for part in text.split(end)]
        return end_id.to_bytes(4, "little").join(parts)

    return encode
