"""Byte-level BPE ids of whole texts."""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from functools import lru_cache

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Beyond these code points libraries may hold different versions of Unicode.
_OTHER = re.compile("[^\\0-ɏ]")


class Encoder:
    """``encode`` gives a text's ids as little-endian unsigned 32-bit integers.

    They equal ``Tokenizer.encode(text, add_special_tokens=False).ids``. Texts with one of
    the tokenizer's special strings or with code points above U+024F go through that
    library. Others are encoded from the rank file of the same vocabulary, which applies
    the same merges at five times the rate; the tests hold both against each other.
    """

    def __init__(self, path: str, ranks_path: str):
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self._special = [t.content for t in added]
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, file)}
        self._ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self._special) or _OTHER.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self._ranked.encode_ordinary(text)

    def encode(self, text: str) -> bytes:
        return array("I", self.ids(text)).tobytes()


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """One encoder for each Python worker. ``name`` is a public tokenizer's JSON file with a
    rank file of the same name beside it."""
    path = public_tokenizers.path(name)
    return Encoder(path, path.removesuffix(".json") + ".tiktoken")


def tokenizer_version(name: str) -> str:
    """Digest of the tokenizer's file: counts of different versions are kept apart."""
    with open(public_tokenizers.path(name), "rb") as file:
        return hashlib.md5(file.read()).hexdigest()
