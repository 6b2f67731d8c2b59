"""Word shingles and circulant MinHash signatures of many texts at once.

Texts are laid end to end in one byte block and hashed by NumPy; there is no loop over
words. A word is ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, which is what
``bytes.lower`` and ASCII white space give on UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, np.uint64) | 1
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
_PLACE = (0xD6E8FEB86659FD93, 0xA5A5B4C3F1E2D70B)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits with good avalanche."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Shingler:
    """Distinct ``size``-word shingles of texts, as sorted 64-bit hashes."""

    def __init__(self, size: int):
        self.size = size
        self._up = self._down = np.ones(1, np.uint64)

    def word_hashes(self, block: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word of a block that ends in a blank."""
        raw = np.frombuffer(block.lower(), np.uint8)
        if len(raw) >= len(self._up):
            self._up = _powers(_BASE, len(raw) + 1)
            self._down = _powers(_UNBASE, len(raw) + 1)
        blank = np.concatenate(([True], _BLANK[raw]))
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        start, end = edge[::2], edge[1::2]
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * self._up[:len(raw)], out=total[1:])
        return start, mix64((total[end] - total[start]) * self._down[start])

    def sets(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(hashes, bounds)``: the set of text i is ``hashes[bounds[i]:bounds[i + 1]]``.

        A text with fewer words than ``size`` has its whole word sequence as its only
        shingle; one without words has none.
        """
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        start, word = self.word_hashes(b" ".join([*texts, b""]))
        n_texts = len(texts)
        of = np.searchsorted(ends, start, side="right")
        count = np.bincount(of, minlength=n_texts)
        first = np.concatenate(([0], np.cumsum(count)))
        left = first[of + 1] - np.arange(len(of))  # words from here to the text's end
        acc = word.copy()
        for j in range(1, self.size):
            acc *= np.uint64(_PLACE[0])
            more = np.flatnonzero(left > j)
            acc[more] += word[more + j] ^ np.uint64(_PLACE[1])
        whole = left >= self.size
        short = (count < self.size)[of] & (np.arange(len(of)) == first[of])
        at = np.flatnonzero(whole | short)
        value, doc = mix64(acc[at] + np.uint64(1)), of[at]
        order = np.lexsort((value, doc))
        value, doc = value[order], doc[order]
        fresh = np.ones(len(value), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        value, doc = value[fresh], doc[fresh]
        bounds = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n_texts))))
        return value, bounds


def blocks(texts: Sequence[bytes], limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together, one text at least."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield begin, i
            begin, held = i, 0
        held += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def _permute32(x: np.ndarray, spare: np.ndarray) -> None:
    """A bijection on 32 bits, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor:
            np.multiply(x, np.uint32(factor), out=x)


def circulant_signatures(value: np.ndarray, bounds: np.ndarray, coordinates: int,
                         piece: int = 1 << 15) -> np.ndarray:
    """Circulant MinHash: one row of ``coordinates`` minima per set.

    A first permutation of the 32-bit universe breaks up structure; the second one is
    shifted circularly by 1, 2, ... to give all coordinates. Rows of empty sets are all ones.
    """
    out = np.full((len(bounds) - 1, coordinates), 0xFFFFFFFF, np.uint32)
    sigma = (value >> np.uint64(32)).astype(np.uint32)
    sigma ^= np.uint32(0x5BD1E995)
    _permute32(sigma, np.empty_like(sigma))
    row = np.flatnonzero(np.diff(bounds) > 0)
    size = np.diff(bounds)[row]
    begin = 0
    while begin < len(row):  # sets of about ``piece`` shingles together stay in cache
        end = begin + max(1, int(np.searchsorted(np.cumsum(size[begin:begin + piece]), piece)))
        rows = row[begin:end]
        x = sigma[bounds[rows[0]]:bounds[rows[-1] + 1]]
        starts = bounds[rows] - bounds[rows[0]]
        shifted, spare = np.empty_like(x), np.empty_like(x)
        for k in range(coordinates):
            np.subtract(x, np.uint32(k + 1), out=shifted)
            _permute32(shifted, spare)
            out[rows, k] = np.minimum.reduceat(shifted, starts)
        begin = end
    return out
