"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a stretch of consecutive words with smallest period ``q``, long enough, that no
neighbouring word extends. Texts of a batch lie one behind the other, each closed by a
number of its own. Of all suffixes only those at places of a difference cover are sorted:
any two places reach places of the cover after the same few words, so their common
extension is those words, compared one by one, and a range minimum over the sorted
suffixes' common prefixes. For every period the places of a grid of that width ask for the
extension one period on; a run as long as four periods holds such a place, and its start is
found by bisection.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from fleetlens.llm.common import text_of

# Every difference modulo 31 is one between two of these places.
SPAN = 31
COVER = (1, 5, 11, 24, 25, 27)
#: A run covers so many periods and so many words at least.
PERIODS, WORDS = 4, 6
#: Words of a batch of texts, and grid places asked about at once; a longer text is a batch.
BATCH_WORDS, GRID = 200_000, 1_000_000

RUNS = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:binary>"


def _meeting() -> np.ndarray:
    """Steps after which two places, by their remainders, are both in the cover."""
    inside = np.isin(np.arange(2 * SPAN) % SPAN, COVER)
    return np.array([[next(s for s in range(SPAN) if inside[a + s] and inside[b + s])
                      for b in range(SPAN)] for a in range(SPAN)])


_MEETING = _meeting()
_AT = np.full(SPAN, -1)
_AT[list(COVER)] = np.arange(len(COVER))


def _equal_words(words: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many words from ``i`` and ``j`` on are equal, up to ``limit``."""
    out = np.zeros(len(i), np.int64)
    live, k = np.flatnonzero(limit > 0), 0
    while len(live):
        live = live[words[i[live] + k] == words[j[live] + k]]
        k += 1
        out[live] = k
        live = live[limit[live] > k]
    return out


def _refine(names: np.ndarray, shared: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order the ``shared`` suffixes of equal name by ``key``: a name is the number of smaller
    suffixes. Returns those that still share a name."""
    order = np.lexsort((key, names[shared]))
    shared, key = shared[order], key[order]
    old = names[shared]
    group = np.r_[True, old[1:] != old[:-1]]
    first = group | np.r_[True, key[1:] != key[:-1]]
    at = np.arange(len(shared))
    names[shared] = (old + np.maximum.accumulate(np.where(first, at, 0))
                     - np.maximum.accumulate(np.where(group, at, 0)))
    size = np.diff(np.append(np.flatnonzero(first), len(shared)))
    return shared[np.repeat(size > 1, size)]


class CommonExtensions:
    """Of places in ``words`` (numbers from 1 on; the last occurs once)."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = np.concatenate([words, np.zeros(2 * SPAN, words.dtype)])
        places = (np.arange(n // SPAN + 1)[:, None] * SPAN + np.array(COVER)).ravel()
        self.places = places[:np.searchsorted(places, n)]
        names, levels = self._sorted_suffixes()
        self.rank = names
        self.table = self._minima(self._common_prefixes(np.argsort(names), levels))

    def _sorted_suffixes(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Ranks of the suffixes, and their names by the first 31, 62, 124, ... words."""
        m = len(self.places)
        names, shared = np.zeros(m, np.int64), np.arange(m)
        bits = int(self.words.max(initial=1)).bit_length()
        at_once = max(1, 62 // bits)
        for lo in range(0, SPAN, at_once):
            if not len(shared):
                break
            key = np.zeros(len(shared), np.int64)
            for k in range(lo, min(lo + at_once, SPAN)):
                key = (key << bits) | self.words[self.places[shared] + k]
            shared = _refine(names, shared, key)
        levels, step = [names.astype(np.int32)], len(COVER)
        while len(shared):
            after = shared + step
            key = np.where(after < m, levels[-1][np.minimum(after, m - 1)], -1)
            shared = _refine(names, shared, key)
            levels.append(names.astype(np.int32))
            step *= 2
        return names, levels

    def _common_prefixes(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each suffix and the next one in order."""
        m = len(order)
        i, j = order[:-1].copy(), order[1:].copy()
        out = np.zeros(max(m - 1, 0), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            live = np.flatnonzero((i < m) & (j < m))
            live = live[levels[level][i[live]] == levels[level][j[live]]]
            out[live] += SPAN << level
            i[live] += len(COVER) << level
            j[live] += len(COVER) << level
        at = [(x // len(COVER)) * SPAN + np.array(COVER)[x % len(COVER)] for x in (i, j)]
        rest = np.full(len(out), SPAN)
        for x in at:  # behind the end is nothing
            rest = np.minimum(rest, np.maximum(len(self.words) - x, 0))
        return (out + _equal_words(self.words, *at, rest)).astype(np.int32)

    @staticmethod
    def _minima(prefixes: np.ndarray) -> list[np.ndarray]:
        table = [prefixes]
        while len(table[-1]) > 1 << (len(table) - 1):
            half, last = 1 << (len(table) - 1), table[-1]
            table.append(np.minimum(last[:-half], last[half:]))
        return table

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and from ``j > i`` on are equal."""
        ahead = _MEETING[i % SPAN, j % SPAN]
        out = _equal_words(self.words, i, j, ahead)
        on = np.flatnonzero(out == ahead)
        a, b = (self.rank[(x // SPAN) * len(COVER) + _AT[x % SPAN]]
                for x in (i[on] + ahead[on], j[on] + ahead[on]))
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        least = np.zeros(len(on), np.int64)
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            least[of] = np.minimum(self.table[k][lo[of]], self.table[k][hi[of] - (1 << int(k))])
        out[on] += least
        return out


def _grid_runs(lce: CommonExtensions, first: np.ndarray, i: np.ndarray, q: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of runs whose first grid place is among ``i``."""
    for k in range(3):  # an extension of 2q + 1 words has three
        same = np.flatnonzero(lce.words[i + k] == lce.words[i + q + k])
        first, i, q = first[same], i[same], q[same]
    ahead = lce.between(i, i + q)
    far = np.flatnonzero(ahead > (PERIODS - 2) * q)
    first, i, q, ahead = first[far], i[far], q[far], ahead[far]
    before = np.flatnonzero(i - q >= first)
    later = before[lce.between(i[before] - q[before], i[before]) >= q[before]]
    new = np.delete(np.arange(len(i)), later)
    first, i, q, ahead = first[new], i[new], q[new], ahead[new]
    lo, hi = np.zeros(len(i), np.int64), np.minimum(q - 1, i - first)
    while (open_ := np.flatnonzero(lo < hi)).size:
        back = (lo[open_] + hi[open_] + 1) // 2
        start = i[open_] - back
        fits = lce.between(start, start + q[open_]) >= back
        lo[open_[fits]] = back[fits]
        hi[open_[~fits]] = back[~fits] - 1
    length = lo + q + ahead
    long = length >= np.maximum(WORDS, PERIODS * q)
    return (i - lo)[long], length[long], q[long]


def batch_runs(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, length, period`` of all runs of texts given as word numbers (from 1 on),
    by text, start and period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    top = max((int(t.max(initial=0)) for t in texts), default=0)
    words = np.empty(int(sizes.sum()) + len(texts), np.int64)
    for n, (at, text) in enumerate(zip(first, texts)):
        words[at:at + len(text)] = text
        words[at + len(text)] = top + 1 + n
    found = [np.zeros((3, 0), np.int64)]
    widths = np.where(sizes >= WORDS, np.maximum(sizes // PERIODS, 1), 0)
    if widths.any():
        lce = CommonExtensions(words)
        text = np.repeat(np.arange(len(texts)), widths)
        q = np.arange(len(text)) - np.repeat(np.cumsum(widths) - widths, widths) + 1
        places = (sizes[text] - 1) // q  # with a whole step behind them
        ends = np.cumsum(places)
        lo = 0
        while lo < len(q):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + GRID)))
            each = np.repeat(np.arange(lo, hi), places[lo:hi])
            turn = np.arange(len(each)) - (ends[each] - places[each] - done)
            start = first[text[each]]
            found.append(np.array(_grid_runs(lce, start, start + turn * q[each], q[each])))
            lo = hi
    start, length, period = np.concatenate(found, 1)
    # Multiples of a period have the same stretch.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][:len(start)]
    start, length, period = start[least], length[least], period[least]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(first, start, "right") - 1
    return text, start - first[text], length, period


def _batches(texts: list[bytes | None]):
    """Texts as lists of words, in batches."""
    batch, size = [], 0
    for text in texts:
        words = (text or b"").split()  # at space and 0x09-0x0D only
        if batch and size + len(words) > BATCH_WORDS:
            yield batch
            batch, size = [], 0
        batch.append(words)
        size += len(words)
    if batch:
        yield batch


def _struct(texts: list[bytes | None]) -> pa.StructArray:
    sizes, columns, collapsed = [], [], []
    for batch in _batches(texts):
        number: dict[bytes, int] = {}
        coded = [np.array([number.setdefault(w, len(number) + 1) for w in words], np.int64) for words in batch]
        text, start, length, period = batch_runs(coded)
        sizes.append(np.bincount(text, minlength=len(batch)))
        columns.append((start, length, period))
        bounds = np.searchsorted(text, np.arange(len(batch) + 1))
        for n, words in enumerate(batch):
            lo, hi = bounds[n], bounds[n + 1]
            if lo < hi:
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, start[lo:hi] + period[lo:hi], 1)
                np.add.at(depth, start[lo:hi] + length[lo:hi], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
            collapsed.append(b" ".join(words))
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes or [[]]))]).astype(np.int32)
    numbers = [pa.array(np.concatenate([c[k] for c in columns] or [[]]).astype(np.int64)) for k in range(3)]
    runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        numbers, ["start", "length", "period"]))
    return pa.StructArray.from_arrays([runs, pa.array(collapsed, pa.binary())], ["runs", "collapsed"])


def periodic_runs(text_col: str | Column = "text") -> Column:
    """``struct<runs: array<struct<start, length, period>>, collapsed: binary>`` of a whole text.

    ``runs`` has every run of at least four periods and six words, in words from 0 on, by
    start and period; ``collapsed`` is the UTF-8 text of the words that no run has after its
    first period, with one space between them. Null and empty texts have no run and an empty
    text. A text depends on no other, so ids, ties, repeated rows and further columns do not
    matter. A text of any length is worked on as a whole, in memory of about its words times
    the logarithm of their number.
    """
    @F.arrow_udf(RUNS)
    def find(texts: pa.Array) -> pa.Array:
        return _struct(texts.to_pylist())

    return find(text_of(text_col).cast("binary"))


def strongest(runs: str | Column) -> Column:
    """The run with the greatest length / period, exactly; of equals the one that starts first
    and then the one with the smaller period. Null without a run."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.aggregate(runs, F.lit(None).cast(kind), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
