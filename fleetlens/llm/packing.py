"""Hierarchical packing of documents into windows of several lengths.

Window lengths are powers of two. A document is cut into windows of the longest length;
its rest is routed to the tier of the shortest window that holds it. Each tier opens a
window per rest, longest tier first, and fills the gap with rests of shorter tiers: the
longest that fits, or else a cut of one. Full windows are then dealt into step groups of
one number of tokens. A task packs its own partition and holds open what is not yet full,
so nothing is shuffled, and a partition leaves at most one padded window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import text_of

TIERS = (128, 256, 512, 1024)
STEP_TOKENS = 8192
_FIELDS = [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
           ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
           ("tier", pa.int32()), ("step_group", pa.int64())]
#: A task numbers its sequences from its partition's number times this.
_SPAN = 1 << 40

Piece = tuple[int, int, int]  # document, start, length


class TierPacker:
    """Packs pieces of documents into windows; ``windows`` are full ones not yet taken."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
            raise ValueError("tiers have to be growing powers of two")
        self.tiers = tiers
        self._rests: list[list[Piece]] = [[] for _ in range(tiers[-1] + 1)]
        self._lengths = 0  # bit n: there is a rest of length n
        self.windows: list[tuple[int, list[Piece]]] = []

    def add(self, document: int, length: int) -> None:
        long = self.tiers[-1]
        for start in range(0, length - long + 1, long):
            self.windows.append((long, [(document, start, long)]))
        if length % long:
            self._put((document, length - length % long, length % long))

    def _put(self, rest: Piece) -> None:
        self._rests[rest[2]].append(rest)
        self._lengths |= 1 << rest[2]

    def _take(self, most: int) -> Piece | None:
        """The longest rest of at most ``most`` ids."""
        length = (self._lengths & ((2 << most) - 1)).bit_length() - 1
        if length < 1:
            return None
        rest = self._rests[length].pop()
        if not self._rests[length]:
            self._lengths ^= 1 << length
        return rest

    def _cut(self, size: int) -> Piece:
        """A piece of ``size`` ids off the shortest rest that is longer."""
        above = self._lengths >> (size + 1)
        length = size + (above & -above).bit_length()
        rest = self._rests[length].pop()
        if not self._rests[length]:
            self._lengths ^= 1 << length
        self._put((rest[0], rest[1] + size, length - size))
        return rest[0], rest[1], size

    def held(self) -> int:
        return sum(length * len(rests) for length, rests in enumerate(self._rests))

    def pack(self, leave: int) -> None:
        """Fill windows, longest tier first, until at most ``leave`` ids are held, which has
        to be at least the longest window less one."""
        held = self.held()
        while held > leave:
            room = self._lengths.bit_length() - 1
            tier = next(t for t in self.tiers if t >= room)
            pieces, gap = [], tier
            while gap:
                piece = self._take(gap) or self._cut(gap)
                pieces.append(piece)
                gap -= piece[2]
            self.windows.append((tier, pieces))
            held -= tier

    def finish(self) -> None:
        """Put what is left into full windows of falling lengths, and at last into one that
        is not full."""
        self.pack(self.tiers[-1] - 1)
        held = self.held()
        for tier in [*self.tiers[::-1], None]:
            size = tier or held
            if not held or held < size:
                continue
            pieces, gap = [], size
            while gap:
                piece = self._take(gap) or self._cut(gap)
                pieces.append(piece)
                gap -= piece[2]
            self.windows.append((tier or self.tiers[-1], pieces))
            held -= size


class StepGroups:
    """Deals windows to groups of ``tokens`` ids, padding counted; a group takes windows as
    long as they fit."""

    def __init__(self, tokens: int):
        self._tokens, self._open, self._next = tokens, [], 0

    def place(self, tier: int) -> int:
        for group in self._open:
            if group[1] + tier <= self._tokens:
                break
        else:
            group = [self._next, 0]
            self._next += 1
            self._open.append(group)
        group[1] += tier
        if group[1] == self._tokens:
            self._open.remove(group)
        return group[0]


def pack(docs: DataFrame, encode: Callable[[], Callable[[str], bytes]], tiers: tuple[int, ...] = TIERS,
         end_id: int = 0, step_tokens: int = STEP_TOKENS, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces of all documents: ``id_col, start, length, ids, doc_tokens, sequence_id,
    offset, tier, step_group``.

    ``encode()`` gives the function from a text to its ids (little-endian unsigned 32-bit),
    and is called once in each task; ``end_id`` is put behind every document. ``ids`` holds
    those of the piece; ``start`` counts the document's ids before it; ``offset`` those of
    the sequence before it. A sequence has as many ids as its ``tier``, but for the last
    one of a partition. Documents of a batch are packed before the next batch is read;
    what waits is less than a window.

    Null texts are empty and consist of ``end_id`` alone. Null and repeated ids are packed
    like others. Other columns are not read. No row, no piece. Sequences are numbered
    within their partition, which starts at its number times 2**40: rows that are dealt to
    partitions alike give the same sequences again.
    """
    id_type = docs.schema[id_col].dataType
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, packer, groups = encode(), TierPacker(tiers), StepGroups(step_tokens)
        base = (TaskContext.get().partitionId()) * _SPAN
        texts: dict[int, bytes] = {}  # ids of documents with a rest
        names: dict[int, object] = {}
        done = count = 0

        def rows(id_arrow: pa.DataType) -> pa.RecordBatch:
            nonlocal done
            columns: list[list] = [[] for _ in range(1 + len(_FIELDS))]
            # Long windows first: a group that is begun with them is filled up exactly.
            for tier, pieces in sorted(packer.windows, key=lambda w: -w[0]):
                group, offset = base + groups.place(tier), 0
                for document, start, length in pieces:
                    ids = texts[document]
                    for column, value in zip(columns, (
                            names[document], start, length, ids[4 * start:4 * (start + length)],
                            len(ids) // 4, base + done, offset, tier, group)):
                        column.append(value)
                    offset += length
                done += 1
            packer.windows.clear()
            left = {rest[0] for rests in packer._rests for rest in rests}
            for document in texts.keys() - left:
                del texts[document], names[document]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_arrow),
                 *(pa.array(c, t) for c, (_, t) in zip(columns[1:], _FIELDS))],
                [id_col, *(name for name, _ in _FIELDS)])

        id_arrow = None
        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    texts[count], names[count] = code(text) + end, name
                    packer.add(count, len(texts[count]) // 4)
                    count += 1
                packer.pack(tiers[-1] - 1)
                yield rows(id_arrow)
        packer.finish()
        if packer.windows:
            yield rows(id_arrow)

    schema = (f"`{id_col}` {id_type.simpleString()}, start bigint, length bigint, ids binary, "
              "doc_tokens bigint, sequence_id bigint, offset bigint, tier int, step_group bigint")
    return docs.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, schema)
