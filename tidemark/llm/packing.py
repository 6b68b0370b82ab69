"""Documents packed into sequences of a fixed length: best fit, then swaps between bins.

Documents are encoded where they lie. Full pieces are sequences by themselves; the rest, one short
piece per document at most, is packed per task in chunks of bounded size, so nothing is shuffled and
each chunk leaves a few underfull sequences at most.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm import batches, vocabulary
from tidemark.llm.store import materialize

CHUNK = 1 << 17  # pieces that are packed together

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECES}, sequence_id long, offset long"


def cut(count: int, capacity: int) -> list[tuple[int, int]]:
    """Begin and end of a document's pieces: all full, but the first may be shorter."""
    first = count % capacity
    bounds = [0, *range(first or capacity, count + 1, capacity)]
    return list(zip(bounds, bounds[1:], strict=False))


def _encode(path: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.Encoder.of(path)
        for batch in rows:
            found: list[tuple] = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encoder(text.as_py()) + end
                for number, (low, high) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * low : 4 * high])
                    found.append((doc_id.as_py(), number, low, high - low, crc))
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return encode


class Bins:
    """Bins of items, each item a length, with the free space of every bin."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.free: list[int] = []
        self._best_fit()

    def _best_fit(self) -> None:
        """Longest first, each into the bin with the least space that is enough."""
        at: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        some = 0  # bit s is set if a bin has s free
        for item in sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i]):
            length = self.lengths[item]
            large = some >> length
            if large:
                space = length + (large & -large).bit_length() - 1
                bin_ = at[space].pop()
                if not at[space]:
                    some &= ~(1 << space)
                self.items[bin_].append(item)
            else:
                space, bin_ = self.capacity, len(self.items)
                self.items.append([item])
                self.free.append(0)
            left = self.free[bin_] = space - length
            if left:
                at[left].append(bin_)
                some |= 1 << left

    def improve(self) -> None:
        """Exchange items between underfull bins, round after round, until no exchange helps.

        Every exchange takes length from a bin to one that is fuller after it, so the sum of squared
        fills grows and the search ends. The least filled bin gives first, until it is empty or
        stuck; it may give and take again in the next round. No bin can be saved, and the search
        stops, where the free space left is less than a bin.
        """
        while True:
            open_bins = [b for b, free in enumerate(self.free) if 0 < free < self.capacity]
            open_bins.sort(key=lambda b: -self.free[b])
            space = sum(self.free[b] for b in open_bins)
            if space < self.capacity:
                return
            takers = _Takers(self, open_bins)
            exchanges = 0
            for giver in open_bins:
                if space < self.capacity:
                    return
                takers.leave(giver)
                exchanges += self._empty(giver, takers)
                if not self.items[giver]:  # its own space is no longer free space in a bin
                    space -= self.capacity
            if not exchanges:
                return

    def _empty(self, giver: int, takers: _Takers) -> int:
        """Move or exchange the giver's items, the largest gain first; how often that helped."""
        exchanges = 0
        while self.items[giver]:
            one = {self.lengths[i]: (i,) for i in self.items[giver]}
            offers = self._pairs(giver)
            offers.update(one)  # rather one item than two of the same length together
            found = takers.best(offers, self.free[giver])
            if found is None:
                break
            exchanges += 1
            size, length, taker = found
            back = [next(i for i in self.items[taker] if self.lengths[i] == length)] if length else []
            self._give(giver, list(offers[size]), taker, back)
            takers.changed(taker)
        return exchanges

    def _pairs(self, giver: int) -> dict[int, tuple[int, ...]]:
        """Two items for each length that two items of the giver have together."""
        own: dict[int, list[int]] = {}
        for item in self.items[giver]:
            own.setdefault(self.lengths[item], []).append(item)
        found: dict[int, tuple[int, ...]] = {}
        for x, first in own.items():
            for y, second in own.items():
                if x < y:
                    found[x + y] = (first[0], second[0])
            if len(first) > 1:
                found[2 * x] = (first[0], first[1])
        return found

    def _give(self, giver: int, items: list[int], taker: int, back: list[int]) -> None:
        gain = sum(self.lengths[i] for i in items) - sum(self.lengths[i] for i in back)
        self.items[giver] = [i for i in self.items[giver] if i not in items] + back
        self.items[taker] = [i for i in self.items[taker] if i not in back] + items
        self.free[giver] += gain
        self.free[taker] -= gain


class _Takers:
    """Bins that may take more, by the lengths that they hold: the one with the most space first.

    Length 0 stands for nothing given back, so it has every bin.
    """

    def __init__(self, bins: Bins, open_bins: list[int]):
        self.bins, self.open = bins, set(open_bins)
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(bins.capacity + 1)]
        self.most = np.zeros(bins.capacity + 1, np.int64)
        for taker in open_bins:
            for length in self._held(taker):
                self.heaps[length].append((-bins.free[taker], taker))
        for length, heap in enumerate(self.heaps):
            heapq.heapify(heap)
            self._refresh(length)

    def _held(self, taker: int) -> set[int]:
        return {0, *(self.bins.lengths[i] for i in self.bins.items[taker])}

    def _refresh(self, length: int) -> None:
        """Drop entries that do not hold any more from the top."""
        heap, bins = self.heaps[length], self.bins
        while heap:
            space, taker = heap[0]
            if taker in self.open and -space == bins.free[taker] and length in self._held(taker):
                break
            heapq.heappop(heap)
        self.most[length] = -heap[0][0] if heap else 0

    def leave(self, taker: int) -> None:
        self.open.discard(taker)
        for length in self._held(taker):
            self._refresh(length)

    def changed(self, taker: int) -> None:
        """A bin has other items and less space than before."""
        for length in self._held(taker):
            heapq.heappush(self.heaps[length], (-self.bins.free[taker], taker))
        for length in range(len(self.heaps)):
            if self.heaps[length] and self.heaps[length][0][1] == taker:
                self._refresh(length)

    def best(self, offers: dict[int, tuple[int, ...]], giver_free: int) -> tuple[int, int, int] | None:
        """Offer, length given back and taker of the exchange with the largest gain."""
        sizes = np.array([s for s in offers if s <= 2 * self.bins.capacity])
        # For each offer and each length given back: the gain must fit into the taker's space and
        # leave it with less space than the giver has.
        gain = sizes[:, None] - np.arange(len(self.most))
        fits = (gain > 0) & (gain <= self.most) & (self.most - gain < giver_free)
        gain = np.where(fits, gain, 0)
        at = int(gain.argmax())
        if not gain.flat[at]:
            return None
        row, length = divmod(at, len(self.most))
        return int(sizes[row]), length, self.heaps[length][0][1]


def pack(lengths: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item; bins are numbered from 0 without gaps."""
    bins = Bins(lengths, capacity)
    bins.improve()
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for at, items in enumerate(x for x in bins.items if x):
        place = 0
        for item in items:
            number[item], offset[item] = at, place
            place += lengths[item]
    return number, offset


def _pack(capacity: int):
    def packed(pieces: pa.Table, first: int) -> tuple[pa.Table, int]:
        lengths = pieces.column("length").to_numpy()
        short = np.flatnonzero(lengths < capacity)
        number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        number[short], offset[short] = pack(lengths[short].tolist(), capacity)
        used = int(number.max()) + 1 if len(short) else 0
        full = np.flatnonzero(lengths == capacity)
        number[full] = used + np.arange(len(full))
        table = pieces.append_column("sequence_id", pa.array(first + number))
        return table.append_column("offset", pa.array(offset)), first + used + len(full)

    def pack_all(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        for batch in rows:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK:
                table, first = packed(pa.Table.from_batches(held), first)
                yield from table.to_batches()
                held = []
        if held:
            yield from packed(pa.Table.from_batches(held), first)[0].to_batches()

    return pack_all


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A document is its text's ids and ``end_id``. Longer documents than ``capacity`` are cut into
    pieces of that length, the first of which may be shorter; others are one piece. ``start`` is the
    piece's first id in its document, ``offset`` its place in its sequence; a sequence has no gaps.

    Null or empty text is the end id alone. Every row is packed, repeated rows, ties and rows
    without id as well; an empty table gives no rows; other columns are ignored.
    """
    texts = batches.id_and_text(df, id_column, text_column)
    pieces = materialize(texts.mapInArrow(_encode(tokenizer, end_id, capacity), _PIECES), "pieces")
    return pieces.mapInArrow(_pack(capacity), _PACKED)
