"""Passages of a benchmark in documents: a prefix-filtered set join.

A benchmark item is cut into windows of ``width`` words, a window into short shingles. A document
that holds a window holds all its shingles, so one of them, the rarest over all documents, is enough
as its prefix: only where that shingle occurs, and where the window fits between the document's
ends, are all the window's words compared.

The benchmark is taken in blocks of bounded size, each sent to all tasks; documents never move.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches

BLOCK_BYTES = 4 << 20  # benchmark text per block; an item is never divided
FILTER_BITS = 18

_SPANS = "array<struct<begin: int, end: int>>"


class Keys(NamedTuple):
    """Sorted shingle hashes of one width, a quick filter, and per key the windows it stands for."""

    hashes: np.ndarray
    filter: np.ndarray
    first: np.ndarray
    window: np.ndarray
    offset: np.ndarray

    def at(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the hashes are keys, and which."""
        near = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[near]), len(self.hashes) - 1)
        same = self.hashes[place] == hashes[near]
        return near[same], place[same]


class Block(NamedTuple):
    """Distinct windows (word hashes, padded), their lengths and items; item names; shingles."""

    words: np.ndarray
    lengths: np.ndarray
    first_item: np.ndarray
    items: np.ndarray
    names: list[str]
    shingle: int


def _keys(hashes: np.ndarray, window: np.ndarray, offset: np.ndarray) -> Keys:
    order = np.argsort(hashes, kind="stable")
    distinct, first = np.unique(hashes[order], return_index=True)
    quick = np.zeros(1 << FILTER_BITS, bool)
    quick[(distinct >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return Keys(distinct, quick, np.append(first, len(order)), window[order], offset[order])


def _block(items: list, width: int, shingle: int) -> Block:
    names = sorted({name for name, _ in items})
    place = {name: i for i, name in enumerate(names)}
    owners: dict[tuple, set[int]] = {}
    for name, text in items:
        raw = np.frombuffer(text.encode(), np.uint8)
        begins = np.array([0, len(raw)])
        words = batches.hash_words(raw, begins, batches.WORD_OF_ALNUM)[2].tolist()
        for at in range(max(len(words) - width + 1, min(len(words), 1))):
            owners.setdefault(tuple(words[at : at + width]), set()).add(place[name])
    windows = list(owners)
    padded = np.zeros((len(windows), width), np.uint64)
    for row, window in zip(padded, windows, strict=True):
        row[: len(window)] = window
    sizes = np.array([len(owners[w]) for w in windows], np.int64)
    return Block(
        padded,
        np.array([len(w) for w in windows], np.int64),
        np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
        np.array([i for w in windows for i in sorted(owners[w])], np.int64),
        names,
        shingle,
    )


def _shingles_of(block: Block) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By shingle width: the hash, window and offset of every shingle of every window."""
    found: dict[int, list] = {}
    for window, length in enumerate(block.lengths):
        width = min(block.shingle, int(length))
        hashes = batches.hash_windows(block.words[window, :length], width)
        found.setdefault(width, []).append(
            (hashes, np.full(len(hashes), window), np.arange(len(hashes)))
        )
    return {
        width: tuple(np.concatenate(x) for x in zip(*parts, strict=True))
        for width, parts in found.items()
    }


def _words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes and words before each document, slice by slice."""
    raw, begins = batches.text_bytes(column)
    for first, last in batches.slices(begins):
        low = begins[first]
        _, _, words, at = batches.hash_words(
            raw[low : begins[last]], begins[first : last + 1] - low, batches.WORD_OF_ALNUM
        )
        yield words, at


def _count(keys: dict[int, Keys]):
    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {width: np.zeros(len(k.hashes), np.int64) for width, k in keys.items()}
        for batch in rows:
            for words, _ in _words(batch.column(0)):
                for width, own in keys.items():
                    _, place = own.at(batches.hash_windows(words, width))
                    totals[width] += np.bincount(place, minlength=len(own.hashes))
        for width, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.record_batch([
                pa.array(np.full(len(seen), width, np.int32)), pa.array(seen.astype(np.int32)),
                pa.array(total[seen]),
            ], ["width", "key", "n"])

    return count


def _rarest(documents: DataFrame, block: Block) -> dict[int, Keys]:
    """One shingle per window, the one that occurs least often in all documents.

    Windows with a shingle that occurs nowhere cannot occur and get no key.
    """
    shingles = _shingles_of(block)
    keys = {width: _keys(*parts) for width, parts in shingles.items()}
    counts = {width: np.zeros(len(k.hashes), np.int64) for width, k in keys.items()}
    counted = documents.select("text").mapInArrow(_count(keys), "width int, key int, n long")
    for row in counted.groupBy("width", "key").agg(F.sum("n").alias("n")).collect():
        counts[row.width][row.key] = row.n
    chosen = {}
    for width, (hashes, window, offset) in shingles.items():
        often = counts[width][np.searchsorted(keys[width].hashes, hashes)]
        order = np.lexsort((offset, hashes, often, window))
        first = order[np.unique(window[order], return_index=True)[1]]
        first = first[often[first] > 0]
        if len(first):
            chosen[width] = _keys(hashes[first], window[first], offset[first])
    return chosen


def _occurrences(words: np.ndarray, at: np.ndarray, block: Block, keys: dict[int, Keys]):
    """Begin, window and document of every occurrence of a window."""
    starts, windows, documents = [], [], []
    for width, own in keys.items():
        position, key = own.at(batches.hash_windows(words, width))
        many = own.first[key + 1] - own.first[key]
        row = np.repeat(np.arange(len(key)), many)
        entry = own.first[key][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        window = own.window[entry]
        start = position[row] - own.offset[entry]
        length = block.lengths[window]
        document = np.searchsorted(at, position[row], "right") - 1
        fits = (start >= at[document]) & (start + length <= at[document + 1])
        start, window, length, document = start[fits], window[fits], length[fits], document[fits]
        same = np.ones(len(start), bool)
        for place in range(block.words.shape[1]):
            inside = place < length
            found = words[np.minimum(start + place, len(words) - 1)]
            same &= ~inside | (found == block.words[window, place])
        starts.append(start[same])
        windows.append(window[same])
        documents.append(document[same])
    if not starts:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(starts), np.concatenate(windows), np.concatenate(documents)


def _scan(shared):
    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys = shared.value
        names = pa.array(block.names, pa.string())
        for batch in rows:
            before = batch.column(3).to_pylist()
            counts, begins, ends, items, spans_to, items_to = [], [], [], [], [0], [0]
            done = 0
            for words, at in _words(batch.column(1)):
                start, window, document = _occurrences(words, at, block, keys)
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + block.lengths[window], -1)
                for i in range(len(at) - 1):
                    for span in before[done + i]:
                        cover[at[i] + span["begin"]] += 1
                        cover[at[i] + span["end"]] -= 1
                hit = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
                edge = np.zeros(len(words) + 1, bool)
                edge[at] = True
                opens = np.flatnonzero(hit[1:] & (~hit[:-1] | edge))
                closes = np.flatnonzero(hit[:-1] & (~hit[1:] | edge))
                owner = np.searchsorted(at, opens, "right") - 1
                begins.append(opens - at[owner])
                ends.append(closes - at[owner])
                spans_to.extend(spans_to[-1] + np.searchsorted(owner, np.arange(1, len(at))))
                many = block.first_item[window + 1] - block.first_item[window]
                entry = np.repeat(block.first_item[window] - np.cumsum(many) + many, many)
                named = block.items[entry + np.arange(len(entry))]
                pair = np.unique(np.repeat(document, many) * len(block.names) + named)
                items.append(pair % max(len(block.names), 1))
                of = pair // max(len(block.names), 1)
                items_to.extend(items_to[-1] + np.searchsorted(of, np.arange(1, len(at))))
                counts.append(np.diff(at))
                done += len(at) - 1
            join = lambda x: np.concatenate([np.zeros(0, np.int64), *x])
            spans = pa.StructArray.from_arrays(
                [pa.array(join(begins).astype(np.int32)), pa.array(join(ends).astype(np.int32))],
                ["begin", "end"],
            )
            found = pa.ListArray.from_arrays(
                pa.array(items_to, pa.int32()), names.take(pa.array(join(items), pa.int64()))
            )
            known = batch.column(4).to_pylist()
            if any(known):
                found = pa.array(
                    [sorted({*x, *y}) for x, y in zip(known, found.to_pylist(), strict=True)],
                    pa.list_(pa.string()),
                )
            yield pa.record_batch([
                batch.column(0), batch.column(1), pa.array(join(counts)),
                pa.ListArray.from_arrays(pa.array(spans_to, pa.int32()), spans), found,
            ], batch.schema.names)

    return scan


def benchmark_passages(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    width: int = 10,
    shingle: int = 3,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every row of ``documents``.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A window is
    ``width`` consecutive words of an item, or all words of a shorter item. ``spans`` are the words
    (from 0, end exclusive) inside occurrences of windows, adjacent ones joined; ``items`` the names
    of the items with an occurring window, each once.

    Null or empty text has no words and no spans; an item without words occurs nowhere; an item
    without id is called ``null``; items with the same id count as one. Every row gets its own
    result, repeated rows too; other columns are ignored. Words are compared by 64-bit hashes, all
    of a window's words each.
    """
    texts = batches.id_and_text(documents, id_column, text_column)
    found = texts.select(
        "*", F.lit(0).cast("long").alias("n_words"),
        F.expr(f"cast(array() AS {_SPANS})").alias("spans"),
        F.expr("cast(array() AS array<string>)").alias("items"),
    )
    items = _items(benchmark, item_column, item_text_column)
    for shared in _blocks(texts, items, width, shingle, block_bytes):
        found = found.mapInArrow(_scan(shared), found.schema)
    return found.drop("text")


def _items(benchmark: DataFrame, item_column: str, text_column: str) -> DataFrame:
    return benchmark.select(
        F.coalesce(F.col(f"`{item_column}`").cast("string"), F.lit("null")).alias("item"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    ).where("text IS NOT NULL")


def _blocks(texts: DataFrame, items: DataFrame, width: int, shingle: int, block_bytes: int):
    """Each block of the benchmark with its keys, sent to all tasks."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for number in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        block = _block([tuple(row) for row in own.collect()], width, shingle)
        keys = _rarest(texts, block) if len(block.lengths) else {}
        yield texts.sparkSession.sparkContext.broadcast((block, keys))


def _clean(shared, place: int):
    def clean(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys = shared.value
        for batch in rows:
            kept, done = np.ones(batch.num_rows, bool), 0
            for words, at in _words(batch.column(place)):
                kept[done + _occurrences(words, at, block, keys)[2]] = False
                done += len(at) - 1
            yield batch.filter(pa.array(kept))

    return clean


def keep_clean(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    width: int = 10,
    shingle: int = 3,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``documents`` without any passage of the benchmark, whole, a pass per block.

    Null or empty text has no passage and stays; repeated rows and rows without id are judged each;
    nulls and names of other columns make no difference. Items without words remove nothing.
    """
    texts = batches.id_and_text(documents, id_column, text_column)
    items = _items(benchmark, item_column, item_text_column)
    place = documents.columns.index(text_column)
    for shared in _blocks(texts, items, width, shingle, block_bytes):
        documents = documents.mapInArrow(_clean(shared, place), documents.schema)
    return documents


def contamination(found: DataFrame) -> DataFrame:
    """Counts and a digest of the spans and items of ``benchmark_passages``."""
    return found.select(
        "doc_id",
        "n_words",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.begin)").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
