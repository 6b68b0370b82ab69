"""Words and hashes of whole Arrow batches of texts.

A batch is handled in slices of whole documents of about ``SLICE_BYTES``, so memory follows the
slice (or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 18

_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACES = b" \t\n\x0b\x0c\r"


def id_and_text(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names; null text is empty text."""
    return df.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )


def fold(id_column: str, parts: int):
    """The fold of a row: crc32 of its id as text, modulo ``parts``. A null id counts as empty."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts


def sample_of(df: DataFrame, rows: int) -> DataFrame:
    """All of a table with at most so many rows, else about so many, each row by its own chance.

    Copies are drawn one by one, so a busy text or key cannot fill the sample.
    """
    count = df.count()
    return df if count <= rows else df.where(F.rand(17) < rows / count)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins and the last one ends."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    begins = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[begins[0] : begins[-1]]
    return raw, begins - begins[0]


def slices(begins: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents of about SLICE_BYTES together; a longer document is a run by itself."""
    first, count = 0, len(begins) - 1
    while first < count:
        last = int(np.searchsorted(begins, begins[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _codes() -> np.ndarray:
    """A random 64-bit value per byte, the same for A-Z as for a-z."""
    codes = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
    codes[65:91] = codes[97:123]
    return codes


CODES = _codes()
WORD_OF_SPACES = np.ones(256, bool)
WORD_OF_SPACES[list(_SPACES)] = False
WORD_OF_ALNUM = np.zeros(256, bool)
WORD_OF_ALNUM[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
WORD_OF_ALNUM[128:] = True

_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        size = max(size, SLICE_BYTES + 1)
        for at, base in enumerate((_BASE, pow(_BASE, -1, _MASK + 1))):
            steps = np.full(size, _U(base))
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers


def hash_words(
    data: np.ndarray, begins: np.ndarray, is_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every word's begin, end and 64-bit hash, and the number of words before each document.

    Letters A-Z hash as a-z. No word crosses the border of two documents.
    """
    size = len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, _U), np.zeros(len(begins), np.int64)
    word = is_word[data]
    before, after = np.zeros(size, bool), np.zeros(size, bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[begins[:-1][begins[:-1] < size]] = False
    after[begins[1:][begins[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    power, inverse = _power_tables(size + 1)
    summed = np.zeros(size + 1, _U)
    np.cumsum(CODES[data] * power[:size], out=summed[1:])
    hashes = mix((summed[ends] - summed[starts]) * inverse[starts])
    return starts, ends, hashes, np.searchsorted(starts, begins)


def hash_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` words, by the place of its first word."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, _U)
    total = np.full(count, _U(width))
    for at in range(width):
        total = total * _U(_BASE) + hashes[at : at + count]
    return mix(total)
