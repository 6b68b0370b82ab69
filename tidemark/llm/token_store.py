"""Token ids on disk, found by document key through a minimal perfect hash.

Documents are ordered by key and encoded where they are written. A shard is a file of raw ids, then
the keys and the first id of its documents. The index is cut by a hash of the key; each cut is one
file with a minimal perfect hash of its keys, a fingerprint per slot, and where the key's documents
lie. A lookup reads one slot, then the shard at the place it names.

Shard: ``MAGIC``, id width, ids; keys (int64) and first ids (uint64, one more than documents);
number of documents, where keys begin, ``MAGIC``.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches, vocabulary
from tidemark.llm.store import NewFile, materialize, open_file

MAGIC = b"TOKSHRD1"
GAMMA = 2.0  # bits per key and level of the hash
LEVELS = 48
KEYS_PER_INDEX = 1 << 16
NO_KEY = -(1 << 63)  # stands for a null id

_U = np.uint64
_EXTENT = "key long, shard string, first_key long, record long, records long, start long, ids long"
_TAIL = "<QQ8s"


class Mphf:
    """Minimal perfect hash: every key has a slot of its own from 0 to the number of keys.

    A level is a bit array; a key whose bit no other key has is placed there, the others go to the
    next level. A slot is the number of set bits before the key's.
    """

    def __init__(self, sizes: list[int], words: np.ndarray, rest: np.ndarray):
        self.sizes, self.words, self.rest = sizes, words, rest
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = _U((level + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
        return (batches.mix(keys.view(_U) + salt) % _U(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> Mphf:
        """From distinct keys. What is left after the last level is kept as sorted keys."""
        sizes, bits, left = [], [], np.asarray(keys, np.int64)
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, int(GAMMA * len(left) + 63) // 64 * 64)
            place = cls._place(left, level, size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[place]]
        packed = np.packbits(np.concatenate([np.zeros(0, bool), *bits]), bitorder="little")
        return cls(sizes, packed.view(_U), np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot, or -1, for a key that was not in the set."""
        keys = np.asarray(keys, np.int64)
        slots = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + self._place(keys[open_], level, size)
            word, bit = at >> 6, (at & 63).astype(_U)
            held = (self.words[word] >> bit) & _U(1) == 1
            below = self.words[word] & ((_U(1) << bit) - _U(1))
            slots[open_[held]] = (self.before[word] + np.bitwise_count(below))[held]
            open_ = open_[~held]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            found = self.rest[at] == keys[open_]
            slots[open_[found]] = self.before[-1] + at[found]
        return slots


def fingerprint(keys: np.ndarray) -> np.ndarray:
    mixed = batches.mix(np.asarray(keys, np.int64).view(_U) ^ _U(0xA0761D6478BD642F))
    return (mixed >> _U(32)).astype(np.uint32)


class Index(NamedTuple):
    """One cut of the index: slots to extents, an extent being a key's documents in one shard."""

    hash: Mphf
    fingerprints: np.ndarray
    first: np.ndarray
    extents: np.ndarray  # shard number, record, records
    shards: list[str]

    @classmethod
    def build(cls, rows: pd.DataFrame) -> Index:
        rows = rows.sort_values(["key", "first_key", "shard", "record"], kind="stable")
        keys, first = np.unique(rows["key"].to_numpy(), return_index=True)
        names = sorted(set(rows["shard"]))
        number = rows["shard"].map({name: i for i, name in enumerate(names)}).to_numpy()
        mphf = Mphf.build(keys)
        order = np.argsort(mphf.slots(keys))
        many = np.diff(np.append(first, len(rows)))[order]
        starts = np.concatenate([[0], np.cumsum(many)]).astype(np.int64)
        source = np.repeat(first[order] - starts[:-1], many) + np.arange(len(rows))
        table = np.stack([number, rows["record"].to_numpy(), rows["records"].to_numpy()], 1)
        return cls(mphf, fingerprint(keys[order]), starts, table[source].astype(np.int64), names)

    def to_bytes(self) -> bytes:
        arrays = [self.hash.words, self.hash.rest, self.fingerprints, self.first, self.extents]
        head = json.dumps({
            "sizes": self.hash.sizes, "shards": self.shards,
            "arrays": [[str(x.dtype), list(x.shape)] for x in arrays],
        }).encode()
        return struct.pack("<Q", len(head)) + head + b"".join(x.tobytes() for x in arrays)

    @classmethod
    def from_bytes(cls, data: bytes) -> Index:
        size = struct.unpack_from("<Q", data)[0]
        head = json.loads(data[8 : 8 + size])
        arrays, at = [], 8 + size
        for kind, shape in head["arrays"]:
            count = int(np.prod(shape))
            arrays.append(np.frombuffer(data, kind, count, at).reshape(shape))
            at += arrays[-1].nbytes
        words, rest, prints, first, extents = arrays
        return cls(Mphf(head["sizes"], words, rest), prints, first, extents, head["shards"])

    def find(self, key: int) -> list[tuple[str, int, int]]:
        """Shard, first record and number of records of a key; nothing for an unknown key."""
        return next(self.find_all(np.array([key], np.int64)))

    def find_all(self, keys: np.ndarray) -> Iterator[list[tuple[str, int, int]]]:
        slots = self.hash.slots(keys)
        known = (slots >= 0) & (slots < len(self.fingerprints))
        known[known] = self.fingerprints[slots[known]] == fingerprint(keys)[known]
        for slot, held in zip(slots.tolist(), known.tolist(), strict=True):
            part = self.extents[self.first[slot] : self.first[slot + 1]].tolist() if held else []
            yield [(self.shards[number], record, records) for number, record, records in part]


def _write(folder: str, path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.Encoder.of(path)
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        shard, keys, firsts = None, [], [0]
        for batch in rows:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if shard is None:
                    shard = NewFile(folder, ".ids")
                    shard.write(MAGIC + struct.pack("<Q", width))
                ids = encoder(text.as_py()) + end
                shard.write(ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes())
                keys.append(key)
                firsts.append(firsts[-1] + len(ids) // 4)
        if shard is None:
            return
        at = shard.write(np.array(keys, "<i8").tobytes())
        first = np.array(firsts, "<u8")
        shard.write(first.tobytes())
        shard.write(struct.pack(_TAIL, len(keys), at, MAGIC))
        shard.close()
        names, record, records = np.unique(
            np.array(keys, np.int64), return_index=True, return_counts=True
        )
        start = first[record].astype(np.int64)
        count = len(names)
        yield pa.record_batch([
            pa.array(names), pa.array([shard.name] * count), pa.array(np.full(count, keys[0])),
            pa.array(record), pa.array(records), pa.array(start),
            pa.array(first[record + records].astype(np.int64) - start),
        ], ["key", "shard", "first_key", "record", "records", "start", "ids"])

    return write


class TokenStore(NamedTuple):
    """A written store: its folder, its index files by cut, and its shards in order of keys."""

    folder: str
    cuts: int
    index: DataFrame  # cut, index_file
    shards: DataFrame  # shard, base: ids of all documents in earlier shards


def _cut(cuts: int):
    return F.pmod(F.xxhash64("key"), F.lit(cuts))


def _write_index(folder: str):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        file = NewFile(folder, ".index")
        file.write(Index.build(rows).to_bytes())
        file.close()
        return pd.DataFrame({"cut": [int(rows["cut"].iloc[0])], "index_file": [file.name]})

    return build


def _keyed(df: DataFrame, id_column: str) -> DataFrame:
    return df.withColumn("key", F.coalesce(F.col(id_column), F.lit(NO_KEY)))


def write_store(
    df: DataFrame,
    folder: str,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 0,
) -> TokenStore:
    """Write the ids of every text and ``end_id`` in ascending order of id, and the index.

    Null or empty text is the end id alone. Rows without id come first, under one key. Rows with the
    same id are all kept, ordered by a hash of their texts; a busy id may fill several shards. An
    empty table has no shards. Other columns are ignored.
    """
    texts = _keyed(batches.id_and_text(df, id_column, text_column), "doc_id")
    order = ["key", "tie", "row"]
    rows = texts.select(
        "key", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row")
    )
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    written = ranged.select("key", "text").mapInArrow(_write(folder, tokenizer, end_id), _EXTENT)
    extents = materialize(written, "extents")
    # One row per shard: the only table that is ordered as a whole. Shards of one key are ordered by
    # name, as a key's shards may come in any order.
    sizes = extents.groupBy("shard").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.sum("ids").alias("ids")
    )
    bases = sizes.selectExpr(
        "shard", "sum(ids) OVER (ORDER BY low, high, shard) - ids AS base"
    )
    shards = materialize(bases, "shards")
    cuts = max(1, -(-extents.count() // KEYS_PER_INDEX))
    built = extents.withColumn("cut", _cut(cuts)).groupBy("cut").applyInPandas(
        _write_index(folder), "cut long, index_file string"
    )
    return TokenStore(folder, cuts, materialize(built, "index"), shards)


def _find(folder: str):
    def find(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, index = None, None
        for batch in rows:
            keys, files = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            edges = [0, *(i for i in range(1, len(files)) if files[i] != files[i - 1]), len(files)]
            found = []
            for low, high in zip(edges, edges[1:], strict=False):
                if low == high:
                    continue
                if files[low] != name:
                    name = files[low]
                    with open_file(folder, name) as file:
                        index = Index.from_bytes(file.read())
                part = keys[low:high]
                for key, extents in zip(part.tolist(), index.find_all(part), strict=True):
                    found.extend((key, *extent) for extent in extents)
            columns = list(zip(*found, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                ["key", "shard", "record", "records"],
            )

    return find


class Shard:
    """An open shard."""

    def __init__(self, folder: str, name: str):
        self.file = open_file(folder, name)
        size = struct.calcsize(_TAIL)
        self.file.seek(self.file.size() - size)
        self.count, self.at, magic = struct.unpack(_TAIL, self.file.read(size))
        self.file.seek(0)
        head = self.file.read(len(MAGIC) + 8)
        if magic != MAGIC or head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{name} is not a token shard")
        self.width = struct.unpack("<Q", head[len(MAGIC) :])[0]

    def _numbers(self, at: int, count: int, kind: str) -> np.ndarray:
        self.file.seek(at)
        return np.frombuffer(self.file.read(count * int(kind[2:])), kind)

    def read(self, record: int, records: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """Key, first id in the shard and ids of consecutive documents."""
        keys = self._numbers(self.at + 8 * record, records, "<i8")
        first = self._numbers(self.at + 8 * (self.count + record), records + 1, "<u8").astype(int)
        for key, low, high in zip(keys.tolist(), first, first[1:], strict=False):
            ids = self._numbers(len(MAGIC) + 8 + self.width * low, high - low, f"<u{self.width}")
            yield key, int(low), ids.astype("<u4")


def _read(folder: str, with_ids: bool):
    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, None
        for batch in rows:
            columns: list[list] = [[], [], [], [], [], []]

            def ready() -> pa.RecordBatch:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ["key", "shard", "first", "n_tokens", "ids_crc32", "ids"]
                done = pa.record_batch(
                    [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names
                )
                return done if with_ids else done.drop_columns("ids")

            for key, own, record, records in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if own != name:
                    name, shard = own, Shard(folder, own)
                for stored, first, ids in shard.read(record, records):
                    if stored != key:  # a foreign key with the fingerprint of this slot
                        continue
                    raw = ids.tobytes()
                    row = (key, name, first, len(ids), zlib.crc32(raw), raw if with_ids else None)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                if len(columns[0]) >= 1024:
                    yield ready()
                    columns = [[], [], [], [], [], []]
            yield ready()

    return read


def lookup(
    store: TokenStore, keys: DataFrame, id_column: str = "doc_id", with_ids: bool = True
) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and the ``ids`` of every stored document of the keys.

    ``start`` are the ids of all documents before it. Each distinct key is looked up once, a null
    one finds the documents without id, and unknown keys give no rows.
    """
    wanted = _keyed(keys.select(F.col(f"`{id_column}`").cast("long").alias("doc_id")), "doc_id")
    wanted = wanted.select("key").distinct().withColumn("cut", _cut(store.cuts))
    routed = wanted.join(store.index, "cut").repartition("cut").sortWithinPartitions("index_file")
    found = routed.select("key", "index_file").mapInArrow(
        _find(store.folder), "key long, shard string, record long, records long"
    )
    by_shard = found.repartition("shard").sortWithinPartitions("shard", "record")
    columns = "key long, shard string, first long, n_tokens long, ids_crc32 long"
    read = by_shard.mapInArrow(
        _read(store.folder, with_ids), columns + (", ids binary" if with_ids else "")
    )
    placed = read.join(store.shards, "shard")
    return placed.select(
        F.when(F.col("key") != NO_KEY, F.col("key")).alias("doc_id"),
        (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []),
    )
