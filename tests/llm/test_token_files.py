"""Token ids against the tokenizers library: encoding, the store and packing."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import ODD, documents, workers  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, token_store
from tidemark.llm.vocabulary import Encoder, default_path
from tidemark.session import work_dir

TEXT = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(list(" \n\t.,'!ab　\x85"))))


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(default_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_encoder_equals_the_library(library, text):
    encoder = Encoder.of(default_path())
    for _ in range(2):  # the second time from memory
        assert np.frombuffer(encoder(text), "<u4").tolist() == library(text)


@pytest.mark.parametrize("text", [
    "", " ", "  a   b \n\n c\t\td  ", "don't can't 'll", "x<|endoftext|>y", "<|endoftext|>", " <|endoftext|> \n<|endoftext|>", "<|endoftext| >", "\n a\n b \n  c",
    "a b\n", "a　 b", "foo, bar. BAZ!! qux### (x) a'b, 12, a1", "the " * 1000, "é,\nü. ﬀ",
])
def test_encoder_on_divided_texts(library, text):
    assert np.frombuffer(Encoder.of(default_path())(text), "<u4").tolist() == library(text)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_perfect_hash_is_minimal(keys):
    keys = np.array(sorted(keys), np.int64)
    slots = token_store.Mphf.build(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_perfect_hash_of_many_keys_refuses_most_others():
    keys = np.arange(0, 200_000, 2, dtype=np.int64)
    mphf = token_store.Mphf.build(keys)
    assert np.array_equal(np.sort(mphf.slots(keys)), np.arange(len(keys)))
    bits = 64 * len(mphf.words) / len(keys)
    assert bits < 8
    order = np.argsort(mphf.slots(keys))
    prints = token_store.fingerprint(keys[order])
    others = keys + 1
    slots = mphf.slots(others)
    known = slots >= 0
    known[known] = prints[slots[known]] == token_store.fingerprint(others)[known]
    assert known.sum() <= 1


@pytest.mark.parametrize("parts", [1, 5])
def test_store_gives_back_every_document(spark, documents, library, parts):
    rows = [*ODD, *((100 - i, f"text number {i}") for i in range(60)),
            *((50, f"busy {i}") for i in range(30))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        store = token_store.write_store(
            documents(*rows), work_dir(spark, "tokens"), default_path()
        )
        got = token_store.lookup(store, documents(*rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ids = lambda text: np.array([*library(text), 0], "<u4").tobytes()
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in got) == sorted(
        (str(key), ids(text)) for key, text in rows
    )
    at = 0
    for row in sorted(got, key=lambda r: r.start):  # without gaps, in ascending order of id
        assert row.start == at and row.n_tokens * 4 == len(row.ids)
        assert row.ids_crc32 == zlib.crc32(bytes(row.ids))
        at += row.n_tokens
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))


def test_unknown_keys_and_empty_store(spark, documents):
    store = token_store.write_store(documents((1, "a")), work_dir(spark, "t"), default_path())
    assert token_store.lookup(store, documents((2, ""), (None, ""))).collect() == []
    empty = token_store.write_store(documents(), work_dir(spark, "t"), default_path())
    assert token_store.lookup(empty, documents((1, ""))).collect() == []


def test_files_of_lost_attempts_are_not_read(spark, documents):
    folder = work_dir(spark, "tokens")
    token_store.write_store(documents((1, "lost")), folder, default_path())
    store = token_store.write_store(documents((1, "kept")), folder, default_path())
    (row,) = token_store.lookup(store, documents((1, ""))).collect()
    assert row.start == 0 and Tokenizer.from_file(default_path()).decode(
        np.frombuffer(bytes(row.ids), "<u4")[:-1].tolist()) == "kept"


# Packing.

@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_bins_hold_everything_and_swaps_only_help(lengths):
    bins = packing.Bins(lengths, 40)
    before, squares = len(bins.items), sum((40 - f) ** 2 for f in bins.free)
    bins.improve()
    assert sorted(i for items in bins.items for i in items) == list(range(len(lengths)))
    for items, free in zip(bins.items, bins.free, strict=True):
        assert sum(lengths[i] for i in items) == 40 - free and free >= 0
    used = sum(map(bool, bins.items))
    assert -(-sum(lengths) // 40) <= used <= before
    assert sum((40 - f) ** 2 for f in bins.free) >= squares


def fewest(lengths, capacity):
    """The least number of bins, by trying all."""
    best = len(lengths)

    def place(at, free):
        nonlocal best
        if len(free) >= best:
            return
        if at == len(lengths):
            best = len(free)
            return
        for k in {f: k for k, f in enumerate(free) if f >= lengths[at]}.values():
            place(at + 1, [*free[:k], free[k] - lengths[at], *free[k + 1 :]])
        place(at + 1, [*free, capacity - lengths[at]])

    place(0, [])
    return best


def test_swaps_empty_a_bin_that_best_fit_needs():
    lengths = [10, 10, 9, 8, 7, 5, 5, 4, 3, 2]
    bins = packing.Bins(lengths, 16)
    assert len(bins.items) == 5 and fewest(lengths, 16) == 4
    bins.improve()
    assert sum(map(bool, bins.items)) == 4


@pytest.mark.parametrize("lengths", [[300, 350, 420], [341, 342, 345, 400, 512, 513]])
def test_search_goes_on_while_exchanges_help(lengths):
    rng = np.random.default_rng(3)
    bins = packing.Bins(rng.choice(lengths, 3000).tolist(), 1024)
    before = len(bins.items)
    bins.improve()
    assert sum(map(bool, bins.items)) < before - 30


def test_number_of_bins_is_near_the_least():
    rng = np.random.default_rng(5)
    before = after = 0
    for _ in range(500):
        lengths = rng.integers(2, 11, 10).tolist()
        bins, least = packing.Bins(lengths, 16), fewest(sorted(lengths, reverse=True), 16)
        before += len(bins.items) - least
        bins.improve()
        after += sum(map(bool, bins.items)) - least
    assert 2 * after < before


def test_cut():
    assert packing.cut(5, 10) == [(0, 5)]
    assert packing.cut(10, 10) == [(0, 10)]
    assert packing.cut(25, 10) == [(0, 5), (5, 15), (15, 25)]


def test_packed_pieces_are_the_documents(spark, documents, library):
    rows = [*ODD, *((100 + i, "some text " * (i * 7)) for i in range(120))]
    packed = packing.pack_documents(documents(*rows), default_path()).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for row in packed:
        sequences[row.sequence_id].append(row)
        pieces[row.doc_id].append(row)
    for own in sequences.values():
        at = 0
        for row in sorted(own, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= 1024
    texts = defaultdict(list)
    for key, text in rows:
        texts[key].append(np.array([*library(text), 2], "<u4"))
    for key, own in pieces.items():
        expected = sorted(
            (number, low, high - low, zlib.crc32(ids[low:high].tobytes()))
            for ids in texts[key] for number, (low, high) in enumerate(packing.cut(len(ids), 1024))
        )
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in own) == expected
    total = sum(row.length for row in packed)
    assert len(sequences) <= total / 1024 * 1.1 + 1
    assert packing.pack_documents(documents(), default_path()).collect() == []


def test_tasks_pack_apart(spark, documents):
    rows = [(i, f"text {i}") for i in range(40)]
    packed = packing.pack_documents(documents(*rows).repartition(3), default_path())
    assert packed.count() == 40 and packed.agg(F.max("offset")).first()[0] < 1024
