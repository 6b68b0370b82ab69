"""Searches against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
from cases import ODD, documents, workers  # noqa: F401

from tidemark.llm import batches, bitslices

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def expected(rows, items, top=10):
    bags = [(i, Counter(terms(text))) for i, text in rows]
    n_docs = sum(1 for _, bag in bags if bag)
    total = sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, Counter()).update(terms(text))
    found = []
    for item, query in wanted.items():
        scored = []
        for i, bag in bags:
            if not bag:
                continue
            m = 100 - 75 + (75 * sum(bag.values()) * n_docs) // total
            score = sum(
                often * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t, often in query.items() if t in bag)
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        found += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(scored[:top], 1)]
    return sorted(found, key=str)


def searched(spark, rows, items):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rank int")
    asked = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, term string")
    hits = bitslices.search(bitslices.build_index(df.repartition(3)), df, asked)
    assert hits.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, hits.collect()), key=str)


def corpus(seed, size):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["The", "É", "日本", "x-y"]
    weight = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(draw.choices(words, weight, k=draw.choice((1, 5, 40, 400)))))
            for i in range(size)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # copies, so equal scores
    items = [(i, " ".join(draw.choices(words, weight, k=draw.choice((1, 3, 30))))) for i in range(30)]
    return rows, items


def test_equals_plain_scoring(spark):
    rows, items = corpus(5, 600)
    items += [(50, rows[3][1]), (51, ""), (52, None), (53, "no such"), (50, "w1 w1"), (None, "w2")]
    assert searched(spark, rows, items) == expected(rows, items)


def test_odd_rows_and_many_small_runs(spark, monkeypatch):
    rows, items = corpus(6, 40)
    rows += [*ODD, (7, "w1"), (7, "w1"), (None, "w1 w2 w1"), (None, "w3")]
    items += [(60, "one word"), (61, "same ROW twice"), (62, "id at all no"), (63, "x" * 100_000)]
    monkeypatch.setattr(bitslices, "TERMS", 100)
    monkeypatch.setattr(bitslices, "QUERIES", 3)
    assert searched(spark, rows, items) == expected(rows, items)


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []


def test_bounds_never_fall_below_scores():
    """Also where signatures are full and the bounds loose."""
    draw = random.Random(3)
    rows = [(i, " ".join(f"w{draw.randrange(400)}" for _ in range(draw.choice((5, 300)))))
            for i in range(64)]
    raw = np.frombuffer("".join(text for _, text in rows).encode(), np.uint8)
    begins = np.cumsum([0, *(len(text) for _, text in rows)])
    found, owners, often, lengths = bitslices._terms_of(raw, begins)
    blocks = bitslices._Blocks()
    for i, _ in rows:
        mine = owners == i
        codes = [c for _, c in bitslices._entries(found[mine], often[mine])]
        blocks.open.setdefault(256, []).append((i, int(lengths[i]), np.concatenate(codes)))
    width, ids, sizes, slices, _, _ = blocks.block(256)
    vocabulary = np.unique(found)
    queries = bitslices.Queries(
        vocabulary, np.arange(len(vocabulary)), np.array([0]), np.array([0, len(vocabulary)]),
        np.arange(len(vocabulary)), np.ones(len(vocabulary), np.int64), 64, int(lengths.sum()))
    block = {"width": width, "ids": ids, "lengths": sizes, "slices": slices}
    (_, bounds), = bitslices._bounds(queries, block)
    for i, _ in rows:
        mine = owners == i
        m = queries.lengths_part(lengths[i])
        score = sum(int(np.searchsorted(vocabulary, t)) * int(bitslices._part(n, m))
                    for t, n in zip(found[mine], often[mine]))
        assert bounds[0][i] >= score > 0


def test_the_index_excludes_documents(spark):
    """Exact scoring is for few documents: those that the bounds leave."""
    rows = [(i, " ".join(f"w{(i * 31 + k * 7) % 5000}" for k in range(50))) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = bitslices.build_index(df)
    assert index.documents == 4000 and index.terms == 200_000
    widths = {r.width for r in index.blocks.select("width").collect()}
    assert widths == {bitslices.BITS << 6}
    left = []
    original = bitslices._rescored

    def counting(texts, pairs, shared):
        left.append(pairs.count())
        return original(texts, pairs, shared)

    bitslices._rescored = counting
    try:
        items = spark.createDataFrame([(0, rows[9][1])], "item_id long, text string")
        found = bitslices.search(index, df, items).collect()
    finally:
        bitslices._rescored = original
    assert [r.doc_id for r in sorted(found, key=lambda r: r.rank)][0] == 9
    assert left[0] == 10 and 10 <= left[1] < 200


def test_ladder_and_slices():
    assert list(bitslices.LADDER[:8]) == [1, 2, 3, 4, 6, 8, 12, 16]
    rows = bitslices._rows_of(batches.mix(np.arange(100, dtype=np.uint64)), 512)
    assert rows.shape == (100, bitslices.SLICES) and rows.min() >= 0 and rows.max() < 512
