"""The manifest against a plain tree, whose levels are lists."""

import hashlib
import zlib

import pytest
from cases import ODD, documents, workers  # noqa: F401

from tidemark.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def above(nodes):
    return [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]


def folded(leaf, position, nodes):
    """The root by a changed leaf and its siblings, and the siblings."""
    siblings = []
    while len(nodes) > 1:
        other = nodes[position ^ 1 : (position ^ 1) + 1]
        siblings += other
        leaf = h(*(other + [leaf] if position % 2 else [leaf] + other))
        position, nodes = position // 2, above(nodes)
    return leaf, siblings


def value(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def expected(rows):
    """Of rows ``doc_id, source, lang, n_chars, text``, all results in a sorted list."""
    def leaf(row):
        return h(*map(value, row))

    def changed(row):
        hit = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 7 == 0
        return (*row[:3], row[3] + 1, row[4]) if hit and row[3] is not None else row

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    leaves = {name: [leaf(r) for r in groups[name]] for name in names}

    def root(nodes):
        while len(nodes) > 1:
            nodes = above(nodes)
        return nodes[0]

    subroots = [root(leaves[name]) for name in names]
    top, found = root(subroots), []
    for at, name in enumerate(names):
        for place, row in enumerate(groups[name]):
            low, first = folded(leaf(changed(row)), place, leaves[name])
            high, second = folded(low, at, subroots)
            found.append(
                (row[0], leaf(row), subroots[at], top, h(*first, *second), high, high == top)
            )
    return sorted(found, key=str)


def manifest_of(spark, rows):
    df = spark.createDataFrame(
        [(*r, 1, "x") for r in rows],
        "doc_id long, source string, lang string, n_chars long, text string, position long, grp string",
    )
    return merkle.prove(merkle.build_manifest(df, tamper="n_chars"))


@pytest.mark.parametrize("size", [1, 3, 256, 257, 700])
def test_equals_a_plain_tree(spark, size):
    rows = [(i * 5 % 997, "s", ("en", "de", None)[i % 3 if size < 600 else i % 50 == 0], i, f"t {i}")
            for i in range(size)]
    found = manifest_of(spark, rows).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows)


def test_three_levels_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    monkeypatch.setattr(merkle, "_WIDTH", 4)
    for size in (5, 16, 17, 65, 67):
        rows = [(i, "s", "en", i, "t") for i in range(size)] + [(1, "s", "é", 1, "t")]
        nodes = [h(*map(value, r)).encode() for r in rows]
        for height, count in ((2, 3), (2, 1), (None, 3), (None, 1)):
            tree = merkle.Appender()
            for node in nodes[:count]:
                tree.append(node)
            root = tree.close(height)
            for at in range(count):
                gaps = merkle._lone_steps(at, count, height)
                assert merkle.fold(nodes[at], tree.witnesses[at], gaps) == root


def test_odd_rows(spark):
    rows = [(i, None if i else "s", "", None if i == 3 else 5, text) for i, text in ODD]
    rows += [(7, "s", "en", 0, ""), (None, None, None, None, None)]
    found = manifest_of(spark, rows).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows)
    assert not all(r.verified for r in found)


def test_empty_table(spark):
    assert manifest_of(spark, []).collect() == []
