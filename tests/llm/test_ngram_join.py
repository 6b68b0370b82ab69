"""Near duplicates against comparing all pairs."""

import random
from collections import Counter

import pytest
from cases import ODD, documents, workers  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.ngram_join import keep_first, near_duplicates


def sets_of(text, width=5):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


class Groups(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def brute_force(rows, threshold=80):
    """Component of every id, and the number of shingles of every row."""
    groups, holders = Groups(), {}
    sets = [sets_of(text) for _, text in rows]
    for at, (key, _) in enumerate(rows):
        if key is not None:
            for shingle in sets[at]:
                holders.setdefault(shingle, []).append(at)
    for at, (key, _) in enumerate(rows):
        common = Counter(o for s in sets[at] for o in holders.get(s, ()) if o < at)
        for other, n in common.items() if key is not None else ():
            if 100 * n >= threshold * (len(sets[at]) + len(sets[other]) - n):
                groups.join(key, rows[other][0])
    return sorted((key if key is None else (key, len(s), groups.find(key)))
                  for (key, _), s in zip(rows, sets, strict=True) if key is not None)


def found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()
                  if r.doc_id is not None)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice("qwertyuiop") + str(rng.random())
    return words


def corpus(seed, copies=120):
    """Copies at every distance from two texts, passages that many texts share, short texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("abcdefgh")
    bases = [[word() for _ in range(n)] for n in (60, 150)]
    passage = [word() for _ in range(40)]
    texts = [" ".join(edited(rng, rng.choice(bases), rng.randrange(5))) for _ in range(copies)]
    texts += [" ".join([*passage, *(word() + str(i) for _ in range(rng.choice((3, 10, 60))))])
              for i in range(60)]
    texts += [" ".join(word() for _ in range(rng.randrange(1, 5))) for _ in range(40)]
    texts += [t.upper() for t in texts[:10]] + texts[:10] + [f"{t} tail" for t in texts[:10]]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(documents, seed):
    rows = corpus(seed)
    assert found(near_duplicates(documents(*rows))) == brute_force(rows)


def test_odd_rows(documents):
    rows = [*ODD, (8, "Same\nROW twice"), (9, "word " * 30_000), (3, "another text of the same id"),
            (10, "another text of the same id")]
    result = near_duplicates(documents(*rows))
    expected = Groups()
    expected.join(3, 10)
    expected.join(7, 8)
    expected.join(5, 9)
    assert {(i, c) for i, _, c in found(result)} == {
        (key, expected.find(key)) for key, _ in rows if key is not None
    }
    assert result.count() == len(rows)
    (lost,) = result.where("doc_id IS NULL").collect()
    assert (lost.component_id, lost.n_shingles) == (None, 1)
    kept = keep_first(documents(*rows))
    assert kept.columns == documents().columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        ["None", "0", "1", "2", "3", "4", "5", "6", "7"]
    )


def test_one_row_of_each_group_stays(documents):
    """Repeated ids, copies without id, and near copies with and without id."""
    base = [f"w{i}" for i in range(60)]
    near = [*base[:-1], "other"]
    rows = [
        (5, " ".join(base)), (5, " ".join(base)), (5, "a text of its own"),
        (None, " ".join(near)), (None, " ".join(near)),
        (None, "only copies without id here"), (None, "only copies without id here"),
        (8, "clean"), (None, None), (None, ""), (None, ""),
    ]
    kept = keep_first(documents(*rows))
    assert kept.columns == documents().columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted([
        ("5", "a text of its own"), ("8", "clean"), ("None", "only copies without id here"),
        ("None", "None"), ("None", ""), ("None", ""),
    ])
    clashing = documents(*rows).withColumnRenamed("row", "row_key").withColumnRenamed("kind", "a.b")
    again = keep_first(clashing)
    assert again.columns == clashing.columns
    assert again.count() == 6
    assert keep_first(documents()).collect() == []


def test_empty_table(documents):
    assert near_duplicates(documents()).collect() == []


def test_no_plan_node_makes_all_pairs_of_a_group(documents):
    """Five hundred near copies of one text need links in proportion to their number."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, 1))) for i in range(500)]
    result = near_duplicates(documents(*rows))
    assert {r.component_id for r in result.collect()} == {0}


def test_components_of_random_links(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(100)]
    groups = Groups()
    for a, b in links:
        groups.join(a, b)
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    expected = {x: groups.find(x) for pair in links for x in pair if pair[0] != pair[1]}
    assert got == expected
    assert components(df.where(F.lit(False))).collect() == []
