"""The mix against plain loops, and the schedules against sums over small steps."""

import hashlib
import re

import pytest
from cases import ODD, documents, workers  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import curriculum


def sized(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """By rounds, as the rule is put: the excess goes to those that are not above their limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: at % 3 + 1 for at, name in enumerate(names)}
    held = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in held)
        share = sum(weight[s] for s in names if s not in held)
        goal = {s: 3 * sizes[s] if s in held else rest * weight[s] / share for s in names}
        over = {s for s in names if s not in held and goal[s] > 3 * sizes[s]}
        if not over:
            return goal
        held |= over


ROWS = [
    (i, f"s{i % 5}" if i % 4 else (None, "")[i % 8 == 0], "word " * (i * 7 % 23)) for i in range(400)
] + [(1000, "tiny", "a b"), (1001, "huge", "w " * 9000), (7, "s2", "again"), (7, "s2", "again"),
     (None, "s1", "x y z"), (1002, "none", None), (1003, "none", "  ")]


def test_equals_plain_loops(spark):
    df = spark.createDataFrame(
        [(*row, 1, 2.0) for row in ROWS], "doc_id int, source string, text string, row int, size double"
    )
    mix = curriculum.mix_sources(df, carry=["text"])
    found = curriculum.taken_words(mix).collect()
    assert len(found) == len(ROWS)
    sizes = {}
    for _, source, text in ROWS:
        sizes[source] = sizes.get(source, 0) + sized(text)
    goal = targets(sizes)
    stored = {r.source: r for r in mix.sources.collect()}
    assert {s: pytest.approx(r.target) for s, r in stored.items()} == goal
    stream = mix.stream.collect()
    assert [r.position for r in stream] == sorted(r.position for r in stream)
    assert all(0 <= r.position < 1 for r in stream) and all(sized(r.text) >= r.words for r in stream)

    expected = []
    for source in sizes:
        rows = sorted(
            ((hashlib.md5(("" if i is None else str(i)).encode()).hexdigest(), sized(text), i)
             for i, s, text in ROWS if s == source), key=lambda r: r[:2])
        left, taken = int(goal[source] + 0.5), [0] * len(rows)
        for _ in range(3):
            for at, (_, size, _) in enumerate(rows):
                taken[at] += min(size, left)
                left -= min(size, left)
        assert left == 0
        expected += [(i, size, sizes[source], t) for (_, size, i), t in zip(rows, taken)]
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.size, r.source_size, r.taken) for r in found), key=key) == sorted(
        expected, key=key)
    again = curriculum.taken_words(curriculum.mix_sources(df.repartition(3))).collect()
    assert sorted(again, key=key) == sorted(found, key=key)


@pytest.mark.parametrize("knots", [
    *curriculum.SCHEDULES, ((0.0, 0.0), (1.0, 2.0)), ((0.0, 2.0), (0.4, 0.0), (0.6, 0.0), (1.0, 1.0)),
])
def test_times_invert_the_integral(spark, knots):
    shares = [i / 200 for i in range(200)]
    df = spark.createDataFrame([(s,) for s in shares], "share double")
    times = [r[0] for r in df.orderBy("share").select(
        curriculum.time_of(F.col("share"), knots)).collect()]
    assert times == sorted(times)

    def weight(t):
        for (begin, low), (end, high) in zip(knots, knots[1:]):
            if begin <= t <= end:
                return low + (high - low) * (t - begin) / (end - begin)

    steps = [weight((i + 0.5) / 20000) / 20000 for i in range(20000)]
    total = sum(steps)
    for share, time in list(zip(shares, times))[::20]:
        assert sum(steps[: round(time * 20000)]) / total == pytest.approx(share, abs=1e-3)


def test_schedules_change_the_mix(spark):
    """Of a light source more is read early, of a heavy one late."""
    rows = [(i, f"s{i % 3}", "w " * 10) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    stream = curriculum.mix_sources(df, carry=["source"]).stream
    early = {r.source: r.n for r in stream.groupBy("source").agg(
        F.avg((F.col("position") < 0.5).cast("int")).alias("n")).collect()}
    assert early["s0"] == pytest.approx(2 / 3, abs=0.02)
    assert early["s1"] == pytest.approx(1 / 2, abs=0.02)
    assert early["s2"] == pytest.approx(1 / 3, abs=0.02)


def test_odd_rows_and_an_empty_table(spark, documents):  # noqa: F811
    found = curriculum.taken_words(curriculum.mix_sources(documents(*ODD), source_column="kind"))
    rows = found.collect()
    assert len(rows) == len(ODD) and sum(r.taken for r in rows) == sum(r.size for r in rows)
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert curriculum.taken_words(curriculum.mix_sources(none)).collect() == []
    blank = spark.createDataFrame([(1, None, None)], "doc_id long, source string, text string")
    assert [r.taken for r in curriculum.taken_words(curriculum.mix_sources(blank)).collect()] == [0]


def test_a_schedule_is_checked():
    for knots in (((0.1, 1.0), (1.0, 1.0)), ((0.0, 0.0), (1.0, 0.0)), ((0.0, -1.0), (1.0, 2.0))):
        with pytest.raises(ValueError):
            curriculum.areas(knots)
