"""Secrets in text: fixed patterns, and strings that look random to two character models.

Everything is a DataFrame expression. Two first-order character models, of random strings and of
ordinary identifiers, are counted over all labelled strings; a stretch of key characters is a secret if
the random model explains it better by a given log-likelihood ratio. Stretches are looked for in the
runs outside the fixed patterns' spans, so a key within a path or beside a found id is found too.

Arrays of matches are folded in chunks, each from what the chunks before hand on, so that a text costs
in proportion to its matches.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches

# Kinds in their order, pattern, the group whose length counts, and the least length.
BASE = (
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # shorter runs would fail, and runs are whole: no others
)
RANDOM = "random"
RUN = r"[A-Za-z0-9+/_-]{16,}"
IDENTIFIER = r"[A-Za-z0-9+/_-]{6,}"
MARK = "[SECRET]"

MARGIN = 12.0  # least log-likelihood ratio of a span
LEAST = 16  # least length of a random span
_ASCII = 128
_SPAN = "struct<begin: int, kind: int, end: int, value: string>"
_NONE = f"cast(array() AS array<{_SPAN}>)"
_CHUNK = 128  # matches folded together


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _chunks(items: str) -> str:
    return (
        f"transform(sequence(0, cast((size({items}) - 1) div {_CHUNK} AS int)),"
        f" k -> slice({items}, k * {_CHUNK} + 1, {_CHUNK}))"
    )


class Model(NamedTuple):
    """Log-likelihood ratio of every pair of neighbouring ASCII characters, random over ordinary."""

    ratios: tuple[float, ...]

    def stretches(self, run: str, margin: float) -> str:
        """The stretches of a run, as SQL: ``(begin, end)`` in the run, ``end`` exclusive.

        The ratio is summed along the run and starts anew where it falls to 0, or by the margin below
        its highest sum; each rise to the margin or more is a stretch from its start to its highest
        sum, widened to the letters and digits around it, but for up to three of a part that a
        separator cuts off and that goes on outside: these are left to that part. The cost is in proportion to the run's length.
        """
        table = f"cast(split('{','.join(f'{x:.4f}' for x in self.ratios)}', ',') AS array<double>)"
        pairs = (
            f"zip_with(c, slice(c, 2, size(c)),"
            f" (a, b) -> if(b IS NULL, 0D, element_at({table}, a * {_ASCII} + b + 1)))"
        )
        ratios = _let("c", f"transform(split({run}, ''), x -> ascii(x))", pairs)
        kept = f"if(acc.top >= {margin}D, concat(acc.found, array(acc.stretch)), acc.found)"
        new = "named_struct('begin', acc.at, 'end', acc.at + 2)"
        fold = (
            f"aggregate({ratios}, named_struct('at', 0, 'sum', 0D, 'top', 0D, 'stretch',"
            " named_struct('begin', 0, 'end', 0), 'found',"
            " cast(array() AS array<struct<begin: int, end: int>>)), (acc, x) -> CASE"
            # a new rise begins
            f" WHEN acc.sum <= 0D THEN named_struct('at', acc.at + 1, 'sum', greatest(x, 0D), 'top',"
            f" greatest(x, 0D), 'stretch', {new}, 'found', acc.found)"
            # the rise is over: keep it if it was high enough
            f" WHEN acc.sum + x <= greatest(0D, acc.top - {margin}D) THEN named_struct('at', acc.at + 1, 'sum', 0D, 'top', 0D,"
            f" 'stretch', {new}, 'found', {kept})"
            " WHEN acc.sum + x > acc.top THEN named_struct('at', acc.at + 1, 'sum', acc.sum + x,"
            " 'top', acc.sum + x, 'stretch', named_struct('begin', acc.stretch.begin, 'end',"
            " acc.at + 2), 'found', acc.found)"
            " ELSE named_struct('at', acc.at + 1, 'sum', acc.sum + x, 'top', acc.top, 'stretch',"
            f" acc.stretch, 'found', acc.found) END, acc -> {kept})"
        )
        before = f"length(regexp_extract(left({run}, s.begin), '[A-Za-z0-9+]*$', 0))"
        after = f"length(regexp_extract(substring({run}, s.end + 1), '^[A-Za-z0-9+]*', 0))"
        inside = f"substring({run}, s.begin + 1, s.end - s.begin)"
        head = f"length(regexp_extract({inside}, '^[A-Za-z0-9+]{{0,3}}[/_-]', 0))"
        tail = f"length(regexp_extract({inside}, '[/_-][A-Za-z0-9+]{{0,3}}$', 0))"
        begin = _let("n", before, _let("h", head, (
            "if(h > 0 AND (n > 0 OR h = 1), s.begin + h, s.begin - n)"
        )))
        end = _let("n", after, _let("h", tail, (
            "if(h > 0 AND (n > 0 OR h = 1), s.end - h, s.end + n)"
        )))
        return f"array_distinct(transform({fold}, s -> named_struct('begin', {begin}, 'end', {end})))"


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(pattern: str, kind: int, group: int, least: int, text: str = "text") -> str:
    """All matches of a pattern as spans, from the lengths of the matches and of what is between."""
    quoted = _sql_text(pattern)
    parts = _let(
        "found",
        f"regexp_extract_all({text}, {quoted}, 0)",
        f"arrays_zip(slice(split({text}, {quoted}, -1), 1, size(found)), found,"
        f" regexp_extract_all({text}, {quoted}, {group}))",
    )
    lengths = "aggregate(c, 0, (n, m) -> n + length(m.`0`) + length(m.found))"
    starts = f"aggregate(q, array(0), (a, c) -> concat(a, array(element_at(a, -1) + {lengths})))"
    begin = "acc.at + length(m.`0`)"
    end = f"{begin} + length(m.found)"
    one = f"named_struct('begin', {begin}, 'kind', {kind}, 'end', {end}, 'value', m.found)"
    spans = (
        f"aggregate(c, named_struct('at', starts[k], 'spans', {_NONE}), (acc, m) -> named_struct("
        f"'at', {end}, 'spans', if(length(m.`2`) >= {least}, concat(acc.spans, array({one})),"
        " acc.spans)), acc -> acc.spans)"
    )
    folded = _let("p", parts, _let("q", _chunks("p"), _let(
        "starts", starts, f"flatten(transform(q, (c, k) -> {spans}))"
    )))
    return f"if({text} RLIKE {quoted}, {folded}, {_NONE})"


def _replaced(text: str, spans: str, mark: str) -> str:
    """The text with ``mark`` for every span; ``mark`` may use ``acc.at``, where the text so far ends,
    and the span ``s``. Spans are sorted and may overlap."""
    before = (
        "aggregate(q, array(0), (a, c) -> concat(a, array(greatest(element_at(a, -1),"
        " array_max(transform(c, s -> s.end))))))"
    )
    start = "if({0} = 0, 0, q[{0}][0].begin)"
    stop = f"if(k + 1 < size(q), {start.format('least(k + 1, size(q) - 1)')}, length(t))"
    # Each chunk with the part of the text from its first span to the next chunk's.
    cut = _let("b", start.format("k"), _let("e", stop, (
        "named_struct('spans', c, 'b', b, 'e', e, 'at', greatest(carried[k], b),"
        " 'part', substring(t, b + 1, e - b))"
    )))
    kept = "substring(x.part, acc.at - x.b + 1, s.begin - acc.at)"
    folded = (
        "aggregate(x.spans, named_struct('at', x.at, 'out', ''), (acc, s) -> named_struct("
        f"'at', greatest(acc.at, s.end), 'out', concat(acc.out, if(s.begin > acc.at, {kept}, ''),"
        f" {mark})), acc -> concat(acc.out,"
        " if(acc.at < x.e, substring(x.part, acc.at - x.b + 1), '')))"
    )
    return _let("t", text, _let("q", _chunks(spans), _let("carried", before, (
        f"array_join(transform(transform(q, (c, k) -> {cut}), x -> {folded}), '')"
    ))))


def base_spans(texts: DataFrame) -> DataFrame:
    """``texts`` with ``base``: spans of the fixed patterns by begin, then kind."""
    kinds = [_spans(p, at, group, least) for at, (_, p, group, least) in enumerate(BASE)]
    return texts.withColumn("base", F.expr(f"array_sort(concat({', '.join(kinds)}))"))


def train(texts: DataFrame) -> Model | None:
    """Both models from all documents, labelled by the fixed patterns.

    The values that the patterns find are random strings. Ordinary are the runs of documents without
    such values whose digits, if any, stand together, which those of random strings rarely do.
    Only counts of character pairs leave the tasks. None without strings of both labels.
    """
    value = "regexp_extract(s.value, '([A-Za-z0-9+/_-]+)$', 1)"
    plain = (
        f"filter(regexp_extract_all(text, {_sql_text(IDENTIFIER)}, 0),"
        " t -> t RLIKE '^[^0-9]*[0-9]*[^0-9]*$')"
    )
    tokens = base_spans(texts.select("text")).select(
        F.expr("cast(size(base) > 0 AS int)").alias("label"),
        F.explode(F.expr(f"if(size(base) > 0, transform(base, s -> {value}), {plain})")).alias("token"),
    )
    pairs = tokens.where("length(token) > 1").select(
        "label",
        F.explode(F.expr(
            "zip_with(split(token, ''), slice(split(token, ''), 2, length(token)),"
            " (a, b) -> concat(a, b))"
        )).alias("pair"),
    ).where("pair IS NOT NULL")
    counts = {0: {}, 1: {}}
    for row in pairs.groupBy("label", "pair").agg(F.count("*").alias("n")).collect():
        counts[row.label][row.pair] = row.n
    if not counts[0] or not counts[1]:
        return None
    return Model(tuple(_ratios(counts)))


def _ratios(counts: dict[int, dict[str, int]], weight: float = 5.0) -> list[float]:
    """Log ratios of the conditional chances; rare first characters fall back to single ones."""
    letters = [chr(c) for c in range(_ASCII) if chr(c).isalnum() or chr(c) in "+/_-"]
    firsts, seconds = {}, {}
    for label, own in counts.items():
        firsts[label] = {a: sum(own.get(a + b, 0) for b in letters) for a in letters}
        single = {b: sum(own.get(a + b, 0) for a in letters) + 0.5 for b in letters}
        seconds[label] = {b: n / sum(single.values()) for b, n in single.items()}
    ratios = [0.0] * (_ASCII * _ASCII)
    for a in letters:
        for b in letters:
            ordinary, random = (
                math.log(counts[label].get(a + b, 0) + weight * seconds[label][b])
                - math.log(firsts[label][a] + weight)
                for label in (0, 1)
            )
            ratios[ord(a) * _ASCII + ord(b)] = random - ordinary
    return ratios


def find_secrets(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    margin: float = MARGIN,
) -> DataFrame:
    """``doc_id, text, base, spans`` of every row.

    ``base`` are the matches of the fixed patterns and ``spans`` these and the random stretches of
    the runs outside them, both sorted by begin and kind; a span has code points ``begin`` and ``end``
    (exclusive), the kind's place in ``KINDS``, and its text as ``value``. Null text is empty; empty text and an empty table
    have no spans; repeated rows are scanned each; a null id stays; other columns are ignored.
    Without training strings of both labels only the fixed patterns count.
    """
    return _with_spans(batches.id_and_text(df, id_column, text_column), margin)


def _with_spans(texts: DataFrame, margin: float) -> DataFrame:
    """``texts`` (with column ``text``) with ``base`` and ``spans``."""
    model = train(texts)
    found = base_spans(texts)
    if model is None:
        return found.withColumn("spans", F.col("base"))
    blank = "repeat('\n', greatest(s.end, acc.at) - greatest(s.begin, acc.at))"
    outside = found.withColumn(
        "outside", F.expr(f"if(size(base) > 0, {_replaced('text', 'base', blank)}, text)")
    )
    runs = outside.withColumn("runs", F.expr(_spans(RUN, len(BASE), 0, 16, "outside")))
    random = (
        f"transform(filter({model.stretches('r.value', margin)}, s -> s.end - s.begin >= {LEAST}),"
        f" s -> named_struct('begin', r.begin + s.begin, 'kind', {len(BASE)}, 'end',"
        " r.begin + s.end, 'value', substring(r.value, s.begin + 1, s.end - s.begin)))"
    )
    return runs.withColumn("spans", F.when(
        F.size("runs") > 0,
        F.array_sort(F.concat("base", F.expr(f"flatten(transform(runs, r -> {random}))"))),
    ).otherwise(F.col("base"))).drop("runs", "outside")


KINDS = (*(kind for kind, *_ in BASE), RANDOM)


def spans_text(spans: str) -> Column:
    """Spans as ``kind:begin:end``, joined by commas."""
    names = ", ".join(f"'{kind}'" for kind in KINDS)
    return F.expr(
        f"array_join(transform({spans}, s -> concat_ws(':', element_at(array({names}), s.kind + 1),"
        " s.begin, s.end)), ',')"
    )


def summary(found: DataFrame) -> DataFrame:
    """Counts per fixed kind, a digest of the fixed spans, and all spans, as text."""
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = {at})) AS long)").alias(f"n_{kind}")
        for at, (kind, *_) in enumerate(BASE)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(spans_text("base"), 256).alias("base_sha256"),
        spans_text("spans").alias("spans"),
    )


def redacted(text: str, spans: str, mark: str = MARK) -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark."""
    marked = _replaced(text, spans, f"if(s.begin >= acc.at, '{mark}', '')")
    return F.when(F.size(spans) > 0, F.expr(marked)).otherwise(F.col(text))


def redact(
    df: DataFrame,
    text_column: str = "text",
    length_column: str = "n_chars",
    margin: float = MARGIN,
) -> DataFrame:
    """All rows and columns of ``df`` with secrets replaced by a mark.

    ``length_column``, if there is one, becomes the new text's length where the text changed. Null
    text stays null.
    """
    texts = df.select(
        F.struct("*").alias("row"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")
    )
    found = _with_spans(texts, margin).withColumn("clean", redacted("text", "spans"))
    changed = F.size("spans") > 0
    new = {text_column: F.col("clean")}
    if length_column in df.columns:
        new[length_column] = F.length("clean").cast(df.schema[length_column].dataType)
    return found.select(*[
        F.when(changed, new[name]).otherwise(old).alias(name) if name in new else old.alias(name)
        for name, old in ((name, F.col("row").getField(name)) for name in df.columns)
    ])
