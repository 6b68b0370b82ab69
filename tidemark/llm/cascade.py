"""Quality rules as a short-circuit cascade.

Each rule is a DataFrame condition that rejects a document. On a sample, every rule's cost and share
of rejected rows are measured; rules then run in the order of rejection per cost, and a document
that one rule rejects meets no further rule. The order changes the cost, never the verdict.
"""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches

SAMPLE_ROWS = 2_000  # documents that costs and selectivity are estimated on, at most
PASSES = 5  # timed passes of each rule over the sample; the shortest counts

_SPACE = r"[ \t\n\x0B\f\r]+"
_SYMBOL = r"[#*$%&|<>]"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


WORDS = f"filter(split(text, {_quoted(_SPACE)}), w -> w != '')"
N_SYMBOLS = f"regexp_count(text, {_quoted(_SYMBOL)})"
WORD_CHARS = f"length(regexp_replace(text, {_quoted(_SPACE)}, ''))"
FULL_LINES = f"filter(split(text, '\\n', -1), l -> l RLIKE {_quoted('[^ \\t-\\r]')})"


class Rule(NamedTuple):
    """A document is rejected where the condition over ``text`` holds."""

    name: str
    rejects: str


RULES = (
    Rule("symbols", f"{N_SYMBOLS} * 2 > size({WORDS})"),
    Rule("word_length", f"({WORD_CHARS}) > 20 * size({WORDS})"),
    Rule("repeated_lines", f"size({FULL_LINES}) >= 4"
         f" AND size(array_distinct({FULL_LINES})) * 2 < size({FULL_LINES})"),
    Rule("capitals", "length(regexp_replace(text, '[^A-Z]+', '')) * 2 > length(text)"),
    Rule("few_letters", "length(regexp_replace(text, '[^\\\\p{L}]', '')) * 2 < length(text)"),
)


class Measured(NamedTuple):
    rule: Rule
    seconds: float
    rejected: float

    def worth(self) -> float:
        """Rejection per cost."""
        return self.rejected / self.seconds


def measure(texts: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Measured]:
    """Cost and selectivity of each rule on a sample of about ``sample_rows`` documents.

    The cost is the time of a pass over the cached sample beyond that of a pass without a rule. Every
    rule runs once untimed, which plans and compiles it; then rules take turns, and the shortest of
    ``PASSES`` passes counts. A rule that can't be told from a pass without one costs a tenth of it.
    Without rows no rule rejects anything and all cost the same.
    """
    sample = batches.sample_of(texts.select("text"), sample_rows).cache()
    rows = sample.count()
    if not rows:
        sample.unpersist()
        return [Measured(rule, 1.0, 0.0) for rule in rules]

    def timed(condition: str) -> tuple[float, int]:
        began = time.perf_counter()
        held = sample.agg(F.count_if(F.expr(condition))).first()[0]
        return time.perf_counter() - began, held

    conditions = ["length(text) < 0", *(rule.rejects for rule in rules)]
    held = [timed(condition)[1] for condition in conditions]
    passes = [[timed(condition)[0] for condition in conditions] for _ in range(PASSES)]
    idle, *least = [min(times) for times in zip(*passes, strict=True)]
    sample.unpersist()
    return [
        Measured(rule, max(seconds - idle, idle / 10), rejected / rows)
        for rule, seconds, rejected in zip(rules, least, held[1:], strict=True)
    ]


def ordered(measured: list[Measured]) -> list[Rule]:
    return [m.rule for m in sorted(measured, key=lambda m: (-m.worth(), m.rule.name))]


def rejected_by(rules: list[Rule]):
    """The first rule that rejects a text, null if none does; later rules are not evaluated."""
    verdict = F
    for rule in rules:
        verdict = verdict.when(F.expr(rule.rejects), F.lit(rule.name))
    return verdict.otherwise(F.lit(None)) if rules else F.lit(None).cast("string")


def run_cascade(texts: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``texts`` (with column ``text``) and ``rejected``: whether any rule rejects the text."""
    order = ordered(measure(texts, rules, sample_rows))
    return texts.withColumn("rejected", rejected_by(order).isNotNull())


# Positions of words in three-word windows that occur twice or more in their text. Equal windows
# are neighbours once windows are sorted by their hash.
_WINDOWS = (
    "if(size(words) < 3, cast(array() AS array<struct<h: bigint, i: int>>),"
    " sort_array(transform(sequence(0, size(words) - 3), i -> struct("
    "xxhash64(words[i], words[i + 1], words[i + 2]) AS h, i AS i))))"
)
_REPEATED = (
    "filter(transform(windows, (s, k) -> if("
    "(k > 0 AND windows[k - 1].h = s.h) OR (k + 1 < size(windows) AND windows[k + 1].h = s.h),"
    " s.i, -1)), p -> p >= 0)"
)
_COVERED = "size(array_distinct(flatten(transform(repeated, p -> array(p, p + 1, p + 2)))))"


def word_counts(texts: DataFrame) -> DataFrame:
    """The fixed measures of every text, beside its columns."""
    counted = texts.withColumn("words", F.expr(WORDS)).withColumn("lines", F.expr(FULL_LINES))
    counted = counted.withColumn("windows", F.expr(_WINDOWS))
    counted = counted.withColumn("repeated", F.expr(_REPEATED))
    return counted.select(
        *texts.columns,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.expr(N_SYMBOLS).cast("long").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) AS long)").alias("n_dup_lines"),
        F.expr(f"cast({_COVERED} AS long)").alias("n_repeat_words"),
    )


def judge_quality(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules=RULES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    Words are runs without ASCII white space. A document fails the base with fewer than 50 words or
    with more than half of them in repeated three-word windows; it is kept if it passes the base and
    no rule of the cascade rejects it.

    Null text has no words and is not kept; neither is empty text. Every row is judged by itself,
    repeated rows too; a null id stays; other columns are ignored. Windows are compared by 64-bit
    hashes within a text.
    """
    texts = batches.id_and_text(df, id_column, text_column)
    counted = word_counts(run_cascade(texts, rules, sample_rows))
    failed = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr(failed).alias("base_failed"),
        F.expr(f"NOT {failed} AND NOT rejected").alias("kept"),
    )
