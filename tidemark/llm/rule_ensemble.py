"""A quality classifier that is a sparse sum of readable rules.

Shallow trees over statistics of the text give conjunctive rules, one per path; a logistic
regression with an L1 penalty keeps few of them. The result is a Spark column over the statistics.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import batches
from tidemark.llm.store import materialize

TRAINING_ROWS = 20_000  # labelled rows that a model is fitted on, at most
TREES, DEPTH = 16, 3
PENALTY = 0.002

STATISTICS = (
    "n_words", "word_length", "distinct_words", "symbols", "upper", "digits", "exclamations",
    "punctuation", "non_ascii", "line_words", "repeated_lines", "top_word", "entropy",
)

_SYMBOL, _PUNCTUATION = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>{}[]\\^~_@=+/")] = True
_PUNCTUATION[list(b".,;:!?'\"()-")] = True


class Rule(NamedTuple):
    """Bounds that all hold, and the weight they add to the log-odds."""

    bounds: tuple[tuple[str, str, float], ...]
    weight: float = 0.0

    def column(self, statistics: str = "") -> Column:
        """The rule over columns of statistics, or over fields of one column that holds them."""
        held = F.lit(True)
        for name, sign, value in self.bounds:
            own = F.col(f"{statistics}.{name}" if statistics else name)
            held = held & (own <= value if sign == "<=" else own > value)
        return held

    def __str__(self) -> str:
        return " and ".join(f"{n} {s} {v:.6g}" for n, s, v in self.bounds) or "always"


class Ensemble(NamedTuple):
    intercept: float
    rules: tuple[Rule, ...]

    def score(self, statistics: str = "") -> Column:
        """The probability of label 1 as a column over the statistics."""
        odds = F.lit(self.intercept)
        for rule in self.rules:
            odds = odds + F.when(rule.column(statistics), F.lit(rule.weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-odds))


def _statistics(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first column and the statistics of the text, which is the second column.

    Without a second column the text is the last field of the first one.
    """
    for batch in rows:
        found = []
        first = batch.column(0)
        texts = batch.column(1) if batch.num_columns > 1 else first.field(first.type.num_fields - 1)
        raw, begins = batches.text_bytes(texts)
        for first, last in batches.slices(begins):
            low = begins[first]
            part = raw[low : begins[last]]
            starts, ends, words, at = batches.hash_words(
                part, begins[first : last + 1] - low, batches.WORD_OF_SPACES
            )
            for i in range(first, last):
                text = part[begins[i] - low : begins[i + 1] - low]
                own = slice(at[i - first], at[i - first + 1])
                found.append(_of_text(text, words[own], ends[own] - starts[own]))
        values = np.array(found, np.float64).reshape(-1, len(STATISTICS))
        statistics = pa.StructArray.from_arrays(
            [pa.array(values[:, k]) for k in range(len(STATISTICS))], list(STATISTICS)
        )
        yield pa.record_batch([batch.column(0), statistics], [batch.schema.names[0], "statistics"])


def _of_text(text: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> list[float]:
    size, count = len(text), len(words)
    if not count:
        return [0.0] * len(STATISTICS)
    seen = np.bincount(text, minlength=256)
    chars = int(lengths.sum())
    _, often = np.unique(words, return_counts=True)
    lines = [line for line in text.tobytes().split(b"\n") if line.strip()]
    share = seen[seen > 0] / size
    return [
        count,
        chars / count,
        len(often) / count,
        seen[_SYMBOL].sum() / chars,
        seen[65:91].sum() / chars,
        seen[48:58].sum() / chars,
        seen[33] / count,
        seen[_PUNCTUATION].sum() / chars,
        seen[128:].sum() / chars,
        count / len(lines),
        1 - len(set(lines)) / len(lines),
        often.max() / count,
        float(-(share * np.log2(share)).sum()),
    ]


def text_statistics(texts: DataFrame) -> DataFrame:
    """The first column as it is, and the ``statistics`` of the text in the second one.

    Without a second column the text is the last field of the first one. An empty text has zeros.
    """
    statistics = T.StructType([T.StructField(name, T.DoubleType()) for name in STATISTICS])
    schema = T.StructType([texts.schema[0], T.StructField("statistics", statistics)])
    return texts.mapInArrow(_statistics, schema)


def _paths(node, names, bounds=()) -> Iterator[tuple]:
    """Every conjunction of bounds from the root to a node below it."""
    if bounds:
        yield bounds
    if node.numDescendants() == 0:
        return
    name, value = names[node.split().featureIndex()], node.split().threshold()
    yield from _paths(node.leftChild(), names, (*bounds, (name, "<=", value)))
    yield from _paths(node.rightChild(), names, (*bounds, (name, ">", value)))


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Ensemble:
    """An ensemble from rows of the statistics and ``label`` (0 or 1).

    Without rows of both labels there are no rules, and the score is the smoothed share of label 1.
    """
    counts = {row.label: row["count"] for row in rows.groupBy("label").count().collect()}
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    if not zeros or not ones:
        return Ensemble(math.log((ones + 0.5) / (zeros + 0.5)) if zeros + ones else 0.0, ())
    labelled = rows.withColumn("label", F.col("label").cast("double"))
    assembled = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(labelled)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="0.5", seed=7, minInstancesPerNode=5
    ).fit(assembled)
    found = dict.fromkeys(
        path for tree in forest.trees for path in _paths(tree._call_java("rootNode"), STATISTICS)
    )
    rules = [Rule(path) for path in found]
    flags = labelled.select(
        "label", *(rule.column().cast("double").alias(f"r{i}") for i, rule in enumerate(rules))
    )
    flags = VectorAssembler(
        inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features"
    ).transform(flags).select("label", "features")
    model = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=40).fit(flags)
    kept = (
        rule._replace(weight=float(weight))
        for rule, weight in zip(rules, model.coefficients.toArray(), strict=True)
        if weight
    )
    return Ensemble(float(model.intercept), tuple(kept))


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    folds: int = 5,
    training_rows: int = TRAINING_ROWS,
) -> Ensemble:
    """An ensemble from the labelled documents outside fold 0 of ``folds``.

    At most about ``training_rows`` labelled ids are used, chosen by a hash of the id. A document
    with several labels counts as the worst of them; null labels and ids are ignored.
    """
    known = labels.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{label_column}`").cast("int").alias("label"),
    ).where("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.where(batches.fold("doc_id", folds) != 0)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    count = known.count()
    if count > training_rows:
        limit = int(training_rows / count * (1 << 20))
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < limit)
    texts = batches.id_and_text(documents, id_column, text_column)
    rows = text_statistics(texts.join(F.broadcast(known), "doc_id").select("label", "text"))
    return fit(materialize(rows.select("label", "statistics.*"), "labelled"))


def score_quality(
    documents: DataFrame,
    model: Ensemble,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = 0.3,
) -> DataFrame:
    """``doc_id, score, predicted`` of every row, from its text alone.

    Null or empty text has zeros for statistics and a score like any other; null ids stay; repeated
    rows are scored each; other columns are ignored.
    """
    statistics = text_statistics(batches.id_and_text(documents, id_column, text_column))
    scored = statistics.withColumn("score", model.score("statistics"))
    return scored.select(
        "doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_predicted(
    documents: DataFrame, model: Ensemble, text_column: str = "text", threshold: float = 0.3
) -> DataFrame:
    """The rows of ``documents`` with a score of ``threshold`` or more, whole and in one pass.

    Null or empty text has zeros for statistics and a score like any other; repeated rows and rows
    without id are judged each; nulls and names of other columns make no difference.
    """
    others = [name for name in documents.columns if name != text_column]
    rows = documents.select(F.struct(*[F.col(f"`{n}`") for n in (*others, text_column)]).alias("row"))
    kept = text_statistics(rows).where(model.score("statistics") >= threshold)
    return kept.select(*[F.col("row").getField(name).alias(name) for name in documents.columns])
