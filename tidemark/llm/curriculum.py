"""Sources mixed to target sizes along a curriculum that changes over the time of training.

Every source has a target, its share by weight of all words, held at a multiple of what it has. Its
schedule, a weight that changes over training time from 0 to 1, is integrated; scaled to the target,
the integral is the source's demand for words up to any time. The source's documents are put in a
fixed random order, again and again for as long as its target reaches, and a copy is read when the
demand has come to the words before it: that time is its position. Documents of all sources sorted
by range of position are the training stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import materialize, sent_if_small
from tidemark.operators.ranks import numbered

Knots = Sequence[tuple[float, float]]

WEIGHTS = (1, 2, 3)  # of the sources in order, again and again
MOST = 3  # times that a source, and so a document, is read
WORD = r"[^\x20\x09-\x0D]+"
# Time and weight, linear in between: light sources fade out, heavy ones fade in.
SCHEDULES: tuple[Knots, ...] = (
    ((0.0, 3.0), (0.5, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (0.5, 1.0), (1.0, 3.0)),
)
_SOURCE_BYTES = 200


class Mix(NamedTuple):
    """Stored tables: what was counted, and the training stream.

    ``documents`` has ``row, doc_id, source, size``, ``sources`` has ``source, source_size, weight,
    target, demand``. ``stream`` has a row per copy, sorted by range of ``position``: ``row, doc_id,
    copy`` from 0, ``words`` of this copy, ``position`` from 0 to 1, and the columns carried along.
    """

    documents: DataFrame
    sources: DataFrame
    stream: DataFrame


def areas(knots: Knots) -> list[float]:
    """The integral of a schedule up to each knot."""
    found = [0.0]
    for (begin, low), (end, high) in zip(knots, knots[1:], strict=False):
        found.append(found[-1] + (end - begin) * (low + high) / 2)
    if knots[0][0] != 0 or knots[-1][0] != 1 or found[-1] <= 0 or min(w for _, w in knots) < 0:
        raise ValueError("a schedule runs from 0 to 1 with weights from 0 on, not all 0")
    return found


def time_of(share: Column, knots: Knots) -> Column:
    """The time at which a schedule has called for ``share`` of its whole demand."""
    sums = areas(knots)
    wanted = share * F.lit(sums[-1])
    found = F.lit(1.0)
    for at in range(len(knots) - 2, -1, -1):  # the last stretch first, so the first one wins
        (begin, low), (end, high) = knots[at], knots[at + 1]
        rest = wanted - F.lit(sums[at])
        slope = (high - low) / (end - begin)
        root = F.sqrt(F.greatest(F.lit(low * low) + F.lit(2 * slope) * rest, F.lit(0.0)))
        within = F.when(rest > 0, F.lit(begin) + F.lit(2.0) * rest / (F.lit(low) + root))
        if sums[at + 1] > sums[at]:
            found = F.when(wanted < F.lit(sums[at + 1]), within.otherwise(F.lit(begin))).otherwise(found)
    return found


def _targets(sources: DataFrame, most: int) -> DataFrame:
    """``sources`` with ``target`` and ``demand``.

    Each round takes the sources whose share is above their limit and shares the rest by weight.
    The share per weight only rises, so a limit once met stays met; a round is a sum over sources.
    """
    limit = F.col("source_size").cast("decimal(38,0)") * most
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, left, held = int(total or 0), int(weight or 0), 0
    while True:
        above = (limit * left) < F.col("weight") * F.lit(rest).cast("decimal(38,0)")
        now = sources.agg(
            F.sum(F.when(above, 1).otherwise(0)),
            F.sum(F.when(above, limit)),
            F.sum(F.when(above, F.lit(0)).otherwise(F.col("weight"))),
        ).first()
        if (now[0] or 0) == held:
            break
        held, rest, left = now[0], int(total) - int(now[1]), int(now[2])
    share = F.lit(float(rest)) * F.col("weight") / F.lit(float(left or 1))
    target = F.when(above, limit.cast("double")).otherwise(share)
    return sources.withColumn("target", target).withColumn(
        "demand", F.floor(F.col("target") + 0.5).cast("long")
    )


def mix_sources(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    schedules: Sequence[Knots] = SCHEDULES,
    carry: Sequence[str] = (),
) -> Mix:
    """The training stream of all rows of ``df``; ``carry`` names columns it takes along.

    Sources in the order of code points, null last, weigh ``weights`` and follow ``schedules``, both
    again and again, and share the words of the whole table. What a target has beyond ``most`` times
    its source goes to the others by weight. A source's last copy is cut where its demand ends, so
    that the words taken are the target but for rounding; ``words`` says how many of the copy count.

    A document's size is its words; null, empty and blank texts have none, are in no copy, and are
    still counted as documents. Every row is a document, repeated rows and rows without id too. The
    order within a source is by md5 of the id, so the same table gives the same stream. An empty
    table gives empty ones. Other columns are ignored.
    """
    own = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{source_column}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text_column}`"), F.lit(WORD)), F.lit(0))
        .cast("long").alias("size"),
        F.struct(*[F.col(f"`{name}`") for name in carry]).alias("carried") if carry
        else F.lit(None).cast("int").alias("carried"),
    )
    rows = materialize(own, "sized")
    counted = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = numbered(materialize(counted, "sources"), [], [F.col("source").asc_nulls_last()])

    def turn(values: Sequence) -> Column:
        turns = F.array(*[F.lit(v) for v in values])
        return F.get(turns, F.pmod("position", F.lit(len(values))).cast("int"))

    named = placed.select(
        "source", "source_size", turn(weights).cast("long").alias("weight"),
        turn(range(len(schedules))).alias("schedule"),
    )
    sources = materialize(_targets(materialize(named, "weights"), most), "targets")

    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    ordered = numbered(
        rows.where("size > 0").withColumn("_order", order), ["source"], ["_order", "size"], add="size"
    )
    known = sent_if_small(sources.withColumnRenamed("source", "_source"), _SOURCE_BYTES)
    met = ordered.join(known, F.col("source").eqNullSafe(F.col("_source")))
    copies = met.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    at = F.col("copy") * F.col("source_size") + F.col("before")
    copies = copies.withColumn("at", at).where("at < demand")
    share = F.col("at").cast("double") / F.col("demand")
    position = F.lit(None).cast("double")
    for number, knots in enumerate(schedules):
        position = F.when(F.col("schedule") == number, time_of(share, knots)).otherwise(position)
    fields = [F.col("carried").getField(name).alias(name) for name in carry]
    stream = copies.select(
        "row", "doc_id", "copy",
        F.least("size", F.col("demand") - F.col("at")).alias("words"),
        position.alias("position"),
        *fields,
    )
    by = ("position", "row", "copy")
    stream = materialize(materialize(stream, "copies").repartitionByRange(*by)
                         .sortWithinPartitions(*by), "stream")
    return Mix(rows.drop("carried"), sources.drop("schedule"), stream)


def taken_words(mix: Mix) -> DataFrame:
    """``doc_id, size, source_size, target, taken, first_position`` of every document.

    ``taken`` counts the words of all copies in the stream; ``first_position`` is null without any.
    """
    found = mix.stream.groupBy("row").agg(
        F.sum("words").alias("taken"), F.min("position").alias("first")
    )
    known = sent_if_small(mix.sources.withColumnRenamed("source", "_source"), _SOURCE_BYTES)
    rows = mix.documents.join(found, "row", "left").join(
        known, F.col("source").eqNullSafe(F.col("_source"))
    )
    return rows.select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.round("first", 6).alias("first_position"),
    )
