"""Left join to a table with unique keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranks import SENT_BYTES, written

_KEY_BYTES = 128  # of a key with its values that is sent to every task, at most


def lookup_join(
    rows: DataFrame, lookup: DataFrame, key: str, strategy: str | None = None
) -> DataFrame:
    """Add the columns of ``lookup`` to every row; null where the key is unknown.

    ``lookup`` has one row per key and otherwise only columns that ``rows`` lacks. How the sides
    meet is left to adaptive execution: it sends a side whose size in bytes is below Spark's
    threshold to all tasks, and splits the partitions of frequent and of missing keys, as a left
    join may. ``strategy`` is a join hint that overrides the choice; no strategy changes the result.
    """
    values = [c for c in lookup.columns if c != key]
    side = lookup.hint(strategy) if strategy else lookup
    return rows.join(side, key, "left").select(*rows.columns, *values)


def lookup_of_stored(rows: DataFrame, lookup: DataFrame, key: str, path: str) -> DataFrame:
    """:func:`lookup_join` of stored rows, which stay where they are if most keys find the same.

    Only the distinct keys of the rows are looked up. The values that most of them find are added to
    every row; the other keys, unknown ones among them, are sent to all tasks with their own values.
    If these are too many to be sent, the rows are shuffled as in any join. What the keys find is
    written to ``path`` and must stay until the result has been read.
    """
    values = [c for c in lookup.columns if c != key]
    wanted = rows.select(key).where(F.col(key).isNotNull()).distinct()
    found = written(lookup_join(wanted, lookup, key), path)
    most = found.groupBy(*values).agg(F.count("*").alias("_n")).orderBy(F.desc("_n")).limit(1)
    usual = most.drop("_n").collect()
    if not usual:  # no row has a key
        return rows.select("*", *[F.lit(None).cast(lookup.schema[v].dataType).alias(v) for v in values])
    usual = {v: F.lit(usual[0][v]).cast(lookup.schema[v].dataType) for v in values}
    others = found.where(~reduce(and_, [F.col(v).eqNullSafe(x) for v, x in usual.items()]))
    if others.count() * _KEY_BYTES > SENT_BYTES:
        return lookup_join(rows, lookup, key)
    own = others.select(F.col(key).alias("_of"), F.struct(*values).alias("_own"))
    met = rows.join(F.broadcast(own), F.col(key) == F.col("_of"), "left")
    return met.select(
        *rows.columns,
        *[
            F.when(F.col("_of").isNotNull(), F.col("_own").getField(v))
            .when(F.col(key).isNotNull(), x)
            .alias(v)
            for v, x in usual.items()
        ],
    )
