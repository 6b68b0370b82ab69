"""Positions and running sums within groups of any size, by a prefix sum over tasks.

A window needs all rows of a group in one task. Here rows are dealt out by range of group and order,
so a busy group fills as many tasks as its rows need; every task counts its own rows, and the counts
of the tasks before are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import work_dir
from tidemark.sources.batch_table import COMPRESSION

SENT_BYTES = 4 << 20  # of a table that is sent to every task, at most
_OFFSET_BYTES = 64  # of a group's name and sums


def numbered(
    df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], add: str | None = None
) -> DataFrame:
    """The rows of ``df`` with their ``position`` in their group, from 0.

    With ``add``, a column of numbers, also ``before``: its sum over the group's earlier rows, where
    nulls count as 0. Null groups are groups; nulls of the order come first; equal rows follow each
    other in any order. ``df`` is read twice, so it should be stored.
    """
    rows, keys = _dealt(df, groups, order)
    value = F.coalesce(F.col(add), F.lit(0)).cast("long") if add else F.lit(0).cast("long")
    per_task = rows.groupBy("_task", *keys).agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first"), F.sum(value).alias("_sum")
    )
    earlier = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        "_first": F.col("_first"),
        "_rows_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
        "_sum_before": F.coalesce(F.sum("_sum").over(earlier), F.lit(0)),
    }
    if add:
        own = Window.partitionBy("_task", *keys).orderBy("_at").rowsBetween(
            Window.unboundedPreceding, -1
        )
        rows = rows.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    met = _with_carried(rows, per_task, keys, carried, _OFFSET_BYTES)
    found = {"position": F.col("_rows_before") + F.col("_at") - F.col("_first")}
    if add:
        found["before"] = F.col("_sum_before") + F.col("_own")
    return met.select(*df.columns, *[column.alias(name) for name, column in found.items()])


def carried_forward(
    df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], value: str
) -> DataFrame:
    """The rows of ``df`` where ``value``, if null, is the last one before it in its group.

    A busy group is cut wherever its rows fill a task; the last value of the tasks before is carried
    into the next. ``df`` is read twice, so it should be stored.
    """
    rows, keys = _dealt(df, groups, order)
    per_task = rows.groupBy("_task", *keys).agg(
        F.max_by(F.struct(value), F.when(F.col(value).isNotNull(), F.col("_at"))).alias("_last")
    )
    earlier = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    carried = {"_before": F.last("_last", ignorenulls=True).over(earlier)}
    own = Window.partitionBy("_task", *keys).orderBy("_at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = rows.withColumn("_own", F.last(value, ignorenulls=True).over(own))
    met = _with_carried(rows, per_task, keys, carried, 4 * _OFFSET_BYTES)
    last = F.coalesce("_own", F.col("_before").getField(value))
    return met.select(*[last.alias(c) if c == value else F.col(c) for c in df.columns])


def _dealt(
    df: DataFrame, groups: Sequence[str], order: Sequence[str | Column]
) -> tuple[DataFrame, list[Column]]:
    """The rows sorted by range, stored, with the ``_task`` that held them and their place ``_at``."""
    keys = [F.col(name) for name in groups]
    by = [*keys, *order, F.col("_tie")]
    sorted_rows = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .drop("_tie")
        .withColumns({"_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    )
    return stored(sorted_rows, "ranks"), keys


def _with_carried(
    rows: DataFrame, per_task: DataFrame, keys: list[Column], carried: dict[str, Column], size: int
) -> DataFrame:
    """The rows with what the tasks before theirs hand on for their group."""
    offsets = per_task.select(
        F.col("_task").alias("_of"),
        *[key.alias(f"_of_{i}") for i, key in enumerate(keys)],
        *[column.alias(name) for name, column in carried.items()],
    )
    same = F.col("_task") == F.col("_of")
    for i, key in enumerate(keys):
        same = same & key.eqNullSafe(F.col(f"_of_{i}"))
    return rows.join(sent_if_small(stored(offsets, "offsets"), size), same)


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table written to the shared folder and read back, so that it is computed once."""
    return written(df, work_dir(df.sparkSession, name))


def written(df: DataFrame, path: str) -> DataFrame:
    """A table written to a path of its own and read back."""
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table, to be sent to every task if its rows are few bytes together."""
    return F.broadcast(df) if df.count() * row_bytes <= SENT_BYTES else df
