"""Rows met by the version of a dimension that was valid on their day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranks import stored

# Lengths of the steps along a history; together they are more than the days from year 1 to 9999.
_STEPS = [1 << n for n in range(21, -1, -1)]


def version_on_day(
    rows: DataFrame, versions: DataFrame, key: str, day: str | Column, values: Sequence[str]
) -> DataFrame:
    """``rows`` with the ``values`` of the key's last version from ``effective_date <= day``.

    They are null where the key or the day is null, unknown, or before the first version.
    ``versions`` has at most one row per key and ``effective_date``. Both sides are read once.

    The rows meet the history of their key, its versions in order, by equality, so they are shuffled
    once and adaptive execution splits a busy key as in any left join. A history has a version per day
    at most; the one that is valid is found in it by halving, so no row is compared with all versions.
    """
    day = F.col(day) if isinstance(day, str) else day
    version = F.struct(F.col("effective_date").alias("_from"), *values)
    histories = versions.groupBy(key).agg(F.sort_array(F.collect_list(version)).alias("_history"))
    met = rows.join(stored(histories, "histories"), key, "left")

    def further(at: Column, length: Column) -> Column:
        begins = F.get("_history", at + length - 1).getField("_from")
        later = F.coalesce(begins > day, F.lit(False))
        return F.when((at + length <= F.size("_history")) & ~later, at + length).otherwise(at)

    begun = F.aggregate(F.array(*[F.lit(n) for n in _STEPS]), F.lit(0), further)
    valid = F.when(day.isNotNull(), F.get("_history", begun - 1)).alias("_version")
    return met.select(*rows.columns, valid).select(
        *rows.columns, *[F.col("_version").getField(v).alias(v) for v in values]
    )
