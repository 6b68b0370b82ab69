"""Type 2 dimensions: one row per version, keyed by natural key and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import OPEN_END, as_date, day_key
from tidemark.operators.latest import latest_per_key
from tidemark.schemas import DIM_CUSTOMER, DIM_PRODUCT, conform


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where("is_current")


def new_versions(
    records: DataFrame,
    key: str,
    sk: str,
    as_of: Column | dt.date | str | None,
    order_by: list[Column | str],
) -> DataFrame:
    """At most one version per key and day, the last record of the day; the surrogate key is null.

    The reduction runs before the shuffle. Whatever share of the records one key holds, it leaves
    at most one row per day, which bounds the group that :func:`chain_versions` sorts.
    """
    dated = records.withColumn("effective_date", as_date(as_of))
    daily = latest_per_key(dated, [key, "effective_date"], order_by)
    return daily.withColumn(sk, F.lit(None).cast("string"))


def chain_versions(rows: DataFrame, key: str, sk: str) -> DataFrame:
    """Close each version on the day the next one starts; the last one stays open and current.

    Of several rows of a key with the same day the one with the greatest ``_seq`` stays. Versions with
    ``_seq`` 1 are new and get their surrogate key here, behind the shuffle, as random text hardly
    shrinks.
    """
    history = Window.partitionBy(key).orderBy("effective_date", "_seq")
    chained = rows.withColumn("_next", F.lead("effective_date").over(history))
    last_of_day = F.col("_next").isNull() | (F.col("_next") > F.col("effective_date"))
    return (
        chained.where(last_of_day)
        .withColumns(
            {
                "expired_date": F.coalesce(F.col("_next"), F.lit(OPEN_END)),
                "is_current": F.col("_next").isNull(),
                sk: F.when(
                    F.col("_seq") == 1, day_key(F.col(key), F.col("effective_date"))
                ).otherwise(F.col(sk)),
            }
        )
        .drop("_next", "_seq")
    )


def scd2_merge(
    dim: DataFrame,
    records: DataFrame,
    key: str,
    sk: str,
    as_of: Column | dt.date | str | None = None,
    order_by: list[Column | str] = ("ts_ms", "offset"),
    guard: Column | None = None,
) -> DataFrame:
    """Merge change records into a dimension: close the current version, add the new one.

    There is no change detection, so every record makes a version. ``as_of`` is the day for the
    whole batch or a column with a day per record; a late record takes its place in the history.
    ``guard`` leaves records out.
    """
    if guard is not None:
        records = records.where(guard)
    incoming = new_versions(records, key, sk, as_of, list(order_by))
    kept = [c for c in dim.columns if c not in ("expired_date", "is_current")]
    schema = dim.select(*kept).schema
    rows = dim.select(*kept, F.lit(0).alias("_seq")).unionByName(
        conform(incoming, schema).withColumn("_seq", F.lit(1))
    )
    return chain_versions(rows, key, sk).select(*dim.columns)


def scd2_from_log(
    records: DataFrame,
    key: str,
    sk: str,
    as_of: Column | dt.date | str | None,
    order_by: list[Column | str],
) -> DataFrame:
    """The whole history in one pass over a complete change log."""
    rows = new_versions(records, key, sk, as_of, order_by).withColumn("_seq", F.lit(1))
    return chain_versions(rows, key, sk)


def merge_dim_customer(dim: DataFrame, records: DataFrame, as_of=None, **options) -> DataFrame:
    return scd2_merge(dim, records, "customer_id", "customer_sk", as_of, **options)


def merge_dim_product(dim: DataFrame, records: DataFrame, as_of=None, **options) -> DataFrame:
    return scd2_merge(dim, records, "product_id", "product_sk", as_of, **options)


def first_dim_customer(records: DataFrame, as_of, order_by=("ts_ms", "offset")) -> DataFrame:
    """A new customer dimension out of cleaned customers."""
    dim = scd2_from_log(records, "customer_id", "customer_sk", as_of, list(order_by))
    return conform(dim, DIM_CUSTOMER)


def first_dim_product(records: DataFrame, as_of, order_by=("ts_ms", "offset")) -> DataFrame:
    """A new product dimension out of cleaned products."""
    dim = scd2_from_log(records, "product_id", "product_sk", as_of, list(order_by))
    return conform(dim, DIM_PRODUCT)
