"""Keyed merges, written as union and latest-wins aggregation.

A full outer join would shuffle both sides by key; the union is reduced before it is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.schemas import SILVER_TRANSACTION, conform

PLACEHOLDER = "Unknown"  # fixed value

# Fixed order: what wins over what for one key.
_INSERT_ONLY, _STORED, _UPDATE = 0, 1, 2


def _key_list(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str | list[str],
    order_by: list[Column | str],
    guard: Column | None = None,
) -> DataFrame:
    """Replace matched rows, insert the others, keep the rest.

    Several source records per key count as one, the latest. A record that fails ``guard`` (or for
    which it is null) never replaces anything, yet is inserted when its key is new.
    """
    keys = _key_list(key)
    may_update = F.lit(True) if guard is None else guard
    ranked = source.withColumn("_rank", F.when(may_update, _UPDATE).otherwise(_INSERT_ONLY))
    incoming = latest_per_key(ranked, keys, ["_rank", *order_by], [*target.columns, "_rank"])
    incoming = conform(incoming, target.schema, "_rank")
    rows = target.withColumn("_rank", F.lit(_STORED)).unionByName(incoming)
    return latest_per_key(rows, keys, ["_rank"]).select(*target.columns)


def is_named() -> Column:
    """Whether a customer record is no placeholder; the others never replace a stored one."""
    return F.col("first_name") != PLACEHOLDER


def upsert_customer(target: DataFrame, source: DataFrame, order_by: list) -> DataFrame:
    """Customer upsert in which placeholder records never replace a known customer."""
    return upsert(target, source, "customer_id", order_by, is_named())


def upsert_product(target: DataFrame, source: DataFrame, order_by: list) -> DataFrame:
    return upsert(target, source, "product_id", order_by)


def transaction_rows(transactions: DataFrame, *extra: str) -> DataFrame:
    """The eight stored columns of cleaned transactions."""
    return conform(transactions, SILVER_TRANSACTION, *extra)


def append_transactions(target: DataFrame, transactions: DataFrame, order_by: list) -> DataFrame:
    """Add transactions; one row per transaction id remains, so a replay changes nothing."""
    return upsert(target, transactions, "transaction_id", order_by)


def merge_documents(
    target: DataFrame,
    updates: DataFrame,
    key: str | list[str],
) -> DataFrame:
    """Field-wise document merge: an update sets the fields it carries, the others survive.

    Updates hold one row per key with any subset of the target's columns. A key without a document
    creates one.
    """
    keys = _key_list(key)
    fields = [c for c in target.columns if c not in keys]
    rows = target.withColumn("_new", F.lit(False)).unionByName(
        updates.withColumn("_new", F.lit(True)), allowMissingColumns=True
    )
    for name in keys:
        rows = rows.where(F.col(name).isNotNull())
    return newest_fields(rows, keys, fields, "_new").select(*target.columns)


def newest_fields(
    rows: DataFrame, keys: list[str], fields: list[str], order_by: str
) -> DataFrame:
    """One row per key: for each field its last value that is not null."""
    newest = [
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order_by))).alias(c) for c in fields
    ]
    return rows.groupBy(*keys).agg(*newest)
