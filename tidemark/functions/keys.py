"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_key(natural_key: Column, day: Column) -> Column:
    """Deterministic key of a natural key on a day; null if either part is null.

    Writers that have not seen each other's rows derive the same key, which a random one could not.
    """
    return F.md5(F.concat(natural_key, day.cast("string")))


def transaction_key(transaction_id: Column, how: str = "md5") -> Column:
    """``md5`` makes a replayed batch produce the same keys; ``uuid`` draws random ones."""
    if how == "md5":
        return F.md5(transaction_id)
    if how == "uuid":
        return F.uuid()
    raise ValueError(f"unknown transaction key: {how}")
