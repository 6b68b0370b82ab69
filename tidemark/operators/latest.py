"""Latest record per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranks import SENT_BYTES, written
from tidemark.session import work_dir

_HASH_BYTES = 64  # of a hash that is sent to every task, at most

def latest_per_key(
    df: DataFrame,
    keys: str | list[str],
    order_by: list[Column | str],
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per key, the greatest by ``order_by``; rows with a null key are left out.

    Only ``columns``, all by default, are in the result and carried along.

    Written as an aggregate, so each task first reduces its own rows and a key that holds a large
    share of the input reaches the shuffle as one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = df.columns if columns is None else list(columns)
    others = [c for c in columns if c not in keys]
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    position = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    newest = F.max_by(F.struct(*others), position).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*columns)


def latest_of_stored(
    df: DataFrame, key: str, order_by: list[Column | str], folder: str | None = None
) -> DataFrame:
    """:func:`latest_per_key` of a stored table in which few keys come more than once.

    Only a hash of each key is shuffled to find those; rows of all other keys stay where they are. If
    the hashes that come again are too many to be sent to every task, all rows are shuffled and the
    result is stored. Rows that are reduced are stored below ``folder``, so all readers see the same.
    """
    folder = folder or work_dir(df.sparkSession, "latest")
    named = df.where(F.col(key).isNotNull())
    parts = _by_repeated_hash(named, key, folder)
    if parts is None:
        return written(latest_per_key(df, key, order_by), f"{folder}/latest")
    once, several = parts
    if several is None:
        return once
    return once.unionByName(written(latest_per_key(several, key, order_by), f"{folder}/latest"))


def counted_in_stored(df: DataFrame, key: str, name: str, folder: str | None = None) -> DataFrame:
    """Stored rows with ``name``, the number of rows that have their key; null is a key like others.

    As in :func:`latest_of_stored` only a hash of each key is shuffled, and rows whose hash comes again.
    """
    every = F.count("*").over(Window.partitionBy(key)).alias(name)
    parts = _by_repeated_hash(df, key, folder or work_dir(df.sparkSession, "counted"))
    if parts is None:
        return df.select("*", every)
    once, several = parts
    once = once.select("*", F.lit(1).cast("long").alias(name))
    return once if several is None else once.unionByName(several.select("*", every))


def _by_repeated_hash(
    df: DataFrame, key: str, folder: str
) -> tuple[DataFrame, DataFrame | None] | None:
    """Rows whose key's hash comes once, and the others if there are any.

    None if the hashes that come again are too many to be sent to every task.
    """
    own = F.xxhash64(key)
    counts = df.groupBy(own.alias("_again")).agg(F.count("*").alias("_n")).where("_n > 1")
    again = written(counts.select("_again"), f"{folder}/again")
    repeated = again.count()
    if repeated * _HASH_BYTES > SENT_BYTES:
        return None
    if not repeated:
        return df, None
    again = F.broadcast(again)
    comes_again = own == F.col("_again")
    return df.join(again, comes_again, "left_anti"), df.join(again, comes_again, "left_semi")
