"""Routing feed records and opening the change envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import is_undecodable, timestamp_from_millis
from tidemark.schemas import (
    CUSTOMER_PAYLOAD,
    EVENT_PAYLOAD,
    PRODUCT_PAYLOAD,
    TRANSACTION_PAYLOAD,
    envelope,
)

# The feeds' routing keys, with payload and Base64 decimal fields.
PAYLOADS = {
    "customer": (CUSTOMER_PAYLOAD, ()),
    "product": (PRODUCT_PAYLOAD, ("price", "base_price")),
    "transaction": (TRANSACTION_PAYLOAD, ("price", "total_amount")),
    "event": (EVENT_PAYLOAD, ()),
}

# Plain numbers and the stored type that they must fit.
NUMBERS = {"transaction": {"quantity": "decimal(10,2)"}}

# Order of the change records of one key: source clock first, then feed position.
FEED_ORDER = ("ts_ms", "offset")


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """One feed out of several with the same columns, duplicates kept."""
    combined = feeds[0]
    for feed in feeds[1:]:
        combined = combined.union(feed)
    return combined


def route(raw: DataFrame, key: str) -> DataFrame:
    """One table's records; on bronze the key is the partition column, so this prunes files."""
    return raw.where(F.col("key") == key)


def parse(raw: DataFrame, key: str) -> DataFrame:
    """One table's records with the parsed ``change``, which keeps the text of malformed ones.

    Cleaners and :func:`quarantine` take the result, or that of :func:`judged`, in place of the feed,
    so that a record which both of them see is parsed once.
    """
    if "change" in raw.columns:
        return route(raw, key)
    payload, _ = PAYLOADS[key]
    schema = envelope(payload).add("_corrupt", T.StringType())
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    return route(raw, key).withColumn("change", F.from_json("value", schema, options))


def open_envelope(raw: DataFrame, key: str) -> DataFrame:
    """The flattened after-image with ``op``, ``ts_ms`` and the numeric feed ``offset``.

    Malformed or empty values and deletes become rows of nulls; the cleaners decide about those.
    The parsed record passes through ``inline``, which later filters do not cross, so a record is
    parsed once and not again for each filter that would otherwise be pushed below the parsing.
    """
    parsed = parse(raw, key).select(
        F.col("offset").try_cast("bigint").alias("offset"), F.inline(F.array("change"))
    )
    return parsed.select("after.*", "op", "ts_ms", "offset")


def judged(raw: DataFrame, key: str) -> DataFrame:
    """One table's parsed records with the ``reason`` why one cannot be read or stored whole.

    The text of all others is left out, so records that several steps read are kept once, parsed.
    As in :func:`open_envelope`, the parsed record passes through ``inline``: each reason looks into
    it, and a filter on the reason would parse it anew for each.
    """
    if "reason" in raw.columns:
        return route(raw, key)
    parsed = parse(raw, key)
    others = [name for name in parsed.columns if name != "change"]
    parsed = parsed.select(*others, F.inline(F.array(F.struct("change"))))
    _, decimals = PAYLOADS[key]
    reason = F.when(F.col("change._corrupt").isNotNull(), F.lit("malformed json"))
    for name in decimals:
        reason = reason.when(is_undecodable(F.col(f"change.after.{name}")), f"undecodable {name}")
    for name, stored in NUMBERS.get(key, {}).items():
        value = F.col(f"change.after.{name}")
        reason = reason.when(
            value.isNotNull() & value.try_cast(stored).isNull(), f"overflowing {name}"
        )
    return (
        parsed.withColumn("reason", reason)
        .withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
    )


def quarantine(raw: DataFrame, key: str) -> DataFrame:
    """Feed records that cannot be read or stored whole, unchanged, with the reason."""
    found = judged(raw, key).where(F.col("reason").isNotNull())
    return found.select("offset", "topic", "key", "value", "reason")


def change_time() -> Column:
    return timestamp_from_millis(F.col("ts_ms"))
