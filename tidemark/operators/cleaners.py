"""One cleaner per feed: raw feed records in, typed rows out.

Every cleaner keeps ``ts_ms`` and ``offset`` so that later steps can tell which change came last.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    as_date,
    date_from_epoch_days,
    day_key,
    decode_decimal,
    normalize_phone,
)
from tidemark.operators.envelope import FEED_ORDER, change_time, open_envelope
from tidemark.schemas import SILVER_CUSTOMER, SILVER_PRODUCT

# How late records may be.
EVENT_LATENESS = "5 minutes"
TRANSACTION_LATENESS = "10 minutes"


def clean_customer(raw: DataFrame, strict_compat: bool = False) -> DataFrame:
    """Customers without deletes; a record without an operation is dropped as well."""
    changes = open_envelope(raw, "customer").where(F.col("op") != "d")
    return changes.select(
        "customer_id", "first_name", "last_name", "gender",
        date_from_epoch_days(F.col("date_of_birth")).alias("date_of_birth"),
        "email",
        normalize_phone(F.col("phone_number"), strict_compat).alias("phone_number"),
        "country",
        date_from_epoch_days(F.col("creation_date")).alias("customer_creation_date"),
        *FEED_ORDER,
    ).select(*SILVER_CUSTOMER.names, *FEED_ORDER)


def clean_product(raw: DataFrame) -> DataFrame:
    """Products with decoded prices; a record without a product id is a delete."""
    changes = open_envelope(raw, "product").where(F.col("product_id").isNotNull())
    return changes.withColumns(
        {
            "product_id": F.col("product_id").cast("string"),
            "price": decode_decimal(F.col("price")),
            "base_price": decode_decimal(F.col("base_price")),
        }
    ).select(*SILVER_PRODUCT.names, *FEED_ORDER)


def clean_transaction(
    raw: DataFrame,
    as_of: Column | dt.date | str | None = None,
    strict_compat: bool = False,
) -> DataFrame:
    """Transactions with decoded amounts, and an id for walk-in customers.

    A walk-in has a phone number but no customer id; it gets one that is stable per phone and
    processing day. Records without a phone number (deletes among them) are dropped.
    """
    changes = (
        open_envelope(raw, "transaction")
        .withColumn("timestamp", change_time())
        .where(F.col("phone_number").isNotNull())
    )
    if raw.isStreaming:
        changes = changes.withWatermark("timestamp", TRANSACTION_LATENESS)
    phone = normalize_phone(F.col("phone_number"), strict_compat)
    return (
        changes.withColumns(
            {
                "price": decode_decimal(F.col("price")),
                "total_amount": decode_decimal(F.col("total_amount")),
                "phone_number": phone,
                "is_new_customer": F.col("customer_id").isNull(),
            }
        )
        .withColumn(
            "customer_id",
            F.coalesce(F.col("customer_id"), day_key(F.col("phone_number"), as_date(as_of))),
        )
        .drop("op")
    )


def clean_event(raw: DataFrame, strict_compat: bool = False) -> DataFrame:
    """Activity events; ``strict_compat`` keeps records without a customer."""
    events = open_envelope(raw, "event").drop("op")
    if raw.isStreaming:
        events = events.withWatermark("time_stamp", EVENT_LATENESS)
    return events if strict_compat else events.where(F.col("customer_id").isNotNull())
