"""Customers that are known only from a purchase."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_date
from tidemark.operators.envelope import FEED_ORDER
from tidemark.operators.scd2 import merge_dim_customer
from tidemark.operators.upsert import PLACEHOLDER
from tidemark.schemas import SILVER_CUSTOMER


def placeholder_customers(transactions: DataFrame) -> DataFrame:
    """A customer record per walk-in transaction; everything but id, phone and day is unknown."""
    known = ("customer_id", "phone_number", "customer_creation_date")
    unknown = [F.lit(PLACEHOLDER).alias(c) for c in SILVER_CUSTOMER.names
               if c not in (*known, "date_of_birth")]
    return (
        transactions.where("is_new_customer")
        .select(
            "customer_id",
            "phone_number",
            F.to_date("timestamp").alias("customer_creation_date"),
            F.lit(None).cast("date").alias("date_of_birth"),
            *unknown,
            *FEED_ORDER,
        )
        .select(*SILVER_CUSTOMER.names, *FEED_ORDER)
    )


def with_placeholders(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Cleaned customers together with the placeholders, by column name."""
    return customers.unionByName(placeholder_customers(transactions), allowMissingColumns=True)


def customers_by_day(
    customers: DataFrame, transactions: DataFrame, as_of: Column | dt.date | str | None
) -> DataFrame:
    """All customer records of a batch with the ``day`` from which the dimension counts them.

    Registered customers count from the processing day, walk-ins from their purchase day.
    """
    return customers.withColumn("day", as_date(as_of)).unionByName(
        placeholder_customers(transactions).withColumn("day", F.col("customer_creation_date"))
    )


def insert_walkins(dim_customer: DataFrame, transactions: DataFrame) -> DataFrame:
    """Give every walk-in a version per purchase day, before the fact rows look them up."""
    return merge_dim_customer(
        dim_customer,
        placeholder_customers(transactions),
        as_of=F.col("customer_creation_date"),
    )
