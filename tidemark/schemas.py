"""Feed, payload and table schemas, declared once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _columns(text: str) -> T.StructType:
    """A schema from ``name type, name type``; needs no session, unlike a DDL string."""
    schema = T.StructType()
    for column in text.split(", "):
        name, type_name = column.split()
        schema = schema.add(name, type_name)
    return schema


# Field names and types of the feeds and of the stored tables.

FEED = _columns("offset string, topic string, key string, value string")
UNREADABLE = _columns("offset string, topic string, key string, value string, reason string")

CUSTOMER_PAYLOAD = _columns(
    "customer_id string, first_name string, last_name string, gender string, "
    "date_of_birth integer, email string, phone_number string, address string, country string, "
    "creation_date integer"
)
PRODUCT_PAYLOAD = _columns(
    "product_id integer, product_name string, product_link string, price string, "
    "base_price string, currency string, sale_percents string, product_type string"
)
TRANSACTION_PAYLOAD = _columns(
    "transaction_id string, customer_id string, product_id string, phone_number string, "
    "product_name string, price string, quantity long, total_amount string, event_time long, "
    "source string"
)
EVENT_PAYLOAD = _columns(
    "event_id string, type string, customer_id string, url string, time_stamp timestamp"
)

_CUSTOMER_ATTRIBUTES = (
    "customer_id string, first_name string, last_name string, gender string, date_of_birth date, "
    "email string, phone_number string, country string, customer_creation_date date"
)
_PRODUCT_ATTRIBUTES = (
    "product_id string, product_name string, product_link string, price decimal(10,2), "
    "base_price decimal(10,2), currency string, sale_percents string, product_type string"
)
_VERSION = "effective_date date, expired_date date, is_current boolean"

SILVER_CUSTOMER = _columns(_CUSTOMER_ATTRIBUTES)
SILVER_PRODUCT = _columns(_PRODUCT_ATTRIBUTES)
SILVER_TRANSACTION = _columns(
    "transaction_id string, customer_id string, product_id string, product_name string, "
    "price decimal(10,2), quantity decimal(10,2), total_amount decimal(10,2), event_time string"
)
DIM_CUSTOMER = _columns(f"customer_sk string, {_CUSTOMER_ATTRIBUTES}, {_VERSION}")
DIM_PRODUCT = _columns(f"product_sk string, {_PRODUCT_ATTRIBUTES}, {_VERSION}")
DIM_DATE = _columns(
    "date_key integer, date date, year integer, month integer, day integer, "
    "day_of_week integer, quarter integer"
)
FACT_TRANSACTION = _columns(
    "transaction_sk string, date_key integer, customer_sk string, customer_id string, "
    "product_sk string, transaction_id string, unit_sales_price decimal(10,2), "
    "quantity decimal(10,2), total_amount decimal(10,2), time_stamp timestamp"
)

# Entries of the nested logs.
ACTIVITY_ENTRY = ("event_id", "type", "url", "time_stamp")
TRANSACTION_ENTRY = (
    "transaction_id", "product_id", "product_name", "price", "quantity", "total_amount",
)
FACT_ENTRY = ("transaction_id", "unit_sales_price", "quantity", "total_amount", "time_stamp")


def _log(log: str, entry: str, *keys: tuple[str, str]) -> T.StructType:
    schema = T.StructType()
    for name, type_name in keys:
        schema = schema.add(name, type_name)
    return schema.add(log, T.ArrayType(_columns(entry)))


ACTIVITY_PAGES = _log(
    "activity_log",
    "event_id string, type string, url string, time_stamp timestamp",
    ("customer_id", "string"), ("page", "integer"),
)
TRANSACTION_PAGES = _log(
    "transaction_log",
    "transaction_id string, product_id string, product_name string, price decimal(10,2), "
    "quantity long, total_amount decimal(10,2)",
    ("phone_number", "string"), ("page", "integer"),
)


@dataclass(frozen=True)
class TableSpec:
    """A stored table: its zone, columns, record key and the partition columns of its files."""

    zone: str
    name: str
    schema: T.StructType
    key: str | None = None
    partition_by: tuple[str, ...] = ()

    @property
    def qualified(self) -> str:
        return f"{self.zone}.{self.name}"


TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("raw", "raw_table", FEED, partition_by=("key",)),
        TableSpec("silver", "silver_customer", SILVER_CUSTOMER, "customer_id"),
        TableSpec("silver", "silver_product", SILVER_PRODUCT, "product_id"),
        TableSpec("silver", "silver_transaction", SILVER_TRANSACTION, "transaction_id"),
        TableSpec("gold", "dim_customer", DIM_CUSTOMER, "customer_sk"),
        TableSpec("gold", "dim_product", DIM_PRODUCT, "product_sk"),
        TableSpec("gold", "dim_date", DIM_DATE, "date_key"),
        TableSpec("gold", "fact_transaction", FACT_TRANSACTION, "transaction_sk"),
        TableSpec("profile", "people", SILVER_CUSTOMER, "customer_id"),
        TableSpec("profile", "activity", ACTIVITY_PAGES),
        TableSpec("profile", "purchases", TRANSACTION_PAGES),
    )
}


def envelope(payload: T.StructType) -> T.StructType:
    """The change envelope around a payload; the image before the change is never read."""
    return T.StructType(
        [
            T.StructField("after", payload),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


def conform(df: DataFrame, schema: T.StructType, *extra: str) -> DataFrame:
    """Select the schema's columns by name and type, then any extra columns as they are.

    A value that does not fit its column becomes null instead of failing the batch.
    """
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], *extra)
