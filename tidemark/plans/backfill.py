"""A first load of the catalog tables from a bounded feed."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.calendar import dim_date
from tidemark.operators.cleaners import (
    clean_customer,
    clean_event,
    clean_product,
    clean_transaction,
)
from tidemark.operators.envelope import FEED_ORDER
from tidemark.operators.fact import build_fact
from tidemark.operators.latest import latest_of_stored, latest_per_key
from tidemark.operators.logs import activity_log
from tidemark.operators.ranks import written
from tidemark.operators.resolve import in_time, phone_pages
from tidemark.operators.scd2 import first_dim_customer, first_dim_product
from tidemark.operators.upsert import transaction_rows, upsert_customer, upsert_product
from tidemark.operators.walkins import customers_by_day, with_placeholders
from tidemark.schemas import SILVER_CUSTOMER, SILVER_PRODUCT, TABLES
from tidemark.session import together, work_dir
from tidemark.sources.batch_table import delete_folder
from tidemark.sources.tables import create_tables, populate_once


def load_tables(
    spark: SparkSession, raw: DataFrame, root: str, as_of: dt.date | str
) -> None:
    """Declare all tables below ``root`` and fill every one from the records in ``raw``.

    The feed is written to the raw table first and read from there, so each record is read once
    more at most, and parsed once: cleaned records are files until the load ends. Each table is overwritten whole, so a load can be repeated. The
    tables are plain parquet, to be read by any SQL front end; feeds that go on are the business of
    ``streaming.lake``.
    """
    create_tables(spark, root)
    _fill("raw_table", raw)
    bronze = spark.table(TABLES["raw_table"].qualified)
    cleaned = {
        "customers": clean_customer(bronze),
        "products": clean_product(bronze),
        "sales": clean_transaction(bronze, as_of).drop("source"),
        "events": clean_event(bronze),
    }
    no_customers = spark.createDataFrame([], SILVER_CUSTOMER)
    no_products = spark.createDataFrame([], SILVER_PRODUCT)
    read_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    kept = work_dir(spark, "cleaned")
    try:
        customers, products, sales, events = together(
            spark, *[partial(written, rows, f"{kept}/{name}") for name, rows in cleaned.items()]
        )
        sales = latest_of_stored(sales, "transaction_id", list(FEED_ORDER), f"{kept}/latest")
        everyone = with_placeholders(customers, sales)
        dated = customers_by_day(customers, sales, as_of)
        newest = latest_per_key(customers, "customer_id", FEED_ORDER)
        bought = phone_pages(sales.where(in_time(read_at)), kept=True)
        days = dim_date(spark, as_of)
        together(
            spark,
            lambda: _fill("silver_customer", upsert_customer(no_customers, everyone, FEED_ORDER)),
            lambda: _fill("silver_product", upsert_product(no_products, products, FEED_ORDER)),
            lambda: _fill("silver_transaction", transaction_rows(sales)),
            lambda: _fill("dim_customer", first_dim_customer(dated, F.col("day"))),
            lambda: _fill("dim_product", first_dim_product(products, as_of)),
            lambda: populate_once(spark, TABLES["dim_date"].qualified, days),
            lambda: _fill("people", newest),
            lambda: _fill("activity", activity_log(events, kept=True)),
            lambda: _fill("purchases", bought),
        )
        dims = (spark.table(TABLES[n].qualified) for n in ("dim_customer", "dim_product", "dim_date"))
        _fill("fact_transaction", build_fact(sales, *dims, found=f"{kept}/found"))
    finally:
        delete_folder(spark, kept)


def _fill(name: str, rows: DataFrame) -> None:
    spec = TABLES[name]
    kept = [c for c in spec.schema.names if c not in spec.partition_by]
    rows.select(*kept, *spec.partition_by).write.insertInto(spec.qualified, overwrite=True)
