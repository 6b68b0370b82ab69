"""Reports over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join

_UNKNOWN = "Unknown"


def revenue_by_type_quarter(
    facts: DataFrame, dim_product: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Units, revenue and sales by product type, year and quarter.

    Sales are summed per product and quarter first, with the calendar broadcast, so the product
    dimension meets sums and not single sales.
    """
    days = F.broadcast(dim_date.select("date_key", "year", "quarter"))
    per_product = (
        facts.join(days, "date_key", "left")
        .groupBy("product_sk", "year", "quarter")
        .agg(*_sums(F.count("*")))
    )
    types = dim_product.select("product_sk", "product_type")
    typed = lookup_join(per_product, types, "product_sk")
    return typed.groupBy(
        F.coalesce("product_type", F.lit(_UNKNOWN)).alias("product_type"), "year", "quarter"
    ).agg(*_sums(F.sum("sales")))


def revenue_by_day(facts: DataFrame, first_day: int, last_day: int) -> DataFrame:
    """Units, revenue and sales per day from one ``date_key`` to another, both included.

    Both bounds, and the months they imply where facts are stored by month, reach the scan.
    """
    chosen = facts.where(F.col("date_key").between(first_day, last_day))
    if "sale_month" in facts.columns:
        chosen = chosen.where(F.col("sale_month").between(first_day // 100, last_day // 100))
    return chosen.groupBy("date_key").agg(*_sums(F.count("*")))


def revenue_by_weekday(facts: DataFrame, dim_date: DataFrame, year: int, quarter: int) -> DataFrame:
    """Units, revenue and sales per day of the week in one quarter.

    ``facts`` lie by ``sale_month``. The calendar's rows for the quarter are found when the query
    runs, and their months choose the folders that are read.
    """
    chosen = dim_date.where((F.col("year") == year) & (F.col("quarter") == quarter)).select(
        "date_key", "day_of_week",
        F.expr("CAST(date_key div 100 AS INT)").alias("sale_month"),
    )
    days = F.broadcast(chosen)  # a quarter of a calendar
    return facts.join(days, ["sale_month", "date_key"]).groupBy("day_of_week").agg(
        *_sums(F.count("*"))
    )


def revenue_by_country(facts: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Units, revenue and sales by the customer's country; walk-ins count as unknown."""
    per_customer = facts.groupBy("customer_sk").agg(*_sums(F.count("*")))
    countries = dim_customer.select("customer_sk", "country")
    located = lookup_join(per_customer, countries, "customer_sk")
    return located.groupBy(F.coalesce("country", F.lit(_UNKNOWN)).alias("country")).agg(
        *_sums(F.sum("sales"))
    )


def _sums(sales):
    return (
        F.sum("quantity").alias("quantity"),
        F.sum("total_amount").alias("total_amount"),
        sales.alias("sales"),
    )
