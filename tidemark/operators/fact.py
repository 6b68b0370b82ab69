"""Fact rows with resolved surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import day_key, transaction_key
from tidemark.operators.asof import version_on_day
from tidemark.operators.lookup import lookup_join, lookup_of_stored
from tidemark.operators.ranks import written
from tidemark.operators.scd2 import current_versions
from tidemark.schemas import FACT_TRANSACTION, conform
from tidemark.session import work_dir

# What facts take from transactions.
SOLD = (
    "transaction_id", "customer_id", "product_id", "price", "quantity", "total_amount", "timestamp",
)

_WALK_IN = "is_new_customer"  # set by the cleaner
_PASSES = 4  # over the ids of facts that are repaired


def build_fact(
    transactions: DataFrame,
    dim_customer: DataFrame | None,
    dim_product: DataFrame | None,
    dim_date: DataFrame,
    sk: str = "md5",
    strategy: str | None = None,
    on_sale_day: bool = False,
    found: str | None = None,
) -> DataFrame:
    """One fact row per cleaned transaction, keyed to the dimensions' current versions.

    With ``on_sale_day`` it is keyed to the versions that were valid on the day of the sale. A customer
    or product that no dimension knows yet gets the key its version of that day would have. A day
    outside the calendar leaves ``date_key`` null and keeps the row. ``strategy`` is a hint for the
    joins to the dimensions. With ``found``, a folder for what the keys find, the transactions are stored
    and read several times: their keys are looked up first, so that few rows are shuffled.

    A dimension may be None for readers that do not use its key: the key is left out then, and the
    facts are not shuffled for it. All else is the same, as a lookup neither adds nor drops rows.
    """
    return with_keys(
        fact_rows(
            transactions, dim_customer, dim_product, dim_date, strategy, on_sale_day, found
        ),
        sk,
    )


def fact_rows(
    transactions: DataFrame,
    dim_customer: DataFrame | None,
    dim_product: DataFrame | None,
    dim_date: DataFrame,
    strategy: str | None = None,
    on_sale_day: bool = False,
    found: str | None = None,
) -> DataFrame:
    """The rows of :func:`build_fact` before :func:`with_keys`.

    A key that derives from a day travels as that day, as random text hardly shrinks: the rows may be
    shuffled for the second dimension, and again where they are stored by month.
    """
    days = dim_date.select("date_key", F.col("date").alias("sale_date"))

    flag = [_WALK_IN] if found and _WALK_IN in transactions.columns else []
    rows = transactions.select(*SOLD, *flag)
    sale_date = F.to_date("timestamp")
    for dim, key, sk_name in (
        (dim_customer, "customer_id", "customer_sk"), (dim_product, "product_id", "product_sk")
    ):
        if dim is None:
            continue
        known = [sk_name, f"{sk_name}_day"]
        dim = _with_key_day(dim, key, sk_name)
        if on_sale_day:
            rows = version_on_day(rows, dim, key, sale_date, known)
            continue
        current = current_versions(dim).select(key, *known)
        if found and not strategy:
            rows = _looked_up(rows, current, key, f"{found}/{key}")
        else:
            rows = lookup_join(rows, current, key, strategy)
    # The calendar holds one row per day of a few decades whatever the data size.
    dated = rows.drop(*flag).withColumn("sale_date", sale_date)
    return dated.join(F.broadcast(days), "sale_date", "left")


def _looked_up(rows: DataFrame, current: DataFrame, key: str, path: str) -> DataFrame:
    """Rows of stored transactions with the current versions of ``key``.

    Walk-ins have versions of their own days, so their customers are looked up apart.
    """
    if key != "customer_id" or _WALK_IN not in rows.columns:
        return lookup_of_stored(rows, current, key, f"{path}/found")
    current = written(current, f"{path}/current")
    walk_in = F.coalesce(F.col(_WALK_IN), F.lit(False))
    return lookup_of_stored(rows.where(~walk_in), current, key, f"{path}/found").unionByName(
        lookup_join(rows.where(walk_in), current, key)
    )


def with_keys(rows: DataFrame, sk: str = "md5", *extra: str) -> DataFrame:
    """Facts out of :func:`fact_rows`, with any ``extra`` columns of these.

    The day of the sale follows from its time, so it need not travel either. Rows that have a ``transaction_sk`` already keep it.
    """
    if "sale_date" not in rows.columns:
        rows = rows.withColumn("sale_date", F.to_date("timestamp"))
    drawn = "transaction_sk" in rows.columns
    own = F.col("transaction_sk") if drawn else transaction_key(F.col("transaction_id"), sk)
    looked_up = {
        sk_name: _or_day_key(sk_name, key)
        for sk_name, key in (("customer_sk", "customer_id"), ("product_sk", "product_id"))
        if sk_name in rows.columns
    }
    named = rows.withColumns(
        looked_up
        | {
            "transaction_sk": own,
            "unit_sales_price": F.col("price"),
            "time_stamp": F.col("timestamp"),
        }
    )
    there = [field for field in FACT_TRANSACTION if field.name in named.columns]
    return conform(named, T.StructType(there), *extra)


def _with_key_day(dim: DataFrame, key: str, sk: str) -> DataFrame:
    """The dimension with a column for the day that its key derives from; the key is null then."""
    day = F.col("effective_date")
    derived = F.coalesce(F.col(sk) == day_key(F.col(key), day), F.lit(False))
    return dim.withColumns({sk: F.when(~derived, F.col(sk)), f"{sk}_day": F.when(derived, day)})


def _or_day_key(sk: str, natural_key: str) -> Column:
    day = F.coalesce(f"{sk}_day", "sale_date")
    return F.coalesce(F.col(sk), day_key(F.col(natural_key), day))


def repair_facts(
    facts: DataFrame,
    transactions: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    folder: str | None = None,
    **options,
) -> DataFrame:
    """``facts`` with those built anew whose customer or product was unknown and has a key by now.

    A fact is built anew if one of its keys is in no dimension, from its row of ``transactions``,
    by :func:`build_fact` with the same ``options``. All others stay as they are. A fact whose
    transaction is not given stays, too.

    Both sides are told apart in passes, each over the ids of some hashes, and what a pass finds is
    written below ``folder``. So only the rows of one pass are shuffled at a time, and a fact that is
    built anew is so once.
    """
    spark = facts.sparkSession
    folder = folder or work_dir(spark, "repair")

    def unknown(dim: DataFrame, sk: str) -> DataFrame:
        found = facts.join(dim.select(sk), sk, "left_anti").select("transaction_id")
        return written(found, f"{folder}/unknown/{sk}")

    def every(rows: DataFrame, name: str) -> DataFrame:
        return spark.read.schema(rows.schema).parquet(*[f"{folder}/{name}/{n}" for n in range(_PASSES)])

    pending = unknown(dim_customer, "customer_sk").union(unknown(dim_product, "product_sk"))
    sold = transactions.select(*[c for c in (*SOLD, _WALK_IN) if c in transactions.columns])
    for n in range(_PASSES):
        of_pass = F.pmod(F.xxhash64("transaction_id"), F.lit(_PASSES)) == n
        again = sold.where(of_pass).join(pending.where(of_pass), "transaction_id", "left_semi")
        done = written(again, f"{folder}/again/{n}").select("transaction_id").distinct()
        written(
            facts.where(of_pass).join(done, "transaction_id", "left_anti"), f"{folder}/stay/{n}"
        )
    built = build_fact(
        every(sold, "again"), dim_customer, dim_product, dim_date,
        **{"found": f"{folder}/found"} | options,
    )
    return every(facts, "stay").unionByName(built.select(*facts.columns))
