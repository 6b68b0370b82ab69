"""Change feeds derived from the given warehouse tables, in the connector's record format."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import encode_decimal
from tidemark.operators.envelope import union_feeds

# Topic names of the feeds.
TOPICS = {
    "customer": "e-commerce-customer.public.customer",
    "product": "e-commerce-product.public.product",
    "transaction": "e-commerce-transaction.public.transaction",
    "event": "e-commerce-event.public.event",
}


Feed = Callable[[SparkSession, str], DataFrame]
FEEDS: dict[str, Feed] = {}
_WRITTEN: dict[tuple[str, str], str] = {}


def feed(derive: Feed) -> Feed:
    """A feed derived from tables, or read from where :func:`write_feeds` has put it."""

    @wraps(derive)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _WRITTEN.get((derive.__name__, sf_dir))
        return spark.read.parquet(path) if path else derive(spark, sf_dir)

    FEEDS[derive.__name__] = read
    return read


def write_feeds(spark: SparkSession, sf_dir: str, folder: str, change=None) -> None:
    """Write every feed below ``folder``, to be read from there from now on.

    ``change`` may turn a feed of that name into another one before it is written.
    """
    for name, read in FEEDS.items():
        records = read(spark, sf_dir)
        (change(name, records) if change else records).write.parquet(f"{folder}/{name}")
    _WRITTEN.update({(name, sf_dir): f"{folder}/{name}" for name in FEEDS})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *by: str) -> DataFrame:
    """A table whose rows become feed records, which is costly per row.

    A file that Spark cannot split would leave that work to one core, so the rows are distributed
    first, by their key.
    """
    return table(spark, sf_dir, name).repartition(*by)


def record(
    key: str, offset: Column, after: Column, op: Column, ts_ms: Column
) -> list[Column]:
    """The four feed columns around an after-image."""
    change = F.struct(after.alias("after"), op.alias("op"), ts_ms.alias("ts_ms"))
    return [
        offset.cast("string").alias("offset"),
        F.lit(TOPICS[key]).alias("topic"),
        F.lit(key).alias("key"),
        F.to_json(change).alias("value"),
    ]


@feed
def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    digits = F.lpad(key.cast("string"), 8, F.lit("0"))
    head, tail = F.substring(digits, 1, 2), F.substring(digits, 3, 6)
    phone = (
        F.when(key % 3 == 0, F.concat(F.lit("+84 9"), head, F.lit("-"), tail))
        .when(key % 3 == 1, F.concat(F.lit("(09"), head, F.lit(") "), tail))
        .otherwise(F.concat(F.lit("09"), digits))
    )
    after = F.struct(
        key.cast("string").alias("customer_id"),
        F.lit("Customer").alias("first_name"),
        F.expr("substr(c_name, 10)").alias("last_name"),
        F.when(key % 2 == 1, "male").otherwise("female").alias("gender"),
        (key % 14000 - 3000).alias("date_of_birth"),
        F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
        phone.alias("phone_number"),
        F.lit("x").alias("address"),
        F.col("n_name").alias("country"),
        (F.lit(8766) + key % 365).alias("creation_date"),
    )
    op = F.when(key % 11 == 0, "u").otherwise("c")
    current = customers.select(*record("customer", key, after, op, F.lit(0)))
    gone = F.struct(F.concat(F.lit("gone"), key.cast("string")).alias("customer_id"))
    deletes = customers.where(key % 13 == 0).select(
        *record("customer", -key, gone, F.lit("d"), F.lit(0))
    )
    return current.union(deletes)


@feed
def product_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    after = F.struct(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit("URL "), key.cast("string")).alias("product_link"),
        encode_decimal(price).alias("price"),
        encode_decimal(price + F.col("p_size") / 100).alias("base_price"),
        F.lit("USD").alias("currency"),
        F.col("p_size").cast("string").alias("sale_percents"),
        F.col("p_type").alias("product_type"),
    )
    parts = table(spark, sf_dir, "part")
    current = parts.select(*record("product", key, after, F.lit("c"), F.lit(0)))
    gone = F.struct(F.lit(None).cast("int").alias("product_id"), F.lit("gone").alias("product_name"))
    deletes = parts.where(key % 13 == 0).select(
        *record("product", -key, gone, F.lit("d"), F.lit(0))
    )
    return current.union(deletes)


@feed
def transaction_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        # Dealt by order, the lines are where a join with orders wants them. It comes last, so that
        # the lines of an order, which are much alike, lie together in whatever they are stored in.
        .repartition("l_orderkey")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    order = F.col("l_orderkey")
    transaction_id = F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format("l_shipdate", "yyyyMMdd"),
    )
    walk_in, deleted = order % 10 == 0, order % 101 == 0
    customer = F.col("o_custkey").cast("string")
    after = F.struct(
        transaction_id.alias("transaction_id"),
        F.when(~walk_in, customer).alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(order % 97 != 0, F.concat(F.lit("09"), F.lpad(customer, 8, F.lit("0")))).alias(
            "phone_number"
        ),
        F.col("p_name").alias("product_name"),
        encode_decimal(F.col("p_retailprice")).alias("price"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        encode_decimal(F.col("l_extendedprice")).alias("total_amount"),
        F.lit(None).cast("bigint").alias("event_time"),
        F.when(walk_in, "store").otherwise("web").alias("source"),
    )
    return lines.select(
        *record(
            "transaction",
            order * 8 + F.col("l_linenumber"),
            F.when(~deleted, after),
            F.when(deleted, "d").otherwise("c"),
            F.unix_millis(F.col("o_orderdate").cast("timestamp")),
        )
    )


@feed
def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, F.col("user_id").cast("string"), F.col("ts"))


@feed
def busy_event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with a third of them of one customer, and every tenth without a time."""
    busy = F.when(F.col("event_id") % 3 == 0, F.lit("busy"))
    owner = F.coalesce(busy, F.col("user_id").cast("string"))
    return _events(spark, sf_dir, owner, F.when(F.col("event_id") % 10 != 0, F.col("ts")))


def _events(spark: SparkSession, sf_dir: str, customer: Column, time: Column) -> DataFrame:
    after = F.struct(
        F.col("event_id"),
        F.col("event_type").alias("type"),
        customer.alias("customer_id"),
        F.when(F.col("event_id") % 3 != 0, F.concat(
            F.lit("https://shop.example/"), F.col("event_type"), F.lit("/"), F.col("event_id")
        )).alias("url"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time_stamp"),
    )
    return spread_table(spark, sf_dir, "events", "event_id").select(
        *record("event", F.col("event_id"), after, F.lit("c"), F.lit(0))
    )


@feed
def customer_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a change of its customer's record; some carry no usable name."""
    status = F.col("o_orderstatus")
    name = F.when(status == "P", "Unknown").when(status == "O", "Buyer")
    after = F.struct(
        F.col("o_custkey").cast("string").alias("customer_id"),
        name.alias("first_name"),
        F.col("o_orderkey").cast("string").alias("last_name"),
        F.concat(F.lit("09"), F.lpad(F.col("o_custkey").cast("string"), 8, F.lit("0"))).alias(
            "phone_number"
        ),
        F.col("o_orderpriority").alias("country"),
        F.unix_date(F.col("o_orderdate").cast("date")).alias("creation_date"),
    )
    changed_at = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return spread_table(spark, sf_dir, "orders", "o_orderkey").select(
        *record("customer", F.col("o_orderkey"), after, F.lit("u"), changed_at)
    )


@feed
def product_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shipped line as a new price of its product."""
    sale = F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format("l_shipdate", "yyyyMMdd"),
    )
    after = F.struct(
        F.col("l_partkey").alias("product_id"),
        F.lit("repriced").alias("product_name"),
        sale.alias("product_link"),
        encode_decimal(F.col("l_extendedprice")).alias("price"),
        F.lit("USD").alias("currency"),
        F.col("l_returnflag").alias("product_type"),
    )
    shipped_at = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    position = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return spread_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber").select(
        *record("product", position, after, F.lit("u"), shipped_at)
    )


def mispriced_product_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose connector sent the brand in place of the encoded price for one type."""
    wrong = F.col("p_type") == "ECONOMY"
    price = F.when(wrong, F.col("p_brand")).otherwise(encode_decimal(F.col("p_retailprice")))
    after = F.struct(F.col("p_partkey").alias("product_id"), price.alias("price"))
    return table(spark, sf_dir, "part").select(
        *record("product", F.col("p_partkey"), after, F.lit("c"), F.lit(0))
    )


def broken_product_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mispriced products, every seventh of the others cut off in the middle of its record."""
    feed = mispriced_product_feed(spark, sf_dir)
    cut = (F.col("offset").cast("bigint") % 7 == 0) & ~F.col("value").contains("Brand")
    half = F.expr("substring(value, 1, cast(length(value) / 2 AS int))")
    return feed.withColumn("value", F.when(cut, half).otherwise(F.col("value")))


def bulk_transaction_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sale per order; the quantity of every fifth one is more than its column can hold."""
    order = F.col("o_orderkey")
    after = F.struct(
        order.cast("string").alias("transaction_id"),
        F.lit("0900000000").alias("phone_number"),
        F.when(order % 5 == 0, order + 100_000_000).otherwise(order % 100).alias("quantity"),
    )
    return table(spark, sf_dir, "orders").select(
        *record("transaction", order, after, F.lit("c"), F.lit(0))
    )


def all_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_feeds(
        customer_feed(spark, sf_dir),
        product_feed(spark, sf_dir),
        event_feed(spark, sf_dir),
        transaction_feed(spark, sf_dir),
    )
