"""The job that turns micro-batches of feed records into silver, gold and profile tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.aggregates import KEYS, REVENUE, combined, revenue_change
from tidemark.operators.calendar import dim_date
from tidemark.operators.cleaners import (
    clean_customer,
    clean_event,
    clean_product,
    clean_transaction,
)
from tidemark.operators.envelope import FEED_ORDER, PAYLOADS, quarantine, union_feeds
from tidemark.operators.fact import fact_rows, with_keys
from tidemark.operators.latest import latest_of_stored, latest_per_key
from tidemark.operators.logs import PAGE, log_pages, repaged
from tidemark.operators.ranks import written
from tidemark.operators.resolve import in_time, pages_of_customers
from tidemark.operators.scd2 import first_dim_customer, first_dim_product
from tidemark.operators.upsert import is_named, transaction_rows
from tidemark.operators.walkins import customers_by_day, with_placeholders
from tidemark.schemas import (
    ACTIVITY_ENTRY,
    ACTIVITY_PAGES,
    DIM_DATE,
    FACT_TRANSACTION,
    SILVER_CUSTOMER,
    SILVER_PRODUCT,
    SILVER_TRANSACTION,
    TRANSACTION_ENTRY,
    TRANSACTION_PAGES,
    UNREADABLE,
)
from tidemark.session import drop_garbage, together, work_dir
from tidemark.sources.batch_table import BatchTable, delete_folder, folder_exists
from tidemark.streaming.changes import ChangeFeed
from tidemark.streaming.documents import Documents
from tidemark.streaming.ids import IdIndex, only_in
from tidemark.streaming.snapshot import BUCKETS, Current

# Batches between two compactions.
COMPACT_EVERY = 20

_CHANGE = T.StructType().add("ts_ms", "long").add("offset", "long")
_DAY = T.StructType().add("day", "date")


def _with(schema: T.StructType, *more: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *(field for extra in more for field in extra.fields)])


class Lake:
    """All tables of one deployment below ``root``, fed by :meth:`apply`.

    Every table only grows: a batch adds its cleaned changes, already reduced to one per key, and a
    reader reduces what several batches have brought; :meth:`compact` does so ahead of readers. A
    repeated batch replaces what its first attempt wrote, and reads only what earlier batches wrote.

    A batch first writes changes, dimensions with the batch's walk-ins and the logs, and then the
    facts, which look up what the first step wrote. ``as_of`` is the processing day, fixed for a
    backfill; without it each batch takes the UTC day it starts on. Records that cannot be read or
    stored whole go to ``unreadable`` unless ``keep_unreadable`` is off.
    With ``change_feeds`` a batch also records which silver rows it changed, in ``feeds`` by table.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        as_of: dt.date | str | None = None,
        strict_compat: bool = False,
        fact_key: str = "md5",
        page: int = PAGE,
        keep_unreadable: bool = True,
        change_feeds: bool = False,
        compact_every: int = COMPACT_EVERY,
        buckets: int = BUCKETS,
    ):
        self.spark, self.root, self.as_of = spark, root, as_of
        self.compact_every = compact_every
        self.strict_compat = strict_compat
        self.fact_key, self.page = fact_key, page
        self.keep_unreadable = keep_unreadable

        def growing(zone: str, name: str, schema: T.StructType, *by: str) -> BatchTable:
            return BatchTable(spark, f"{root}/{zone}/{name}", schema, by)

        self.unreadable = growing("raw", "unreadable", UNREADABLE)
        self.customer_changes = growing("silver", "customer", _with(SILVER_CUSTOMER, _CHANGE))
        self.product_changes = growing("silver", "product", _with(SILVER_PRODUCT, _CHANGE))
        self.silver_transaction = growing("silver", "transaction", SILVER_TRANSACTION)
        self.customer_days = growing("gold", "customer", _with(SILVER_CUSTOMER, _CHANGE, _DAY))
        self.product_days = growing("gold", "product", _with(SILVER_PRODUCT, _CHANGE, _DAY))
        last = ["day", *FEED_ORDER]
        self.customers = Current(
            self.customer_days, f"{root}/gold/current/customer", "customer_id", last, buckets
        )
        self.products = Current(
            self.product_days, f"{root}/gold/current/product", "product_id", last, buckets
        )
        # Facts lie by sale month. The few ids that came again in a later batch are listed apart.
        month = T.StructType().add("sale_month", "integer")
        self.fact_transaction = growing("gold", "fact", _with(FACT_TRANSACTION, month), "sale_month")
        self.resent = growing("gold", "resent", T.StructType().add("transaction_id", "string"))
        self.ids = IdIndex(spark, f"{root}/gold/fact_ids", "transaction_id")
        self.revenue_changes = growing("gold", "revenue", REVENUE)
        self.people = Documents(
            spark, f"{root}/profile/people", SILVER_CUSTOMER, ["customer_id"]
        )
        self.activity = growing("profile", "activity", ACTIVITY_PAGES)
        self.purchases = growing("profile", "purchases", TRANSACTION_PAGES)
        reduced = {
            "customer": (self.customer_changes, SILVER_CUSTOMER, _latest_customers),
            "product": (self.product_changes, SILVER_PRODUCT, _latest_products),
            "transaction": (self.silver_transaction, SILVER_TRANSACTION, _last_sent),
        }
        self.feeds = {
            name: ChangeFeed(table, f"{root}/changes/{name}", f"{name}_id", schema, reduce)
            for name, (table, schema, reduce) in reduced.items() if change_feeds
        }

    def apply(self, raw: DataFrame, batch_id: int) -> None:
        """Bring one micro-batch of feed records into every table."""
        now = dt.datetime.now(dt.timezone.utc)
        as_of = self.as_of or now.date()
        cleaned = (
            clean_customer(raw),
            clean_product(raw),
            clean_transaction(raw, as_of, self.strict_compat).drop("source"),
            clean_event(raw, self.strict_compat),
        )
        folder = work_dir(self.spark, "batch")
        with in_files(folder, *cleaned) as (customers, products, sales, events):
            transactions = latest_of_stored(
                sales, "transaction_id", list(FEED_ORDER), f"{folder}/sales"
            )
            # The calendar must exist before facts look days up; it is written by one thread.
            days = self.calendar(as_of)
            everyone = with_placeholders(customers, transactions)
            by_day = customers_by_day(customers, transactions, as_of)
            product_days = products.withColumn("day", F.lit(as_of).cast("date"))
            newest = latest_per_key(customers, "customer_id", FEED_ORDER)
            eligible = transactions.where(in_time(now.replace(tzinfo=None)))
            steps = [
                lambda: self.customer_changes.add(batch_id, _latest_customers(everyone)),
                lambda: self.product_changes.add(batch_id, _latest_products(products)),
                lambda: self.silver_transaction.add(batch_id, transaction_rows(transactions)),
                lambda: self.customer_days.add(batch_id, _last_of_day(by_day, "customer_id")),
                lambda: self.product_days.add(batch_id, _last_of_day(product_days, "product_id")),
                lambda: self.people.set_fields(batch_id, newest.drop(*FEED_ORDER)),
                lambda: self._add_pages(
                    self.activity, batch_id, events, "customer_id", ACTIVITY_ENTRY, "time_stamp"
                ),
                lambda: self._add_pages(
                    self.purchases, batch_id, eligible, "phone_number", TRANSACTION_ENTRY,
                    "timestamp",
                ),
            ]
            if self.keep_unreadable:
                found = union_feeds(*(quarantine(raw, key) for key in PAYLOADS))
                steps.append(lambda: self.unreadable.add(batch_id, found))
            together(self.spark, *steps)
            replaced = self._add_facts(transactions, days, batch_id, f"{folder}/facts")
            # The index and the sums read the stored facts, so nothing else is kept for them.
            for name in ("sales", *range(len(cleaned))):
                delete_folder(self.spark, f"{folder}/{name}")
            added = self.fact_transaction.read(before=batch_id + 1).where(
                F.col("batch_id") == batch_id
            )
            together(
                self.spark,
                lambda: self.ids.put(batch_id, added),
                lambda: self.revenue_changes.add(batch_id, revenue_change(added, replaced)),
            )
        for feed in self.feeds.values():
            feed.record(batch_id)
        if batch_id % self.compact_every == self.compact_every - 1:
            self.compact()
        drop_garbage(self.spark)

    def _add_facts(
        self, transactions: DataFrame, days: DataFrame, batch_id: int, folder: str
    ) -> DataFrame | None:
        """Store the batch's facts and the ids among them that came earlier.

        The amounts of the earlier facts that are replaced, if any, are written below ``folder`` and
        returned, so the transactions are not needed any more.
        """
        places = self.ids.find(transactions, before=batch_id)
        rows = fact_rows(
            transactions,
            first_dim_customer(self.customers.of(transactions), F.col("day")),
            first_dim_product(self.products.of(transactions), F.col("day")),
            days,
            found=f"{folder}/found",
        )
        month = F.floor(F.col("date_key") / 100).cast("int").alias("sale_month")
        with persisted(places) as (known,):
            replaced = None
            resent = known.select("transaction_id")
            if not resent.isEmpty():
                older = only_in(self.fact_transaction.read(before=batch_id), known)
                last = (older["transaction_id"] == known["transaction_id"]) & (
                    older["batch_id"] == known["in_batch"]
                )
                replaced = written(
                    older.join(known, last, "left_semi").select(*KEYS, "quantity", "total_amount"),
                    f"{folder}/replaced",
                )
            self.resent.add(batch_id, resent)
            self.fact_transaction.add(
                batch_id,
                rows.select("*", month).drop("sale_date"),
                lambda rows: with_keys(rows, self.fact_key, "sale_month"),
            )
        return replaced

    def _add_pages(
        self,
        table: BatchTable,
        batch_id: int,
        rows: DataFrame,
        key: str,
        entry: tuple[str, ...],
        time: str,
    ) -> None:
        """Store the batch's entries as pages of their own; no stored page is read or written."""
        log = next(f.name for f in table.schema if isinstance(f.dataType, T.ArrayType))
        table.add(batch_id, log_pages(rows, key, entry, log, time, self.page, kept=True))

    def calendar(self, as_of: dt.date | str | None = None) -> DataFrame:
        """The calendar, written once, around the day of the first batch."""
        path = f"{self.root}/gold/dim_date"
        if not folder_exists(self.spark, f"{path}/_SUCCESS"):
            days = dim_date(self.spark, as_of or self.as_of)
            days.coalesce(1).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(DIM_DATE).parquet(path)

    def silver_customer(self) -> DataFrame:
        """One row per customer, the last named record, or a placeholder if there is none."""
        return _latest_customers(self.customer_changes.read()).select(*SILVER_CUSTOMER.names)

    def silver_product(self) -> DataFrame:
        return _latest_products(self.product_changes.read()).select(*SILVER_PRODUCT.names)

    def dim_customer(self) -> DataFrame:
        """All versions of every customer."""
        return first_dim_customer(self.customer_days.read(), F.col("day"))

    def dim_product(self) -> DataFrame:
        return first_dim_product(self.product_days.read(), F.col("day"))

    def current_customers(self) -> DataFrame:
        """The current version of every customer; the history is not read."""
        return first_dim_customer(self.customers.all(), F.col("day"))

    def current_products(self) -> DataFrame:
        return first_dim_product(self.products.all(), F.col("day"))

    def transactions(self) -> DataFrame:
        """Stored transactions, one row per transaction id."""
        return self._unique(self.silver_transaction).select(*SILVER_TRANSACTION.names)

    def facts(self) -> DataFrame:
        """Fact rows with their ``sale_month``, one per transaction, the latest if it came again.

        Filters on days and months, and the choice of columns, reach the files.
        """
        return self._unique(self.fact_transaction).drop("batch_id")

    def revenue(self) -> DataFrame:
        """Sums of all facts by month and product, by either, and in all."""
        return combined(self.revenue_changes.read())

    def _unique(self, table: BatchTable, before: int | None = None) -> DataFrame:
        """A batch holds an id once. Rows whose id a later batch brought again are left out.

        With ``before``, the rows as they were before that batch.
        """
        rows = table.read(before)
        if not self.resent.batches():
            return rows
        again = self.resent.read(before).groupBy("transaction_id").agg(F.max("batch_id").alias("last"))
        older = (rows["transaction_id"] == again["transaction_id"]) & (
            rows["batch_id"] < again["last"]
        )
        return rows.join(again, older, "left_anti")

    def activity_pages(self) -> DataFrame:
        """``customer_id, page, activity_log``; pages are numbered by the batch that brought them."""
        return self.activity.read().drop("batch_id")

    def purchase_pages(self) -> DataFrame:
        """``phone_number, page, transaction_log``, numbered likewise."""
        return self.purchases.read().drop("batch_id")

    def profiles(self) -> DataFrame:
        """Profile documents: every customer's demographics with each page of either log.

        Purchases belong to a phone number, and to its customers whenever those became known.
        Customers known only from activity have pages with empty demographics.
        """
        people = self.people.current()
        pages = pages_of_customers(self.purchase_pages(), people).drop("phone_number")
        pages = pages.unionByName(self.activity_pages(), allowMissingColumns=True)
        return people.join(pages, "customer_id", "full")

    def create_views(self) -> None:
        """Temporary views of the tables as they are now, for SQL over the star schema."""
        views = {
            "silver_customer": self.silver_customer(),
            "silver_product": self.silver_product(),
            "silver_transaction": self.transactions(),
            "dim_customer": self.dim_customer(),
            "dim_product": self.dim_product(),
            "dim_date": self.calendar(),
            "fact_transaction": self.facts(),
        }
        for name, rows in views.items():
            rows.createOrReplaceTempView(name)

    def compact(self) -> None:
        """Reduce what earlier batches wrote; readers see the same rows before and after."""
        self.customers.renew()
        self.products.renew()
        self.customer_changes.compact(_latest_customers)
        self.product_changes.compact(_latest_products)
        self.customer_days.compact(lambda rows: _last_of_day(rows, "customer_id"))
        self.product_days.compact(lambda rows: _last_of_day(rows, "product_id"))
        self.revenue_changes.compact(combined)
        self.people.compact(self.people.newest)
        self.activity.compact(lambda rows: repaged(rows, "customer_id", "activity_log", self.page))
        self.purchases.compact(
            lambda rows: repaged(rows, "phone_number", "transaction_log", self.page)
        )


def _latest_customers(changes: DataFrame) -> DataFrame:
    """The last record of each customer; placeholders come after every named record."""
    named = F.coalesce(is_named(), F.lit(False))
    return latest_per_key(changes, "customer_id", [named, *FEED_ORDER])


def _latest_products(changes: DataFrame) -> DataFrame:
    return latest_per_key(changes, "product_id", list(FEED_ORDER))


def _last_sent(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, "transaction_id", ["batch_id"])


def _last_of_day(changes: DataFrame, key: str) -> DataFrame:
    return latest_per_key(changes, [key, "day"], list(FEED_ORDER))


@contextmanager
def in_files(folder: str, *frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames as files below ``folder`` for the several reads of a batch, then delete it.

    Files take a fraction of what rows take in memory or beside it, and the shuffles below the frames
    are gone once the files are written.
    """
    spark = frames[0].sparkSession
    try:
        yield tuple(
            together(
                spark,
                *(partial(written, frame, f"{folder}/{i}") for i, frame in enumerate(frames)),
            )
        )
    finally:
        delete_folder(spark, folder)


@contextmanager
def persisted(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames for the several writes of a batch; lost blocks are computed again."""
    kept = tuple(frame.persist(StorageLevel.MEMORY_AND_DISK) for frame in frames)
    try:
        yield kept
    finally:
        for frame in kept:
            frame.unpersist()


def start_lake(
    lake: Lake, feed: DataFrame, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Apply a feed stream to the lake, batch after batch, from the last committed one."""
    writer = (
        feed.writeStream.foreachBatch(lake.apply)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def supervise(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Block until any of the queries ends, stop the others, and raise what made it fail."""
    spark.streams.resetTerminated()  # forget queries that ended before these
    try:
        while all(query.isActive for query in queries):
            spark.streams.awaitAnyTermination(60)
    finally:
        ended = [query for query in queries if not query.isActive]
        for query in queries:
            if query.isActive:
                query.stop()
    for query in ended:
        query.awaitTermination()
