"""Stored tables, streams, restarts and the whole job on small feeds."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from conftest import change, day
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.functions import encode_decimal
from tidemark.operators.aggregates import combined, revenue_change
from tidemark.operators.calendar import dim_date
from tidemark.operators.cleaners import clean_event, clean_transaction
from tidemark.plans.backfill import load_tables
from tidemark.operators.logs import hashed_pages
from tidemark.operators.resolve import pages_of_customers
from tidemark.schemas import ACTIVITY_ENTRY, ACTIVITY_PAGES, DIM_DATE, FEED, TABLES, TRANSACTION_PAGES
from tidemark.session import shared_dir, work_dir
from tidemark.sources import tables
from tidemark.sources.feeds import broker_options, read_feed, stream_feed
from tidemark.sources.batch_table import BatchTable
from tidemark.streaming.bronze import (
    read_bronze,
    records_per_table,
    stream_bronze,
    write_bronze,
)
from tidemark.plans.star import revenue_by_day
from tidemark.streaming.documents import (
    Documents,
    stateful_activity_log,
    stateful_transaction_log,
    write_documents,
)
from tidemark.streaming.lake import Lake, start_lake, supervise

AS_OF = "2026-01-10"


def contents(df):
    return sorted(map(str, df.collect()))


def files_below(path):
    return {
        os.path.join(folder, name)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


# Tables of batches.

@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], "id string, v int").schema
    return BatchTable(spark, str(tmp_path / "t"), schema)


def put(table, batch_id, *rows):
    table.add(batch_id, table.spark.createDataFrame(list(rows), table.schema))


def values(table):
    return sorted((r.id, r.v, r.batch_id) for r in table.read().collect())


def test_batch_table_replaces_a_repeated_batch(table):
    assert values(table) == []
    put(table, 0, ("a", 1), ("b", 1))
    put(table, 1, ("a", 2))
    put(table, 1, ("b", 3))
    assert values(table) == [("a", 1, 0), ("b", 1, 0), ("b", 3, 1)]
    assert table.read(before=1).count() == 2


@pytest.mark.parametrize("repeated", [False, True])
def test_batch_that_dies_leaves_the_table(table, repeated):
    """On its first attempt or a repeated one, with some of its files written."""
    put(table, 0, ("a", 1))
    if repeated:
        put(table, 1, ("b", 1))
    before = values(table)
    broken = table.spark.range(0, 1000, 1, 4).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") < 750, 2).otherwise(F.raise_error(F.lit("lost"))).cast("int").alias("v"),
    )
    with pytest.raises(Exception, match="lost"):
        table.add(1, broken)
    assert values(table) == before
    put(table, 1, ("c", 4))
    assert values(table) == [("a", 1, 0), ("c", 4, 1)]


def test_a_batch_costs_its_own_size(table):
    put(table, 0, *[(str(i), i) for i in range(1000)])
    before = files_below(table.path)
    put(table, 1, ("7", 0))
    added = files_below(table.path) - before
    assert before <= files_below(table.path) and len(added) == 1


def test_compaction_keeps_what_readers_see(table):
    for batch in range(6):
        put(table, batch, ("a", batch), (str(batch), batch))
    def newest(rows):
        return rows.groupBy("id").agg(F.max("v").alias("v"))
    before = contents(newest(table.read()))
    for _ in range(2):
        table.compact(newest)
        assert contents(newest(table.read())) == before
        assert table.batches() == [4, 5]
    put(table, 5, ("a", 9))
    assert {r.id: r.v for r in newest(table.read()).collect()}["a"] == 9


# Catalog, views, lookups, settings.

@pytest.fixture
def empty_catalog(spark):
    for zone in {spec.zone for spec in TABLES.values()}:
        spark.sql(f"DROP DATABASE IF EXISTS {zone} CASCADE")


def test_catalog_tables_and_calendar_once(spark, tmp_path, empty_catalog):
    for _ in range(2):
        tables.create_tables(spark, str(tmp_path))
    for spec in TABLES.values():
        assert set(spark.table(spec.qualified).columns) == set(spec.schema.names)
    name = TABLES["dim_date"].qualified
    assert tables.is_empty(spark, name)
    assert tables.populate_once(spark, name, dim_date(spark, AS_OF))
    assert not tables.populate_once(spark, name, dim_date(spark, AS_OF))
    assert spark.table(name).count() == 18263
    assert spark.table(name).schema.names == DIM_DATE.names


def test_view_hides_bookkeeping(spark):
    rows = spark.createDataFrame([(1, 2)], "_commit int, id int")
    tables.create_clean_view(rows, "clean")
    assert spark.table("clean").columns == ["id"]


def test_lookup_reads_only_its_schema(spark, tmp_path):
    path = str(tmp_path / "documents")
    spark.createDataFrame([("c", "0912", 1)], "customer_id string, phone_number string, n int") \
        .write.json(path)
    lookup = tables.read_lookup(spark, path, "customer_id string, phone_number string", "json")
    assert [tuple(r) for r in lookup.collect()] == [("c", "0912")]


def test_broker_options_pass_the_start_through():
    assert broker_options("b:1", ["x", "y"], "latest", maxOffsetsPerTrigger="5") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "x,y", "startingOffsets": "latest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5",
    }
    assert broker_options("b:1", ["x"])["startingOffsets"] == "earliest"


def test_work_folders_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == shared
    assert work_dir(spark, "x").startswith(f"{shared}/x-")
    assert work_dir(spark, "x") != work_dir(spark, "x")


# Streams.

def customer(key, name="An", phone="0912", created=0):
    return ("customer", change({"customer_id": key, "first_name": name, "phone_number": phone,
                                "date_of_birth": 0, "creation_date": created}, "c", created))


def product(key):
    return ("product", change({"product_id": key, "product_name": f"p{key}"}))


def purchase(key, customer_id, phone="0912", product_id=7, when="2026-01-05"):
    millis = int(dt.datetime.fromisoformat(f"{when}T12:00:00+00:00").timestamp() * 1000)
    return ("transaction", change(
        {"transaction_id": key, "customer_id": customer_id, "product_id": product_id,
         "phone_number": phone, "quantity": 2, "price": "MDk=", "total_amount": "MDk="},
        "c", millis))


def event(key, customer_id, at="2026-01-01T00:00:00Z"):
    return ("event", change({"event_id": key, "type": "view", "customer_id": customer_id,
                             "time_stamp": at}))


BATCHES = (
    [customer("c1"), customer("c2", phone="0913"), product(7), event(1, "c1"), event(2, "c9")],
    [purchase("t1", "c1"), purchase("t2", None, "0999"), customer("c1", "Binh", created=1),
     event(3, "c1")],
    [purchase("t3", "c2", "0913", product_id=8), purchase("t1", "c1"), event(4, "c1"),
     purchase("t4", None, "0999", when="2026-01-07"), ("transaction", "not json")],
)


def lake_tables(lake):
    return {
        "silver_customer": lake.silver_customer(),
        "silver_product": lake.silver_product(),
        "silver_transaction": lake.transactions(),
        "dim_customer": lake.dim_customer(),
        "dim_product": lake.dim_product(),
        "fact": lake.facts(),
        "revenue": lake.revenue(),
        "profiles": lake.profiles(),
    }


def test_lake_streams_restarts_and_replays(spark, feed, tmp_path):
    source, bronze = str(tmp_path / "feed"), str(tmp_path / "bronze")
    lake = Lake(spark, str(tmp_path / "lake"), as_of=AS_OF)
    for records in BATCHES:  # each round starts both queries again from their checkpoints
        feed(*records).coalesce(1).write.mode("append").parquet(source)
        write_bronze(
            stream_feed(spark, "parquet", source), bronze, str(tmp_path / "c1"), True
        ).awaitTermination()
        start_lake(
            lake, stream_bronze(spark, bronze), str(tmp_path / "c2"), True
        ).awaitTermination()

    counts = {r["key"]: r["records"]
              for r in records_per_table(read_bronze(spark, bronze)).collect()}
    assert counts == {"customer": 3, "product": 1, "event": 4, "transaction": 6}

    dim = lake.dim_customer()
    per_key = dim.groupBy("customer_id").agg(F.sum(F.col("is_current").cast("int")).alias("n"))
    assert {r.n for r in per_key.collect()} == {1}
    silver = {r.customer_id: r.first_name for r in lake.silver_customer().collect()}
    walk_in = next(key for key in silver if key not in ("c1", "c2"))
    assert silver == {"c1": "Binh", "c2": "An", walk_in: "Unknown"}
    walk_in_days = dim.where(F.col("customer_id") == walk_in).select("effective_date").collect()
    assert sorted(r[0] for r in walk_in_days) == [day("2026-01-05"), day("2026-01-07")]

    facts = lake.facts()
    assert sorted(r.transaction_id for r in facts.collect()) == ["t1", "t2", "t3", "t4"]
    assert facts.join(dim, "customer_sk", "left_anti").isEmpty()
    assert facts.where("date_key IS NULL OR unit_sales_price IS NULL").isEmpty()

    profiles = {}
    for row in lake.profiles().collect():
        name, seen, bought = profiles.setdefault(row.customer_id, (row.first_name, [], []))
        assert name == row.first_name
        seen += [e.event_id for e in row.activity_log or ()]
        bought += [e.transaction_id for e in row.transaction_log or ()]
    # The customers with number 0912 and 0913 are known before, or after, the purchases.
    assert {k: (n, sorted(a), sorted(b)) for k, (n, a, b) in profiles.items()} == {
        "c1": ("Binh", ["1", "3", "4"], ["t1", "t1"]), "c2": ("An", [], ["t3"]),
        "c9": (None, ["2"], []),
    }
    assert [(r.transaction_id, r.batch_id) for r in lake.resent.read().collect()] == [("t1", 2)]
    (unreadable,) = lake.unreadable.read().collect()
    assert (unreadable.value, unreadable.reason) == ("not json", "malformed json")

    assert contents(lake.revenue()) == contents(combined(revenue_change(lake.facts())))
    before = {name: contents(rows) for name, rows in lake_tables(lake).items()}
    lake.apply(feed(*BATCHES[-1]), batch_id=2)
    assert {name: contents(rows) for name, rows in lake_tables(lake).items()} == before

    lake.compact()
    after = {name: contents(rows) for name, rows in lake_tables(lake).items()}
    assert {k: v for k, v in after.items() if k != "profiles"} == {
        k: v for k, v in before.items() if k != "profiles"
    }
    found = {}  # pages are joined, their entries stay
    for row in lake.profiles().collect():
        _, seen, bought = found.setdefault(row.customer_id, (row.first_name, [], []))
        seen += [e.event_id for e in row.activity_log or ()]
        bought += [e.transaction_id for e in row.transaction_log or ()]
    assert {k: (n, sorted(a), sorted(b)) for k, (n, a, b) in found.items()} == {
        k: (n, sorted(a), sorted(b)) for k, (n, a, b) in profiles.items()
    }
    lake.create_views()
    (row,) = spark.sql(
        "SELECT count(*) AS n, sum(f.total_amount) AS amount FROM fact_transaction f "
        "JOIN dim_date d ON d.date_key = f.date_key "
        "JOIN dim_customer c ON c.customer_sk = f.customer_sk WHERE d.year = 2026"
    ).collect()
    assert (row.n, row.amount) == (4, Decimal("493.80"))


def test_one_batch_equals_a_first_load(spark, feed, tmp_path, empty_catalog):
    """The streaming job and the load of the catalog tables agree, and a load can be repeated."""
    raw = feed(*[record for batch in BATCHES for record in batch])
    lake = Lake(spark, str(tmp_path / "lake"), as_of=AS_OF)
    lake.apply(raw, 0)
    (unreadable,) = lake.unreadable.read().collect()
    assert (unreadable.value, unreadable.reason) == ("not json", "malformed json")
    for _ in range(2):
        load_tables(spark, raw, str(tmp_path / "catalog"), AS_OF)
    pairs = {
        "silver.silver_customer": lake.silver_customer(),
        "silver.silver_product": lake.silver_product(),
        "silver.silver_transaction": lake.transactions(),
        "gold.dim_customer": lake.dim_customer(),
        "gold.dim_product": lake.dim_product(),
        "gold.dim_date": lake.calendar(),
        "gold.fact_transaction": lake.facts(),
        "profile.people": lake.people.current(),
        "profile.activity": lake.activity_pages(),
        "profile.purchases": lake.purchase_pages(),
    }
    for name, rows in pairs.items():
        assert contents(spark.table(name)) == contents(rows.select(spark.table(name).columns)), name


def test_batch_feed_equals_stream_feed(spark, feed, tmp_path):
    path = str(tmp_path / "feed")
    feed(*BATCHES[0]).write.json(path)
    batch = read_feed(spark, "json", path)
    assert batch.columns == FEED.names
    streamed = stream_feed(spark, "json", path)
    write_bronze(
        streamed, str(tmp_path / "b"), str(tmp_path / "c"), True
    ).awaitTermination()
    assert contents(batch) == contents(read_bronze(spark, str(tmp_path / "b")))


def test_stateful_log_counts_late_entries(spark, feed, tmp_path):
    """Rows hours behind the watermark still reach the documents."""
    path, docs = str(tmp_path / "feed"), str(tmp_path / "docs")
    lookup = spark.createDataFrame([("c1", "0912")], "customer_id string, phone_number string")
    for when in ("2026-01-05", "2026-01-09", "2026-01-02"):
        feed(purchase(f"t{when}", None, when=when)).coalesce(1).write.mode("append").parquet(path)
        sales = clean_transaction(stream_feed(spark, "parquet", path), AS_OF)
        log = stateful_transaction_log(sales, lookup, dt.datetime(2026, 2, 1))
        documents = Documents(spark, docs, TRANSACTION_PAGES, ["phone_number", "page"])
        write_documents(log, documents, str(tmp_path / "c"), True).awaitTermination()
    pages = pages_of_customers(documents.current(), lookup)
    rows = pages.select("customer_id", F.inline("transaction_log")).collect()
    assert sorted((r.customer_id, r.transaction_id) for r in rows) == [
        ("c1", "t2026-01-02"), ("c1", "t2026-01-05"), ("c1", "t2026-01-09")
    ]


def test_streamed_pages_equal_hashed_pages(spark, feed, tmp_path):
    """Row by row, page numbers included."""
    path = str(tmp_path / "feed")
    records = [event(n, f"c{n % 3}", f"2026-0{n % 4 + 1}-01T00:00:00Z") for n in range(60)]
    for part in (records[:20], records[20:]):
        feed(*part).coalesce(1).write.mode("append").parquet(path)
    streamed = stateful_activity_log(
        clean_event(stream_feed(spark, "parquet", path, maxFilesPerTrigger="1"))
    )
    documents = Documents(spark, str(tmp_path / "docs"), ACTIVITY_PAGES, ["customer_id", "page"])
    write_documents(streamed, documents, str(tmp_path / "c"), True).awaitTermination()
    batch = hashed_pages(
        clean_event(feed(*records)), "customer_id", ACTIVITY_ENTRY, "activity_log", "time_stamp"
    )
    assert contents(documents.current()) == contents(batch)


def test_reports_read_only_the_days_and_columns_they_need(spark, feed, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), as_of=AS_OF)
    for number, records in enumerate(BATCHES[:2]):
        lake.apply(feed(*records), number)
    report = revenue_by_day(lake.facts(), 20260101, 20260131)
    plan = report._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line)
    assert "GreaterThanOrEqual(date_key,20260101)" in scan and "sale_month" in scan
    assert "customer_sk" not in scan and "transaction_sk" not in scan
    assert "hashpartitioning(transaction" not in plan
    assert [r.sales for r in report.collect()] == [2]


def test_supervision_stops_the_others_and_raises(spark, feed, tmp_path):
    path = str(tmp_path / "feed")
    feed(*BATCHES[0]).write.parquet(path)
    incoming = stream_feed(spark, "parquet", path)

    def fail(batch, batch_id):
        raise ValueError("bad batch")

    healthy = write_bronze(incoming, str(tmp_path / "b"), str(tmp_path / "c1"))
    failing = incoming.writeStream.foreachBatch(fail).option(
        "checkpointLocation", str(tmp_path / "c2")
    ).start()
    with pytest.raises(StreamingQueryException):
        supervise(spark, [healthy, failing])
    assert not healthy.isActive and not failing.isActive
    spark.streams.resetTerminated()


def test_streamed_cleaners_carry_watermarks(spark, tmp_path, feed):
    path = str(tmp_path / "feed")
    feed(*BATCHES[0]).write.parquet(path)
    incoming = stream_feed(spark, "parquet", path)
    for frame, delay in ((clean_event(incoming), "5 minutes"),
                         (clean_transaction(incoming, AS_OF), "10 minutes")):
        plan = frame._jdf.queryExecution().analyzed().toString()
        assert "EventTimeWatermark" in plan and delay in plan


def test_encoded_feed_amounts_are_what_the_cleaner_reads(spark):
    assert spark.range(1).select(encode_decimal(F.lit(123.45))).first()[0] == "AAAAAAAAMDk="
