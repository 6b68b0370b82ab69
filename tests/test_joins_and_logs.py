"""Lookups, facts, logs, resolution and profiles against brute force, hot keys included."""

import datetime as dt
import hashlib
from collections import defaultdict

import pytest
from conftest import day
from pyspark.sql import functions as F

from tidemark.operators import logs
from tidemark.operators.calendar import dim_date
from tidemark.operators.fact import build_fact
from tidemark.operators.lookup import lookup_join
from tidemark.operators.profile import build_profile
from tidemark.operators.resolve import resolve_transactions
from tidemark.schemas import ACTIVITY_ENTRY, DIM_CUSTOMER, DIM_PRODUCT, FACT_TRANSACTION

NOON = dt.datetime(2026, 1, 2, 12)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: a third with one key, a tenth without a key, some keys unknown."""
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 != 0, (F.col("id") % 500).cast("string"))
        .alias("key"),
    )
    lookup = spark.range(400).select(
        F.col("id").cast("string").alias("key"), (F.col("id") * 2).alias("value")
    ).union(spark.createDataFrame([("hot", -1)], "key string, value long"))
    return rows, lookup


@pytest.mark.parametrize("strategy", [None, "broadcast", "merge", "shuffle_hash"])
def test_lookup_join_is_the_same_by_every_strategy(skewed, strategy):
    rows, lookup = skewed
    values = {r["key"]: r["value"] for r in lookup.collect()}
    expected = sorted((r["row"], str(values.get(r["key"]))) for r in rows.collect())
    joined = lookup_join(rows, lookup, "key", strategy)
    assert joined.columns[-1] == "value"
    assert sorted((r["row"], str(r["value"])) for r in joined.collect()) == expected


def test_adaptive_execution_splits_hot_and_missing_keys(spark):
    """Rows of one key, and rows without one, are read by several tasks of the join."""
    rows = spark.range(200_000).select(
        F.col("id").cast("string").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
        .alias("key"),
    )
    lookup = spark.range(200_000).select(
        F.col("id").cast("string").alias("key"), F.col("id").alias("value")
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = lookup_join(rows, lookup, "key", "merge")
        placed = joined.select("key", F.spark_partition_id().alias("task")).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(placed) == 200_000
    for key in ("hot", None):
        assert len({row.task for row in placed if row.key == key}) > 1


def test_small_lookup_does_not_shuffle_the_rows(spark, skewed):
    rows, _ = skewed
    lookup = spark.range(400).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("v"))
    plan = plan_of(lookup_join(rows, lookup, "key"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def sale(transaction_id, customer_id="c", product_id="7", phone="0912", at=NOON):
    return (transaction_id, customer_id, product_id, phone, "lamp", 2, at)


def sales_frame(spark, *rows):
    frame = spark.createDataFrame(
        list(rows),
        "transaction_id string, customer_id string, product_id string, phone_number string, "
        "product_name string, quantity long, timestamp timestamp",
    )
    amount = F.lit("1.50").cast("decimal(10,2)")
    return frame.withColumns({"price": amount, "total_amount": amount})


def dimension(spark, schema, **values):
    row = {f.name: None for f in schema} | {"is_current": True} | values
    return spark.createDataFrame([row], schema)


@pytest.mark.parametrize("strategy", [None, "merge"])
def test_fact_keys_and_fallbacks(spark, strategy):
    customers = dimension(
        spark, DIM_CUSTOMER, customer_sk="sk-c", customer_id="c"
    ).union(dimension(spark, DIM_CUSTOMER, customer_sk="old", customer_id="c", is_current=False))
    products = dimension(spark, DIM_PRODUCT, product_sk="sk-7", product_id="7")
    sales = sales_frame(
        spark,
        sale("t1"),
        sale("t2", "x", "9", at=dt.datetime(2001, 1, 1, 23, 59)),
        sale("t3", at=dt.datetime(1900, 1, 1)),
    )
    facts = build_fact(
        sales, customers, products, dim_date(spark, "2026-01-01"), strategy=strategy
    )
    assert facts.schema.names == FACT_TRANSACTION.names
    found = {r.transaction_id: r for r in facts.collect()}
    assert len(found) == 3
    assert (found["t1"].customer_sk, found["t1"].product_sk) == ("sk-c", "sk-7")
    assert found["t1"].date_key == 20260102
    assert found["t2"].customer_sk == hashlib.md5(b"x2001-01-01").hexdigest()
    assert found["t2"].product_sk == hashlib.md5(b"92001-01-01").hexdigest()
    assert found["t2"].date_key == 20010101
    assert found["t3"].date_key is None
    assert found["t1"].transaction_sk == hashlib.md5(b"t1").hexdigest()


def test_calendar(spark):
    days = dim_date(spark, "2026-12-01").orderBy("date").collect()
    assert len(days) == 18263
    assert (days[0]["date"], days[-1]["date"]) == (day("2001-12-01"), day("2051-12-01"))
    for row in days[:: 997]:
        when = row["date"]
        assert row.asDict() == {
            "date_key": int(when.strftime("%Y%m%d")), "date": when, "year": when.year,
            "month": when.month, "day": when.day, "day_of_week": when.isoweekday(),
            "quarter": (when.month - 1) // 3 + 1,
        }


@pytest.fixture(scope="module")
def events(spark):
    """900 events, a third of them of one customer, some without one."""
    return spark.range(900).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit("view").alias("type"),
        F.when(F.col("id") % 3 == 0, "busy")
        .when(F.col("id") % 7 != 0, (F.col("id") % 40).cast("string"))
        .alias("customer_id"),
        F.lit(None).cast("string").alias("url"),
        F.timestamp_seconds(F.col("id") * 60).alias("time_stamp"),
    )


@pytest.mark.parametrize("size", [7, 100, 1024])
def test_log_keeps_every_entry_in_pages(events, size):
    expected = defaultdict(list)
    for row in events.orderBy("time_stamp").collect():
        if row.customer_id is not None:
            expected[row.customer_id].append(row.event_id)
    found = defaultdict(dict)
    for page in logs.activity_log(events, size).collect():
        ids = [entry.event_id for entry in page.activity_log]
        assert ids == sorted(ids) and len(ids) <= size
        assert page.page not in found[page.customer_id]
        found[page.customer_id][page.page] = ids
    assert found.keys() == expected.keys()
    for customer, pages in found.items():
        own = expected[customer]
        assert sorted(pages) == list(range(-(-len(own) // size)))
        for number, ids in pages.items():
            assert ids == sorted(own[number * size : (number + 1) * size])


def test_entries_without_id_or_time_fill_pages_too(spark):
    """Nothing but a bound of entries ends a page: equal entries without a time have several."""
    events = spark.range(1000).select(
        F.lit(None).cast("string").alias("event_id"), F.lit("c").alias("customer_id"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("type"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("timestamp").alias("time_stamp"),
    )
    sizes = [len(page.activity_log) for page in logs.activity_log(events, 64).collect()]
    assert sorted(sizes) == [1000 % 64, *[64] * (1000 // 64)]


def test_repaged_keeps_entries(events):
    pages = [
        logs.activity_log(events.where(f"event_id % 3 = {k}"), 10).withColumn("batch_id", F.lit(k))
        for k in range(3)
    ]
    rows = pages[0].union(pages[1]).union(pages[2])
    joined = logs.repaged(rows, "customer_id", "activity_log", 50)
    assert max(r.n for r in joined.select(F.size("activity_log").alias("n")).collect()) == 50
    flat = [
        sorted(map(tuple, df.select("customer_id", F.inline("activity_log")).collect()), key=str)
        for df in (rows, joined)
    ]
    assert flat[0] == flat[1]
    assert joined.count() < rows.count()


def test_hashed_pages_shuffle_by_key_and_page_once(events):
    pages = logs.hashed_pages(events, "customer_id", ACTIVITY_ENTRY, "activity_log", "time_stamp")
    plan = plan_of(pages)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan


@pytest.mark.parametrize("size", [9, 1024])
def test_resolution_by_phone_and_time(spark, size):
    sales = sales_frame(
        spark,
        *[sale(f"t{i}", phone="0912") for i in range(100)],
        sale("u1", phone="0913"),
        sale("in time", phone="0913", at=NOON + dt.timedelta(minutes=3)),
        sale("too late", phone="0913", at=NOON + dt.timedelta(minutes=3, seconds=1)),
        sale("nobody", phone="0999"),
    )
    lookup = spark.createDataFrame(
        [(customer, "0912") for customer in "abfg"]
        + [("c", "0913"), ("c", "0913"), ("d", None), ("e", "0000")],
        "customer_id string, phone_number string",
    )
    pages = resolve_transactions(sales, lookup, NOON, size=size)
    found = defaultdict(list)
    for page in pages.collect():
        found[page.customer_id] += [entry.transaction_id for entry in page.transaction_log]
    everyone = sorted(f"t{i}" for i in range(100))
    assert {k: sorted(v) for k, v in found.items()} == {
        **dict.fromkeys("abfg", everyone), "c": ["in time", "u1"]
    }


@pytest.mark.parametrize("size", [9, 1024])
def test_profile(spark, events, size):
    customers = spark.createDataFrame(
        [(key, "An", "Le", "male", day("1990-01-01")) for key in ("busy", "1", "nothing")],
        "customer_id string, first_name string, last_name string, gender string, "
        "date_of_birth date",
    )
    facts = spark.range(120).select(
        F.lit(None).cast("string").alias("transaction_sk"),
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") < 119, "1").otherwise("stranger").alias("customer_id"),
        F.lit("2.00").cast("decimal(10,2)").alias("unit_sales_price"),
        F.lit(1).cast("decimal(10,2)").alias("quantity"),
        F.lit("2.00").cast("decimal(10,2)").alias("total_amount"),
        F.timestamp_seconds("id").alias("time_stamp"),
    )
    profile = build_profile(customers, facts, events, size)
    assert profile.people.count() == 3
    found = {
        row.master_id: (row.bought, row.seen)
        for row in profile.documents().groupBy("master_id").agg(
            F.sum(F.coalesce(F.size("transaction_log"), F.lit(0))).alias("bought"),
            F.sum(F.coalesce(F.size("activity_log"), F.lit(0))).alias("seen"),
        ).collect()
    }
    seen_by_1 = events.where("customer_id = '1'").count()
    assert found == {"busy": (0, 300), "1": (119, seen_by_1), "nothing": (0, 0)}
    strangers = profile.pages.join(profile.people, "master_id", "left_anti")
    assert {r.master_id for r in strangers.collect()} >= {"stranger", "2"}
    without = build_profile(customers, facts, size=size)
    assert "activity_log" not in without.pages.columns
