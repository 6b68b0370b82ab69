"""Keyed merges, type 2 histories and document merges on literal rows and random change logs."""

import datetime as dt
import hashlib
from collections import defaultdict

import pytest
from conftest import day
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.operators.scd2 import current_versions, scd2_from_log, scd2_merge
from tidemark.operators.upsert import (
    append_transactions,
    merge_documents,
    transaction_rows,
    upsert,
)
from tidemark.operators.walkins import insert_walkins
from tidemark.schemas import DIM_CUSTOMER

OPEN = day("9999-12-31")


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_latest_per_key(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1, "old"), ("a", 2, 1, "new"), ("a", 2, 0, "mid"), (None, 9, 9, "no key"),
         ("b", None, None, "only")],
        "k string, ts long, pos long, v string",
    )
    assert rows_of(latest_per_key(rows, "k", ["ts", "pos"]), "k", "v") == [
        ("a", "new"), ("b", "only")
    ]


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    rows = spark.range(10).select(
        F.lit("hot").alias("id"), F.col("id").alias("ts"), F.lit("2026-01-01").alias("v")
    )
    history = scd2_from_log(rows, "id", "sk", F.to_date("v"), ["ts"])
    for df in (latest_per_key(rows, "id", ["ts"]), history):
        plan = df._jdf.queryExecution().executedPlan().toString()
        first_shuffle = plan.rindex("Exchange hashpartitioning")
        assert "partial_max_by" in plan[first_shuffle:]


def test_merge_reduces_both_sides_before_they_meet(spark):
    stored = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("v"))
    changes = stored.withColumn("ts", F.col("id").cast("long"))
    plan = upsert(stored, changes, "id", ["ts"])._jdf.queryExecution().executedPlan().toString()
    # One exchange reduces the changes by key, one brings both sides together.
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize(
    ("name", "expected"),
    [("Unknown", "real"), (None, "real"), ("Binh", "Binh")],
)
def test_guard_protects_stored_rows(spark, name, expected):
    target = spark.createDataFrame([("c", "real"), ("d", "kept")], "id string, name string")
    source = spark.createDataFrame([("c", name, 1)], "id string, name string, ts long")
    merged = upsert(target, source, "id", ["ts"], guard=F.col("name") != "Unknown")
    assert rows_of(merged, "id", "name") == [("c", expected), ("d", "kept")]


def test_guarded_record_is_inserted_when_new(spark):
    target = spark.createDataFrame([], "id string, name string")
    source = spark.createDataFrame(
        [("c", "Unknown", 2), ("c", "Binh", 1), ("e", "Unknown", 1)],
        "id string, name string, ts long",
    )
    merged = upsert(target, source, "id", ["ts"], guard=F.col("name") != "Unknown")
    assert rows_of(merged, "id", "name") == [("c", "Binh"), ("e", "Unknown")]


def test_upsert_is_idempotent_and_takes_the_latest(spark):
    target = spark.createDataFrame([("a", "1"), ("b", "1")], "id string, v string")
    source = spark.createDataFrame(
        [("b", "2", 1), ("b", "3", 2), ("c", "2", 1), (None, "2", 1)],
        "id string, v string, ts long",
    )
    once = upsert(target, source, "id", ["ts"])
    assert rows_of(once, "id", "v") == [("a", "1"), ("b", "3"), ("c", "2")]
    assert rows_of(upsert(once, source, "id", ["ts"]), "id", "v") == rows_of(once, "id", "v")


def test_appended_transactions_are_stored_once(spark):
    rows = spark.createDataFrame(
        [("t1", "c", "7", "lamp", 1, None, 1, 0), ("t1", "c", "7", "lamp", 2, None, 2, 0),
         ("t2", "c", "7", "lamp", 1, 5, 1, 0)],
        "transaction_id string, customer_id string, product_id string, product_name string, "
        "quantity long, event_time long, ts_ms long, offset long",
    ).withColumns({"price": F.lit(1).cast("decimal(10,2)"),
                   "total_amount": F.lit(1).cast("decimal(10,2)")})
    stored = transaction_rows(rows.where("transaction_id = 't2'"))
    merged = append_transactions(stored, rows, ["ts_ms", "offset"])
    assert rows_of(merged, "transaction_id", F.col("quantity").cast("int"), "event_time") == [
        ("t1", 2, None), ("t2", 1, "5")
    ]


def test_merge_documents_sets_only_the_fields_carried(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, s string")
    update = spark.createDataFrame([("a", "z"), ("c", "w"), (None, "q")], "id string, s string")
    merged = merge_documents(target, update, "id")
    assert [tuple(r) for r in merged.orderBy("id").collect()] == [
        ("a", 1, "z"), ("b", 2, "y"), ("c", None, "w")
    ]
    again = merge_documents(merged, update, "id")
    assert again.exceptAll(merged).isEmpty() and merged.exceptAll(again).isEmpty()


CHANGES = "id string, v string, changed date, ts_ms long, offset long"
COLUMNS = ("sk", "id", "v", "effective_date", "expired_date", "is_current")


def empty_dim(spark):
    return spark.createDataFrame(
        [], "sk string, id string, v string, effective_date date, expired_date date, "
        "is_current boolean"
    )


def merge(dim, rows, as_of, **options):
    return scd2_merge(dim, rows, "id", "sk", as_of, **options).select(*COLUMNS)


def test_scd2_same_day_unchanged_and_next_day(spark):
    def batch(*rows):
        return spark.createDataFrame(
            [(i, v, None, 0, n) for n, (i, v) in enumerate(rows)], CHANGES
        )

    dim = merge(empty_dim(spark), batch(("c", "1"), ("c", "2"), ("d", "1")), "2026-01-01")
    assert rows_of(dim, "id", "v", "is_current") == [("c", "2", True), ("d", "1", True)]

    second = merge(dim, batch(("c", "2")), "2026-01-03")  # unchanged, yet a new version
    sk = hashlib.md5(b"c2026-01-03").hexdigest()
    assert rows_of(second, *COLUMNS[1:]) == [
        ("c", "2", day("2026-01-01"), day("2026-01-03"), False),
        ("c", "2", day("2026-01-03"), OPEN, True),
        ("d", "1", day("2026-01-01"), OPEN, True),
    ]
    assert current_versions(second).where("id = 'c'").first().sk == sk

    replay = merge(second, batch(("c", "2")), "2026-01-03")
    assert rows_of(replay, *COLUMNS) == rows_of(second, *COLUMNS)


def test_scd2_guard_leaves_records_out(spark):
    dim = merge(
        empty_dim(spark), spark.createDataFrame([("c", "1", None, 0, 0)], CHANGES), "2026-01-01"
    )
    placeholder = spark.createDataFrame([("c", "Unknown", None, 1, 1)], CHANGES)
    guarded = merge(dim, placeholder, "2026-01-02", guard=F.col("v") != "Unknown")
    assert rows_of(guarded, *COLUMNS) == rows_of(dim, *COLUMNS)
    unguarded = merge(dim, placeholder, "2026-01-02")
    assert unguarded.count() == 2


change_logs = st.lists(
    st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.integers(0, 9)), min_size=1,
    max_size=25,
)


@settings(
    max_examples=4,
    deadline=None,
    derandomize=True,
    phases=[Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(log=change_logs, batches=st.integers(1, 3))
def test_merging_daily_batches_gives_the_full_history(spark, log, batches):
    first = dt.date(2026, 1, 1)
    rows = [
        (key, str(value), first + dt.timedelta(days=offset_day), 0, n)
        for n, (key, offset_day, value) in enumerate(sorted(log, key=lambda r: r[1]))
    ]
    changes = spark.createDataFrame(rows, CHANGES)
    full = scd2_from_log(changes, "id", "sk", F.col("changed"), ["ts_ms", "offset"])

    dim = empty_dim(spark)
    for number in range(batches):
        batch = changes.where(F.datediff("changed", F.lit(first)) * batches / 6 >= number).where(
            F.datediff("changed", F.lit(first)) * batches / 6 < number + 1
        )
        dim = merge(dim, batch, F.col("changed"))
    found = rows_of(dim, *COLUMNS)
    assert found == rows_of(full, *COLUMNS)

    expected = defaultdict(dict)
    for key, value, changed, _, _ in rows:
        expected[key][changed] = value
    versions = defaultdict(list)
    for _, key, value, start, end, current in found:
        versions[key].append((start, end, value, current))
    assert {k: {s: v for s, _, v, _ in vs} for k, vs in versions.items()} == expected
    for history in versions.values():
        history.sort()
        starts = [start for start, *_ in history]
        assert [end for _, end, *_ in history] == [*starts[1:], OPEN]
        assert [current for *_, current in history] == [False] * (len(history) - 1) + [True]


def test_late_record_takes_its_place(spark):
    dim = empty_dim(spark)
    for when in ("2026-01-01", "2026-01-05", "2026-01-03"):
        batch = spark.createDataFrame([("c", when, None, 0, 0)], CHANGES)
        dim = merge(dim, batch, when)
    assert rows_of(dim, "effective_date", "expired_date", "is_current") == [
        (day("2026-01-01"), day("2026-01-03"), False),
        (day("2026-01-03"), day("2026-01-05"), False),
        (day("2026-01-05"), OPEN, True),
    ]


def test_walk_ins_get_one_version_per_day(spark):
    sales = spark.createDataFrame(
        [("w", "0912", dt.datetime(2026, 1, 1, 9), True, 1, 1),
         ("w", "0912", dt.datetime(2026, 1, 1, 18), True, 2, 2),
         ("w", "0912", dt.datetime(2026, 1, 4, 9), True, 3, 3),
         ("c", "0913", dt.datetime(2026, 1, 4, 9), False, 4, 4)],
        "customer_id string, phone_number string, timestamp timestamp, is_new_customer boolean, "
        "ts_ms long, offset long",
    )
    dim = insert_walkins(spark.createDataFrame([], DIM_CUSTOMER), sales)
    assert rows_of(dim, "customer_sk", "first_name", "effective_date", "is_current") == sorted([
        (hashlib.md5(b"w2026-01-01").hexdigest(), "Unknown", day("2026-01-01"), False),
        (hashlib.md5(b"w2026-01-04").hexdigest(), "Unknown", day("2026-01-04"), True),
    ])
