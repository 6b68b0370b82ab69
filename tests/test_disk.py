"""What steps keep, shuffle and write, beside their results."""

import time

import pytest
from conftest import change, day
from pyspark.sql import functions as F

from tidemark.operators.envelope import judged, quarantine
from tidemark.operators.fact import fact_rows, with_keys
from tidemark.operators.upsert import upsert
from tidemark.plans.queries import REGISTRY, _as_files
from tidemark.schemas import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, FEED
from tidemark.sources.batch_table import BatchTable


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = blocks.getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())
            if files.apply(i).getName().startswith("shuffle_")}


def test_statement_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(10000).groupBy((F.col("id") % 100).alias("k")).count()
    assert len(rows.collect()) == 100
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert len(rows.collect()) == 100  # the same frame again


def test_only_unreadable_records_keep_their_text(feed):
    good = change({"product_id": 1, "price": "AZA="})
    raw = feed(("product", good), ("product", '{"after": {"product_'), ("customer", change({})))
    kept = {r.offset: r.value for r in judged(raw, "product").collect()}
    assert kept == {"0": None, "1": '{"after": {"product_'}
    assert quarantine(judged(raw, "product"), "product").collect() == quarantine(
        raw, "product"
    ).collect()


def dimension(spark, schema, key, *versions):
    """Versions ``(sk, natural key, effective_date)``, all of them current."""
    rows = spark.createDataFrame(versions, f"sk string, {key}_id string, from date")
    columns = {
        f"{key}_sk": F.col("sk"), f"{key}_id": F.col(f"{key}_id"),
        "effective_date": F.col("from"), "is_current": F.lit(True),
    }
    return rows.select(
        *[columns.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    )


def test_keys_travel_as_days(spark):
    md5 = spark.range(1).select(F.md5(F.lit("a2001-01-01"))).first()[0]
    customers = dimension(
        spark, DIM_CUSTOMER, "customer",
        (md5, "a", day("2001-01-01")), ("own", "b", day("2001-01-01")), (None, "c", None),
    )
    products = dimension(spark, DIM_PRODUCT, "product", ("p", "1", day("2001-01-01")))
    sales = spark.createDataFrame(
        [(t, c, "1") for t, c in (("t1", "a"), ("t2", "b"), ("t3", "c"), ("t4", "d"))],
        "transaction_id string, customer_id string, product_id string",
    ).select(
        "*", F.lit(1).cast("decimal(10,2)").alias("price"), F.lit(1).alias("quantity"),
        F.lit(1).cast("decimal(10,2)").alias("total_amount"),
        F.timestamp_millis(F.lit(0)).alias("timestamp"),
    )
    days = spark.createDataFrame([], DIM_DATE)
    rows = fact_rows(sales, customers, products, days)
    found = {r.transaction_id: (r.customer_sk, r.customer_sk_day) for r in rows.collect()}
    assert found == {
        "t1": (None, day("2001-01-01")), "t2": ("own", None), "t3": (None, None), "t4": (None, None)
    }
    keys = {r.transaction_id: r.customer_sk for r in with_keys(rows).collect()}
    sale_day = {c: spark.range(1).select(F.md5(F.lit(f"{c}1970-01-01"))).first()[0] for c in "cd"}
    assert keys == {"t1": md5, "t2": "own", "t3": sale_day["c"], "t4": sale_day["d"]}


def test_upsert_carries_the_columns_of_the_target_only(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    source = spark.createDataFrame(
        [("a", 2, 1, "x"), ("a", 3, 2, "x"), ("b", 4, 1, "Unknown"), ("c", 5, 1, "Unknown"),
         ("c", 6, 2, "Unknown"), (None, 7, 1, "x")],
        "k string, v int, at int, name string",
    )
    merged = upsert(target, source, "k", ["at"], F.col("name") != "Unknown")
    assert not any(f"{name}, {name}#" in plan_of(merged) for name in ("at", "name"))
    assert {tuple(r) for r in merged.collect()} == {("a", 3), ("b", 1), ("c", 6)}


def test_columns_are_added_behind_the_shuffle_by_folder(spark, tmp_path):
    schema = "id long, text string, part integer"
    rows = spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("part"))
    table = BatchTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ("part",))
    table.add(3, rows, lambda dealt: dealt.withColumn("text", F.col("id").cast("string")))
    assert {(r.id, r.text, r.part, r.batch_id) for r in table.read().collect()} == {
        (i, str(i), i % 2, 3) for i in range(10)
    }


@pytest.mark.parametrize("tasks, each", [(6, "3"), (1, "1")])
def test_a_feed_is_written_by_the_tasks_that_derive_it(spark, tmp_path, tasks, each):
    path = str(tmp_path / "feed")
    rows = spark.range(0, 60, 1, tasks).selectExpr(
        "CAST(id AS STRING) AS offset", "'t' AS topic", "'event' AS key", "'{}' AS value"
    )
    assert _as_files(rows, path, 2) == each
    assert _as_files(rows, path, 2) == each  # of the files that were added
    assert len(list((tmp_path / "feed").glob("part-*"))) == 2 * tasks
    assert spark.read.schema(FEED).parquet(path).count() == 120


def test_sliced_feeds_are_written_by_several_tasks(spark, monkeypatch):
    from pyspark.sql import DataFrame

    asked = []
    coalesce = DataFrame.coalesce
    monkeypatch.setattr(
        type(spark.range(1)), "coalesce", lambda df, n: asked.append(n) or coalesce(df, n)
    )
    rows = REGISTRY["stream_sales_near_changes"](spark, "/root/testdata/sf0.001")
    assert rows.count() > 0
    assert not asked


def test_text_operators_drop_shuffles_and_store_zstd(spark, tmp_path):
    from tidemark.llm.store import materialize, prepare_workers
    from tidemark.session import DROP_SHUFFLES

    spark.conf.set(DROP_SHUFFLES, "false")
    prepare_workers(spark)
    assert spark.conf.get(DROP_SHUFFLES) == "true"
    assert all(name.endswith(".zstd.parquet") for name in materialize(spark.range(3), "t").inputFiles())


def test_a_batch_keeps_its_frames_in_files_only(spark, feed, tmp_path, monkeypatch):
    import os

    from tidemark.session import shared_dir
    from tidemark.streaming.lake import Lake

    kept = []
    persist = type(spark.range(1)).persist
    monkeypatch.setattr(
        type(spark.range(1)), "persist",
        lambda df, *level: kept.append(df.columns) or persist(df, *level),
    )
    sale = {"transaction_id": "t1", "phone_number": "1", "product_id": "1", "quantity": 2}
    lake = Lake(spark, str(tmp_path / "lake"), as_of="2001-01-01")
    for batch in range(2):
        lake.apply(feed(("transaction", change(sale)), ("event", "{broken")), batch)
    assert {tuple(c) for c in kept} == {("transaction_id", "in_month", "in_batch")}
    folder = shared_dir(spark).removeprefix("file://")
    assert not [name for name in os.listdir(folder) if name.startswith("batch-")]
    assert [r.quantity for r in lake.facts().collect()] == [2]
    assert {(r.level, r.quantity, r.sales) for r in lake.revenue().collect()} == {
        (level, 2, 1) for level in range(4)
    }
    assert lake.unreadable.read().count() == 2


def test_finest_sums_are_not_shuffled_again(spark):
    from tidemark.operators.aggregates import revenue_change

    facts = spark.createDataFrame(
        [(199701, "p", 1, 2), (199701, "p", 1, 3), (199701, "q", 1, 4), (None, None, 1, 5)],
        "sale_month int, product_sk string, quantity int, total_amount int",
    )
    sums = revenue_change(facts)
    plan = sums._jdf.queryExecution().optimizedPlan()
    expands = [line for line in plan.toString().split("\n") if "Expand" in line]
    assert len(expands) == 1 and expands[0].count("spark_grouping_id") == 1
    assert plan.toString().startswith("Union")  # the finest sums beside the expanded ones
    assert {(r.level, r.sale_month, r.product_sk): (r.total_amount, r.sales) for r in sums.collect()} == {
        (0, 199701, "p"): (5, 2), (0, 199701, "q"): (4, 1), (0, None, None): (5, 1),
        (1, 199701, None): (9, 3), (1, None, None): (5, 1),
        (2, None, "p"): (5, 2), (2, None, "q"): (4, 1), (2, None, None): (5, 1),
        (3, None, None): (14, 4),
    }


@pytest.mark.parametrize("name", ["star_revenue_by_type_quarter", "star_revenue_by_country"])
def test_reports_over_all_months_store_no_facts(spark, monkeypatch, name):
    added = []
    add = BatchTable.add
    monkeypatch.setattr(BatchTable, "add", lambda table, *a: added.append(table.path) or add(table, *a))
    rows = REGISTRY[name](spark, "/root/testdata/sf0.001")
    assert rows.agg(F.sum("sales")).first()[0] > 0
    assert not added


def test_random_keys_are_counted_before_keys_of_days_are_added(spark):
    plan = REGISTRY["fact_transaction_uuid"](spark, "/root/testdata/sf0.001")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = text.partition("Window ")  # the root comes first
    for day in ("coalesce(customer_sk_day#", "coalesce(product_sk_day#"):
        assert day in above and day not in below
    assert {(r.key_length, r.uses) for r in plan.select("key_length", "uses").distinct().collect()} == {
        (36, 1)
    }


def test_rows_meet_a_stored_history_per_key(spark, monkeypatch):
    from tidemark.operators import asof

    kept = []
    stored = asof.stored
    monkeypatch.setattr(asof, "stored", lambda df, name: kept.append(stored(df, name)) or kept[-1])
    days = [day(f"2026-{m:02}-01") for m in range(1, 13)]
    versions = spark.createDataFrame(
        [("a", d, i) for i, d in enumerate(days)] + [("n", None, 50), ("n", days[5], 51)],
        "key string, effective_date date, v int",
    )
    rows = spark.createDataFrame(
        [(k, d) for k in ("a", "n", "other", None) for d in (day("2025-12-31"), *days, None)],
        "key string, day date",
    )
    found = {(r.key, r.day): r.v for r in asof.version_on_day(rows, versions, "key", "day", ["v"]).collect()}
    assert [found["a", d] for d in (day("2025-12-31"), *days, None)] == [None, *range(12), None]
    # A version without a day is before all others, and a row without a day meets none.
    assert [found["n", d] for d in (days[0], days[5], None)] == [50, 51, None]
    assert {v for (k, _), v in found.items() if k not in ("a", "n")} == {None}
    assert [df.count() for df in kept] == [2]  # a row per key, none per pair of key and day


def test_derived_keys_are_added_behind_the_window(spark):
    from tidemark.operators.scd2 import scd2_from_log, scd2_merge

    records = spark.createDataFrame(
        [("a", day("2026-01-01"), 0, 0), ("a", day("2026-01-02"), 0, 1)],
        "id string, at date, ts_ms long, offset long",
    )
    log = scd2_from_log(records, "id", "sk", F.col("at"), ["ts_ms", "offset"])
    own = F.when(F.dayofmonth("at") == 1, F.lit("own"))  # the other key is null
    kept = log.withColumn("sk", own)
    merged = scd2_merge(kept, records.where("offset = 1"), "id", "sk", F.lit(day("2026-01-03")))
    for history in (log, merged):
        text = history._jdf.queryExecution().optimizedPlan().toString()
        above, _, below = text.partition("Window ")
        assert "md5" in above and "md5" not in below
    keys = {r.effective_date.day: r.sk for r in merged.collect()}
    md5 = spark.range(1).select(F.md5(F.lit("a2026-01-03"))).first()[0]
    assert keys == {1: "own", 2: None, 3: md5}


@pytest.mark.parametrize("name", ["star_revenue_by_weekday", "star_revenue_one_quarter"])
def test_reports_over_a_quarter_store_what_they_read(spark, monkeypatch, name):
    from tidemark.plans import queries

    added, kept = [], []
    add, stored = BatchTable.add, queries.stored
    monkeypatch.setattr(
        BatchTable, "add", lambda table, *a: added.append(table.schema.names) or add(table, *a)
    )
    monkeypatch.setattr(queries, "stored", lambda df, n: kept.append(n) or stored(df, n))
    rows = REGISTRY[name](spark, "/root/testdata/sf0.001")
    assert rows.agg(F.sum("sales")).first()[0] > 0
    assert added == [["date_key", "quantity", "total_amount", "sale_month"]]
    assert not kept  # neither dimensions nor transactions


def test_facts_without_a_dimension_lack_its_key_only(spark):
    from tidemark.operators.fact import build_fact
    from tidemark.plans.queries import gold_of

    gold = gold_of(spark, "/root/testdata/sf0.001")
    whole = gold.facts()
    for left_out, keys in (
        ({"dim_customer": None}, ["customer_sk"]),
        ({"dim_customer": None, "dim_product": None}, ["customer_sk", "product_sk"]),
    ):
        part, rest = build_fact(*gold._replace(**left_out)), whole.drop(*keys)
        assert part.schema == rest.schema
        assert part.exceptAll(rest).isEmpty() and rest.exceptAll(part).isEmpty()


def test_entries_read_the_documents_once(spark):
    from tidemark.plans.queries import entries

    documents = spark.createDataFrame(
        [("both", 1, [("t1", 10), ("t2", 20)], [("e1", 30)]), ("one", 2, None, [("e2", None)]),
         ("none", 3, None, None), ("empty", 4, [], None)],
        "id string, n int, transaction_log array<struct<t: string, time: int>>, "
        "activity_log array<struct<e: string, time: int>>",
    )
    found = entries(documents, "id", "n")
    assert found.columns == ["id", "n", "t", "time", "e"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [
        ("both", 1, "t1", 10, None), ("both", 1, "t2", 20, None), ("both", 1, None, 30, "e1"),
        ("one", 2, None, None, "e2"), ("none", 3, None, None, None),
    ]))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1


def test_merged_purchases_look_no_key_up(spark, monkeypatch):
    from tidemark.plans import queries

    kept = []
    stored = queries.stored
    monkeypatch.setattr(queries, "stored", lambda df, n: kept.append(n) or stored(df, n))
    assert not REGISTRY["merge_profile_documents"](spark, "/root/testdata/sf0.001").isEmpty()
    assert not kept


def test_a_profile_stores_its_sales_once(spark, monkeypatch):
    from tidemark.operators import logs
    from tidemark.plans import queries

    kept = []
    for module in (queries, logs):
        monkeypatch.setattr(
            module, "stored",
            lambda df, name, stored=module.stored: kept.append((name, *df.columns)) or stored(df, name),
        )
    assert not REGISTRY["unified_profile"](spark, "/root/testdata/sf0.001").isEmpty()
    sales = [names for names in kept if names[0] in ("transactions", "dim_product", "entries")]
    assert [names[0] for names in sales] == ["transactions", "entries"]  # the latter of the events
    assert "product_name" not in sales[0]


def test_late_products_look_no_customer_up(spark, monkeypatch):
    from tidemark.plans import queries

    kept = []
    stored = queries.stored
    monkeypatch.setattr(queries, "stored", lambda df, n: kept.append(n) or stored(df, n))
    facts = REGISTRY["fact_late_products"](spark, "/root/testdata/sf0.001")
    assert facts.columns == ["transaction_sk", "product_sk", "date_key"]
    assert not kept and "customer_sk" not in plan_of(facts)


def test_sums_and_not_sales_meet_the_persons(spark, monkeypatch):
    from tidemark.plans import queries

    kept, met = [], []
    stored, by_person = queries.stored, queries.by_person
    monkeypatch.setattr(queries, "stored", lambda df, n: kept.append(n) or stored(df, n))
    monkeypatch.setattr(
        queries, "by_person", lambda rows, people: met.append(rows) or by_person(rows, people)
    )
    found = REGISTRY["revenue_by_person"](spark, "/root/testdata/sf0.001")
    assert found.agg(F.sum("sales")).first() == met[0].agg(F.sum("sales")).first()
    assert kept == ["sold"]
    assert met[0].count() == met[0].select("customer_id", "phone_number").distinct().count()


def test_only_repeated_keys_are_shuffled(spark, monkeypatch):
    from tidemark.operators import latest

    rows = spark.createDataFrame(
        [("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), ("b", 1, "only"), (None, 1, "no key"),
         ("c", None, "only")],
        "id string, ts int, v string",
    )
    expected = {("a", 3, "new"), ("b", 1, "only"), ("c", None, "only")}
    reduced = []
    latest_per_key = latest.latest_per_key
    monkeypatch.setattr(
        latest, "latest_per_key", lambda df, *a: reduced.append(df) or latest_per_key(df, *a)
    )
    found = latest.latest_of_stored(rows, "id", ["ts"])
    assert found.columns == rows.columns
    assert {tuple(r) for r in found.collect()} == expected and found.count() == 3
    assert {r.id for r in reduced.pop().collect()} == {"a"}
    monkeypatch.setattr(latest, "SENT_BYTES", 0)  # too many to be sent
    assert {tuple(r) for r in latest.latest_of_stored(rows, "id", ["ts"]).collect()} == expected
    assert reduced.pop().count() == len(rows.collect())


def test_a_first_load_keeps_its_frames_in_files_only(spark, feed, tmp_path, monkeypatch):
    import os

    from tidemark.plans.backfill import load_tables
    from tidemark.schemas import TABLES
    from tidemark.session import shared_dir

    kept = []
    persist = type(spark.range(1)).persist
    monkeypatch.setattr(
        type(spark.range(1)), "persist",
        lambda df, *level: kept.append(df.columns) or persist(df, *level),
    )
    for zone in {spec.zone for spec in TABLES.values()}:
        spark.sql(f"DROP DATABASE IF EXISTS {zone} CASCADE")
    try:
        sale = {"transaction_id": "t1", "phone_number": "1", "product_id": "1", "quantity": 2}
        raw = feed(*[("transaction", change(sale, ts_ms=ms)) for ms in (1000, 0)])
        load_tables(spark, raw, str(tmp_path / "catalog"), "2001-01-01")
        (fact,) = spark.table(TABLES["fact_transaction"].qualified).collect()
        assert (fact.transaction_id, fact.time_stamp.second) == ("t1", 1)
        files = [
            name for spec in TABLES.values() for name in spark.table(spec.qualified).inputFiles()
        ]
        assert files and all(name.endswith(".zstd.parquet") for name in files)
        assert not kept
        folder = shared_dir(spark).removeprefix("file://")
        assert not [name for name in os.listdir(folder) if name.startswith("cleaned-")]
    finally:
        for zone in {spec.zone for spec in TABLES.values()}:
            spark.sql(f"DROP DATABASE IF EXISTS {zone} CASCADE")


def lookups(spark):
    rows = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 3), ("c", 4), ("own", 5), ("unknown", 6), (None, 7)],
        "key string, n int",
    )
    table = spark.createDataFrame(
        [(k, None, day("2001-01-01")) for k in ("a", "b", "c", "unused")] + [("own", "sk", None)],
        "key string, sk string, sk_day date",
    )
    return rows, table


@pytest.mark.parametrize("sent", [4 << 20, 0])
def test_rows_stay_where_most_keys_find_the_same(spark, tmp_path, monkeypatch, sent):
    from tidemark.operators import lookup

    rows, table = lookups(spark)
    expected = {tuple(r) for r in lookup.lookup_join(rows, table, "key").collect()}
    monkeypatch.setattr(lookup, "SENT_BYTES", sent)
    asked = []
    join = lookup.lookup_join
    monkeypatch.setattr(lookup, "lookup_join", lambda df, *a: asked.append(df) or join(df, *a))
    found = lookup.lookup_of_stored(rows, table, "key", str(tmp_path / "found"))
    assert {tuple(r) for r in found.collect()} == expected and found.count() == 7
    assert asked[0].count() == 5  # the distinct keys; the rows themselves only if others are many
    assert len(asked) == (1 if sent else 2)
    none = lookup.lookup_of_stored(rows.where("n = 7"), table, "key", str(tmp_path / "none"))
    assert [tuple(r) for r in none.collect()] == [(None, 7, None, None)]
    strange = lookup.lookup_of_stored(rows.where("n = 6"), table, "key", str(tmp_path / "strange"))
    assert [tuple(r) for r in strange.collect()] == [("unknown", 6, None, None)]


@pytest.mark.parametrize("sent", [4 << 20, 0])
def test_keys_are_counted_by_their_hashes(spark, monkeypatch, sent):
    from tidemark.operators import latest

    monkeypatch.setattr(latest, "SENT_BYTES", sent)
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, n int")
    found = latest.counted_in_stored(rows, "k", "uses")
    assert {(r.n, r.uses) for r in found.collect()} == {(1, 2), (2, 2), (3, 1), (4, 2), (5, 2)}
    alone = latest.counted_in_stored(rows.where("n > 2 and n < 5"), "k", "uses")
    assert {(r.n, r.uses) for r in alone.collect()} == {(3, 1), (4, 1)}
    assert "Window" not in plan_of(alone)


def test_facts_with_random_keys_meet_in_no_window(spark):
    assert "Window" not in plan_of(REGISTRY["fact_transaction_uuid"](spark, "/root/testdata/sf0.001"))


def test_a_table_without_batches_is_empty_to_the_planner(spark, tmp_path):
    schema = spark.createDataFrame([], "id long").schema
    table = BatchTable(spark, str(tmp_path / "t"), schema)
    met = table.read().join(spark.range(9).hint("merge"), "id", "left_semi").groupBy("id").count()
    assert "Exchange" not in plan_of(met) and met.isEmpty()


def test_unreadable_records_are_parsed_once(feed):
    found = quarantine(feed(("transaction", change({})), ("transaction", "{broken")), "transaction")
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
    assert [(r.value, r.reason) for r in found.collect()] == [("{broken", "malformed json")]


def test_lines_of_an_order_lie_together(spark):
    from tidemark.sources.warehouse_feeds import transaction_feed

    order = F.floor(F.col("offset").cast("long") / 8)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    sent = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as where no table is small enough to be sent
    try:
        tasks = transaction_feed(spark, "/root/testdata/sf0.001").select(order).rdd.glom().collect()
    finally:
        spark.conf.set(threshold, sent)
    for task in tasks:
        orders = [row[0] for row in task]
        changes = sum(a != b for a, b in zip(orders, orders[1:], strict=False))
        assert changes == max(len(set(orders)) - 1, 0)
    assert len({row[0] for task in tasks for row in task}) == sum(
        len({row[0] for row in task}) for task in tasks
    )


def test_sales_of_a_batch_are_gone_once_its_facts_are_stored(spark, feed, tmp_path, monkeypatch):
    import os

    from tidemark.session import shared_dir
    from tidemark.streaming import lake as module

    top, left = shared_dir(spark).removeprefix("file://"), []
    change_of = module.revenue_change

    def seen(added, replaced):
        for name in os.listdir(top):
            if name.startswith("batch-"):
                left.append(sorted(os.listdir(f"{top}/{name}")))
        return change_of(added, replaced)

    monkeypatch.setattr(module, "revenue_change", seen)

    def sale(name, quantity, **more):
        return {"transaction_id": name, "phone_number": "1", "product_id": "1", "quantity": quantity} | more

    lake = module.Lake(spark, str(tmp_path / "lake"), as_of="2001-01-01")
    first = [("transaction", change(sale("t1", 1), ts_ms=0)), ("transaction", change(sale("t1", 2), ts_ms=5))]
    lake.apply(feed(*first, ("transaction", change(sale("t2", 3, customer_id="c")))), 0)
    lake.apply(feed(("transaction", change(sale("t1", 7), ts_ms=9))), 1)
    assert left == [["facts"], ["facts"]]
    assert {(r.transaction_id, r.quantity) for r in lake.facts().collect()} == {("t1", 7), ("t2", 3)}
    assert {(r.quantity, r.sales) for r in lake.revenue().where("level = 3").collect()} == {(10, 2)}
    assert not [name for name in os.listdir(top) if name.startswith("batch-")]


def test_facts_are_repaired_in_passes(spark, tmp_path, monkeypatch):
    from tidemark.operators import fact
    from tidemark.operators.calendar import dim_date

    names = ["known", "late", "twice", "twice", "gone", None]
    sales = spark.createDataFrame(
        [(t, "c", "old" if t == "known" else "new") for t in names],
        "transaction_id string, customer_id string, product_id string",
    ).select(
        "*", F.lit(1).cast("decimal(10,2)").alias("price"), F.lit(1).alias("quantity"),
        F.lit(1).cast("decimal(10,2)").alias("total_amount"),
        F.timestamp_millis(F.lit(0)).alias("timestamp"),
    )
    customers = dimension(spark, DIM_CUSTOMER, "customer", ("c1", "c", day("2001-01-01")))
    old = dimension(spark, DIM_PRODUCT, "product", ("old1", "old", day("2001-01-01")))
    both = old.union(dimension(spark, DIM_PRODUCT, "product", ("new1", "new", day("2001-01-01"))))
    days = dim_date(spark, "2001-01-01")
    early = fact.build_fact(sales, customers, old, days)
    built = []
    build_fact = fact.build_fact
    monkeypatch.setattr(fact, "build_fact", lambda df, *a, **o: built.append(df) or build_fact(df, *a, **o))
    given = sales.where("transaction_id <> 'gone'")
    repaired = fact.repair_facts(early, given, customers, both, days, folder=str(tmp_path / "repair"))
    unknown = spark.range(1).select(F.md5(F.lit("new1970-01-01"))).first()[0]
    found = sorted((r.transaction_id or "", r.product_sk, r.customer_sk) for r in repaired.collect())
    assert found == [
        ("", unknown, "c1"), ("gone", unknown, "c1"), ("known", "old1", "c1"), ("late", "new1", "c1"),
        ("twice", "new1", "c1"), ("twice", "new1", "c1"),
    ]
    assert len(list((tmp_path / "repair" / "stay").iterdir())) > 1
    (again,) = built  # once, and only what was unknown
    assert sorted(r.transaction_id for r in again.collect()) == ["late", "twice", "twice"]


def test_sales_are_stored_before_they_meet_histories(spark, monkeypatch):
    from tidemark.plans import queries

    kept = []
    stored = queries.stored
    monkeypatch.setattr(queries, "stored", lambda df, name: kept.append(name) or stored(df, name))
    assert REGISTRY["fact_on_sale_day"](spark, "/root/testdata/sf0.001").count() > 0
    assert kept == ["sold"]


def test_pieces_are_deleted_once_the_stream_has_read_them(spark, monkeypatch):
    from tidemark.plans import queries

    gone = []
    monkeypatch.setattr(queries, "delete_folder", lambda spark, path: gone.append(path.rpartition("/")[2]))
    assert REGISTRY["stream_sales_near_changes"](spark, "/root/testdata/sf0.001").count() > 0
    assert gone == ["sales", "changes"] * 4
