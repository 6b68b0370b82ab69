"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores of the local session and ``BENCH_RUNS``
the runs per query. The change feeds are written before the clock starts; a query's time covers
everything from the written records to the last result row: parsing, the layers stored in between,
and the result. The value reported per query is the median of its runs in one warm session.

``BENCH_HOT=10`` writes every feed ten times, with keys of its own each time, gives a third of the
sales and events to one customer, and times the queries that shuffle by customer, with the joins to
the dimensions forced to shuffle.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.plans.queries import REGISTRY  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.warehouse_feeds import write_feeds  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HOT = int(os.environ.get("BENCH_HOT", "0"))

# Runs once: each of them starts streams on folders of its own.
STREAMS = ("stream_bronze_counts", "stream_fact_equals_batch")
HEADLINE = (
    "clean_transaction",
    "upsert_customer_guarded",
    "scd2_customer_full",
    "scd2_customer_merge",
    "fact_transaction",
    "activity_log",
    "unified_profile",
    "star_revenue_by_type_quarter",
    *STREAMS,
)
# What a busy customer and shuffled dimensions bear on.
SKEWED = (
    "fact_transaction_shuffled", "activity_log", "transaction_log", "unified_profile",
    "resolve_transactions", "star_revenue_by_country",
)
FEED_TABLES = ("customer", "part", "lineitem", "events")


def seconds(spark, name: str) -> float:
    started = time.perf_counter()
    REGISTRY[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def repeated(name: str, records):
    """A feed ``HOT`` times over; sales and events have ids of their own and one busy customer."""
    if name not in ("transaction_feed", "event_feed"):
        return records
    copies = records.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(HOT))))
    own_id = F.concat(F.lit('_id":"'), F.col("copy").cast("string"), F.lit("-"))
    value = F.regexp_replace("value", F.lit('(?<=transaction|event)_id":"?'), own_id)
    value = F.regexp_replace(value, F.lit('("event_id":"[0-9-]+)"?,'), F.lit('$1",'))
    busy = F.regexp_replace(value, '"customer_id":"[0-9]+"', '"customer_id":"1"')
    return copies.select(
        F.concat("offset", F.lpad(F.col("copy").cast("string"), 2, F.lit("0"))).alias("offset"),
        "topic", "key",
        F.when(F.xxhash64("offset", "copy") % 3 == 0, busy).otherwise(value).alias("value"),
    )


def main() -> None:
    work = tempfile.TemporaryDirectory(prefix="bench-")
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=CPUS,
        spark__checkpoint__dir=f"{work.name}/shared",
        spark__sql__warehouse__dir=f"{work.name}/warehouse",
    )
    spark.sparkContext.setLogLevel("ERROR")
    write_feeds(spark, SF_DIR, f"{work.name}/feeds", repeated if HOT else None)
    times = {}
    for name in SKEWED if HOT else HEADLINE:
        runs = 1 if name in STREAMS or HOT else RUNS
        times[name] = round(statistics.median(seconds(spark, name) for _ in range(runs)), 3)
    records = sum(spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in FEED_TABLES)
    spark.stop()
    work.cleanup()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "runs": RUNS,
        "hot": HOT,
        "stream_records_per_sec": {
            name: round(records / times[name]) for name in STREAMS if name in times
        },
    }))


if __name__ == "__main__":
    main()
