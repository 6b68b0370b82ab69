"""Nested logs: the entries of a key collected into arrays, in pages.

A page holds at most ``PAGE`` entries, whoever owns it: entries are counted along their time by a
prefix sum over tasks, so a busy key, or entries without a time, fill more pages and not larger ones.
A key that has no more entries than a page holds needs no counting along time.
A batch of a stream makes pages of its own and rewrites none; :func:`repaged` joins small ones.

A streaming aggregate cannot count along time. Its pages are months and slots, the hash of the whole
entry, which need no counting and are the same in every batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranks import numbered, sent_if_small, stored
from tidemark.schemas import ACTIVITY_ENTRY, FACT_ENTRY

PAGE = 1024  # entries of a page, at most

# Hashed pages per key and month. A deployment with very busy keys chooses more, once and for all.
SLOTS = 8


def month_of(time: str) -> Column:
    """Months since the year 0, 0 without a time."""
    moment = F.col(time)
    return F.coalesce(F.year(moment) * 12 + F.month(moment) - 1, F.lit(0))


def page_of(time: str, entry: tuple[str, ...], slots: int = SLOTS) -> Column:
    """The hashed page of an entry."""
    slot = F.pmod(F.xxhash64(*entry), F.lit(slots)).cast("int")
    return (month_of(time) * slots + slot).cast("int")


def hashed_pages(
    rows: DataFrame,
    key: str,
    entry: tuple[str, ...],
    log: str,
    time: str,
    slots: int = SLOTS,
) -> DataFrame:
    """``(key, page, log)`` by month and slot, also of a streaming frame.

    The rows are shuffled once, by key and page; rows without a key are left out.
    """
    paged = rows.where(F.col(key).isNotNull()).select(
        key, page_of(time, entry, slots).alias("page"), F.struct(*entry).alias("entry")
    )
    return paged.groupBy(key, "page").agg(F.sort_array(F.collect_list("entry")).alias(log))


def log_pages(
    rows: DataFrame,
    key: str,
    entry: tuple[str, ...],
    log: str,
    time: str,
    size: int = PAGE,
    kept: bool = False,
) -> DataFrame:
    """``(key, page, log)``: the entries of each key in the order of their time, no time first.

    Page 0 has the first ``size`` entries, page 1 the next ones; entries within a page are sorted.
    Rows without a key are left out. ``rows`` are read twice, so they are stored first unless they
    are ``kept`` already.
    """
    named = rows.where(F.col(key).isNotNull()).select(
        key, F.col(time).alias("_time"), F.struct(*entry).alias("_entry")
    )
    named = named if kept else stored(named, "entries")
    return _paged(named, key, ["_time", F.xxhash64("_entry")], log, size)


def repaged(pages: DataFrame, key: str, log: str, size: int = PAGE) -> DataFrame:
    """Pages of several batches as full ones: the same entries, page after page."""
    each = pages.select(key, "batch_id", "page", F.posexplode(log).alias("_place", "_entry"))
    return _paged(stored(each, "entries"), key, ["batch_id", "page", "_place"], log, size)


def _paged(named: DataFrame, key: str, order: list, log: str, size: int) -> DataFrame:
    """Entries by position; those of a key with one page need none."""
    def collected(placed: DataFrame, page: Column) -> DataFrame:
        entries = F.sort_array(F.collect_list("_entry")).alias(log)
        return placed.groupBy(key, page.cast("int").alias("page")).agg(entries)

    counts = named.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > size)
    busy = stored(counts.select(F.col(key).alias("_busy")), "busy")
    if busy.isEmpty():
        return collected(named, F.lit(0))
    busy = sent_if_small(busy, 64)
    is_busy = F.col(key) == F.col("_busy")
    placed = numbered(named.join(busy, is_busy, "left_semi"), [key], order)
    others = collected(named.join(busy, is_busy, "left_anti"), F.lit(0))
    return collected(placed, F.expr(f"position div {size}")).unionByName(others)


def activity_log(events: DataFrame, size: int = PAGE, kept: bool = False) -> DataFrame:
    """Activity pages per customer from cleaned events."""
    return log_pages(
        events, "customer_id", ACTIVITY_ENTRY, "activity_log", "time_stamp", size, kept
    )


def transaction_log(facts: DataFrame, size: int = PAGE, kept: bool = False) -> DataFrame:
    """Transaction pages per customer from fact rows."""
    return log_pages(facts, "customer_id", FACT_ENTRY, "transaction_log", "time_stamp", size, kept)
