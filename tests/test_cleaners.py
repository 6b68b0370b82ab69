"""Literal feed records through the cleaners."""

import datetime as dt
import hashlib
from decimal import Decimal

from conftest import change, day
from pyspark.sql import functions as F

from tidemark.operators.cleaners import (
    clean_customer,
    clean_event,
    clean_product,
    clean_transaction,
)
from tidemark.operators.envelope import quarantine, union_feeds
from tidemark.operators.walkins import placeholder_customers, with_placeholders
from tidemark.schemas import SILVER_CUSTOMER

CUSTOMER = {
    "customer_id": "c1", "first_name": "An", "last_name": "Le", "gender": "male",
    "date_of_birth": -1, "email": "a@x", "phone_number": "+84 912-345-678", "address": "x",
    "country": "Vietnam", "creation_date": 24856,
}
SALE = {
    "transaction_id": "t1", "customer_id": "c1", "product_id": 7, "phone_number": "(09) 12 345",
    "product_name": "lamp", "price": "MDk=", "quantity": 2, "total_amount": "z8c=",
    "event_time": None, "source": "web",
}
NO_RECORDS = ({"op": "d", "after": None}, None, "not json")


def test_customer(feed):
    raw = feed(("customer", change(CUSTOMER, "r", 5)), ("product", change({"product_id": 1})))
    (row,) = clean_customer(raw).collect()
    assert row.asDict() == {
        "customer_id": "c1", "first_name": "An", "last_name": "Le", "gender": "male",
        "date_of_birth": day("1969-12-31"), "email": "a@x", "phone_number": "0912345678",
        "country": "Vietnam", "customer_creation_date": day("2038-01-20"), "ts_ms": 5, "offset": 0,
    }


def test_records_without_data_leave_no_row(feed):
    for key, cleaner in (
        ("customer", clean_customer),
        ("product", clean_product),
        ("transaction", lambda raw: clean_transaction(raw, "2026-01-02")),
        ("event", clean_event),
    ):
        assert cleaner(feed(*[(key, value) for value in NO_RECORDS])).collect() == []


def test_missing_operation_is_dropped_for_customers_only(feed):
    assert clean_customer(feed(("customer", change(CUSTOMER, ...)))).count() == 0
    assert clean_product(feed(("product", change({"product_id": 1}, ...)))).count() == 1
    sale = feed(("transaction", change(SALE, ...)))
    assert clean_transaction(sale, "2026-01-02").count() == 1


def test_product(feed):
    after = {"product_id": 7, "product_name": "lamp", "price": "MDk=", "base_price": None,
             "sale_percents": "5"}
    (row,) = clean_product(feed(("product", change(after)))).collect()
    assert (row.product_id, row.price, row.base_price) == ("7", Decimal("123.45"), None)
    assert row.sale_percents == "5"


def test_transaction(feed):
    raw = feed(("transaction", change(SALE, "u", 1700000000123)))
    (row,) = clean_transaction(raw, "2026-01-02").collect()
    assert (row.customer_id, row.product_id, row.phone_number) == ("c1", "7", "0912345")
    assert (row.price, row.total_amount) == (Decimal("123.45"), Decimal("-123.45"))
    assert row.timestamp == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert row.is_new_customer is False


def test_walk_in_gets_an_id_per_phone_and_day(feed):
    walk_in = {**SALE, "customer_id": None, "phone_number": "0912"}
    no_phone = {**SALE, "phone_number": None}
    raw = feed(("transaction", change(walk_in)), ("transaction", change(no_phone)))
    (row,) = clean_transaction(raw, "2026-01-02").collect()
    assert row.is_new_customer is True
    assert row.customer_id == hashlib.md5(b"09122026-01-02").hexdigest()


def test_phone_rules_differ_only_in_compat_mode(feed):
    raw = feed(("transaction", change({**SALE, "phone_number": "+84912345678"})))
    assert clean_transaction(raw, "2026-01-02").first().phone_number == "0912345678"
    compat = clean_transaction(raw, "2026-01-02", strict_compat=True)
    assert compat.first().phone_number == "084912345678"


def test_event(feed):
    after = {"event_id": 3, "type": "view", "customer_id": "c1", "url": None,
             "time_stamp": "2024-01-01T00:00:07.179575Z"}
    raw = feed(("event", change(after)), ("event", change({**after, "customer_id": None})))
    (row,) = clean_event(raw).collect()
    assert (row.event_id, row.url) == ("3", None)
    assert row.time_stamp == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    assert clean_event(raw, strict_compat=True).count() == 2


def test_quarantine(feed):
    raw = feed(
        ("product", "not json"),
        ("product", change({"product_id": 1, "price": "!!*"})),
        ("product", change({"product_id": 1, "price": "MDk=", "base_price": "#"})),
        ("product", change({"product_id": 1, "price": "MDk="})),
        ("product", None),
    )
    found = {(r.offset, r.reason) for r in quarantine(raw, "product").collect()}
    assert found == {
        ("0", "malformed json"), ("1", "undecodable price"), ("2", "undecodable base_price"),
    }


def test_placeholders_join_the_customers_by_name(feed):
    walk_in = {**SALE, "customer_id": None, "phone_number": "0912"}
    raw = feed(("customer", change(CUSTOMER)), ("transaction", change(walk_in, "c", 86400000)))
    sales = clean_transaction(raw, "2026-01-02")
    (row,) = placeholder_customers(sales).select(*SILVER_CUSTOMER.names).collect()
    assert row.asDict() == {
        "customer_id": hashlib.md5(b"09122026-01-02").hexdigest(), "first_name": "Unknown",
        "last_name": "Unknown", "gender": "Unknown", "date_of_birth": None, "email": "Unknown",
        "phone_number": "0912", "country": "Unknown",
        "customer_creation_date": day("1970-01-02"),
    }
    everyone = with_placeholders(clean_customer(raw).drop("email"), sales)
    assert {r.email for r in everyone.collect()} == {None, "Unknown"}


def test_union_keeps_duplicates(feed):
    raw = feed(("event", change({"event_id": 1})))
    assert union_feeds(raw, raw, raw).where(F.col("key") == "event").count() == 3
