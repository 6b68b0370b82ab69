"""Unified customer profile: demographics with transaction and activity logs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.logs import PAGE, activity_log, transaction_log

DEMOGRAPHICS = ("first_name", "last_name", "gender", "date_of_birth")


class Profile(NamedTuple):
    """``people`` has one row per customer, ``pages`` the pages of both logs.

    A page belongs to one log and is null in the other. Customers known only from a log have pages
    and no row of ``people``.
    """

    people: DataFrame
    pages: DataFrame

    def documents(self) -> DataFrame:
        """Every page of the customers with their demographics; one row without pages."""
        return self.people.join(self.pages, "master_id", "left")


def build_profile(
    customers: DataFrame,
    facts: DataFrame,
    events: DataFrame | None = None,
    size: int = PAGE,
    kept: bool = False,
) -> Profile:
    """The profile of every customer: demographics, transaction log and, given events, activity.

    Facts are stored for their log unless they are ``kept`` already.
    """
    pages = transaction_log(facts, size, kept)
    if events is not None:
        pages = pages.unionByName(activity_log(events, size), allowMissingColumns=True)
    people = customers.select(F.col("customer_id").alias("master_id"), *DEMOGRAPHICS)
    return Profile(people, pages.withColumnRenamed("customer_id", "master_id"))
