"""One person behind several customer ids: ids that share a phone number, directly or by others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join
from tidemark.operators.ranks import stored
from tidemark.operators.upsert import PLACEHOLDER


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; a component is its least node.

    Every node points at its least neighbour, and all its other neighbours are linked with that one
    instead of with it; then every node is linked with the least node below it. Repeated until
    nothing changes, this leaves stars, in a number of rounds that grows with the logarithm of the
    longest path. Each round is stored in the shared folder. A node's least neighbour is found
    before a shuffle, so a number that very many ids share is no group in one task.
    """
    now = stored(links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL"), "links")
    seen = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b >= a").join(least, "a").select(F.col("b").alias("a"), "m").distinct()
        lower = large.groupBy("a").agg(F.min("m").alias("l"))
        small = large.join(lower, "a").select(F.col("m").alias("a"), F.col("l").alias("b"))
        now = stored(small.union(lower.select("a", F.col("l").alias("b"))).distinct(), "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
        seen = tuple(state)


def persons(customers: DataFrame, sightings: DataFrame) -> DataFrame:
    """``customer_id, person_id`` of every id that occurs in either table.

    Ids belong to one person if they were seen with the same phone number, or with numbers that
    other ids join. The person keeps the least id of its registered, named customers; without any,
    the least id. ``customers`` has ``customer_id, first_name, phone_number``, ``sightings`` has
    ``customer_id, phone_number``. Without a number an id is a person by itself; rows without an id
    are left out.
    """
    named = F.coalesce(F.col("first_name") != PLACEHOLDER, F.lit(False))
    seen = customers.select("customer_id", "phone_number", named.alias("named")).unionByName(
        sightings.select("customer_id", "phone_number", F.lit(False).alias("named"))
    ).where("customer_id IS NOT NULL")
    seen = stored(
        seen.groupBy("customer_id", "phone_number").agg(F.max("named").alias("named")), "seen"
    )
    # An id and a number may be the same text, so nodes tell which they are.
    node = F.concat(F.lit("id "), F.col("customer_id"))
    number = F.coalesce(F.concat(F.lit("no "), F.col("phone_number")), node)
    parts = connected(seen.select(node.alias("a"), number.alias("b")))
    ids = parts.where(F.col("node").startswith("id ")).select(
        F.substring("node", 4, 1 << 30).alias("customer_id"), "component"
    )
    known = seen.groupBy("customer_id").agg(F.max("named").alias("named"))
    ids = stored(ids.join(known, "customer_id"), "ids")
    kept = ids.groupBy("component").agg(
        F.min_by("customer_id", F.struct(~F.col("named"), "customer_id")).alias("person_id")
    )
    return ids.join(kept, "component").select("customer_id", "person_id")


def by_person(rows: DataFrame, people: DataFrame, key: str = "customer_id") -> DataFrame:
    """``rows`` with the surviving id of each person in place of ``key``; unknown ids stay."""
    lookup = people.select(F.col("customer_id").alias(key), "person_id")
    met = lookup_join(rows, lookup, key)
    own = F.coalesce("person_id", F.col(key)).alias(key)
    return met.select(*[own if name == key else F.col(name) for name in rows.columns])
