"""Fields of documents set by several writers, failed attempts and repeated batches."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.document_sink import read_documents, set_fields

SCHEMA = (
    T.StructType().add("k", "string").add("name", "string").add("seen", "timestamp")
    .add("tags", T.ArrayType(T.StringType()))
)


def documents(spark, path):
    return {r.k: (r.name, str(r.seen and r.seen.microsecond), r.tags)
            for r in read_documents(spark, path, SCHEMA, "k").collect()}


def test_writers_of_different_fields_both_survive(spark, tmp_path):
    path = str(tmp_path / "d")
    assert documents(spark, path) == {}
    names = spark.createDataFrame([("a", "An"), ("b", "Binh"), (None, "x")], "k string, name string")
    seen = spark.sql("SELECT 'a' k, timestamp'2026-01-05 12:00:00.123456' seen, array('x', 'y\\n') tags "
                     "UNION ALL SELECT 'c', NULL, array()")
    set_fields(names, path, "k", "people", 0)
    set_fields(seen, path, "k", "activity", 0)
    expected = {"a": ("An", "123456", ["x", "y\n"]), "b": ("Binh", "None", None),
                "c": (None, "None", [])}
    assert documents(spark, path) == expected
    later = spark.createDataFrame([("a", None), ("b", "Chi")], "k string, name string")
    set_fields(later, path, "k", "people", 1)  # a null sets nothing
    assert documents(spark, path) == expected | {"b": ("Chi", "None", None)}
    set_fields(later.where("false"), path, "k", "people", 1)  # batch 1 again, now without rows
    assert documents(spark, path) == expected


def test_failed_attempt_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = spark.range(200).repartition(4).select(
        F.col("id").cast("string").alias("k"), F.lit("An").alias("name"), "id"
    )
    set_fields(rows.where("id < 2").drop("id"), path, "k", "people", 0)
    stored = set(os.listdir(f"{path}/files"))
    breaking = rows.withColumn(
        "name", F.when(F.col("id") == 150, F.raise_error(F.lit("lost"))).otherwise("Binh")
    )
    with pytest.raises(Exception, match="lost"):
        set_fields(breaking.drop("id"), path, "k", "people", 1)
    assert {k: v[0] for k, v in documents(spark, path).items()} == {"0": "An", "1": "An"}
    listed = set()
    for name in os.listdir(f"{path}/lists"):
        with open(f"{path}/lists/{name}") as names:
            listed |= set(names.read().split())
    assert listed == stored
