"""Catalog tables, views and plain table files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import TABLES, TableSpec
from tidemark.sources.batch_table import COMPRESSION


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def create_table(spark: SparkSession, spec: TableSpec, location: str) -> None:
    """Declare an external table over ``location``; nothing happens if it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
    layout = f"PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {spec.qualified} ({columns}) USING parquet "
        f"OPTIONS (compression '{COMPRESSION}') {layout} "
        f"LOCATION '{location}'"
    )


def create_tables(spark: SparkSession, root: str, specs: list[TableSpec] | None = None) -> None:
    """Declare databases and tables below ``root``, a folder per zone and table."""
    specs = list(TABLES.values()) if specs is None else specs
    for zone in dict.fromkeys(spec.zone for spec in specs):
        create_database(spark, zone, f"{root}/{zone}")
    for spec in specs:
        create_table(spark, spec, f"{root}/{spec.zone}/{spec.name}")


def is_empty(spark: SparkSession, path_or_table: str) -> bool:
    """Whether a table holds no row; stops at the first one found."""
    if "/" in path_or_table:
        return spark.read.parquet(path_or_table).isEmpty()
    return spark.table(path_or_table).isEmpty()


def populate_once(spark: SparkSession, name: str, rows: DataFrame) -> bool:
    """Fill a declared table unless it already has rows; tells whether it did."""
    if not is_empty(spark, name):
        return False
    rows.select(*spark.table(name).columns).write.mode("append").insertInto(name)
    return True


def hide_bookkeeping(df: DataFrame, prefix: str = "_") -> DataFrame:
    """The table without its technical columns."""
    return df.select(*[c for c in df.columns if not c.startswith(prefix)])


def create_clean_view(df: DataFrame, view: str, prefix: str = "_") -> None:
    hide_bookkeeping(df, prefix).createOrReplaceTempView(view)


def read_lookup(
    spark: SparkSession, path: str | list[str] | None, schema, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A lookup in any format, with an explicit schema so only its columns are read."""
    reader = spark.read.format(fmt).schema(schema).options(**options)
    return reader.load(path) if path else reader.load()
