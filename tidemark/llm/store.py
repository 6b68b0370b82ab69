"""Intermediate tables and files in the folder that all executors share."""

from __future__ import annotations

import os
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import DROP_SHUFFLES, work_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back: nothing below it is computed again."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder named by address or path, and the path in it."""
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder)


class NewFile:
    """A file under a name that no other attempt uses.

    Only the attempts that Spark counts as done get their names into the manifest, so a file left
    by a lost executor or a repeated task is never read.
    """

    def __init__(self, folder: str, suffix: str):
        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self.stream = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append and return where the data begins."""
        at = self.size
        self.stream.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self.stream.close()


def open_file(folder: str, name: str):
    """A seekable file written as a NewFile."""
    system, path = file_system(folder)
    return system.open_input_file(f"{path}/{name}")


# Rows, and bytes of rows, that a Python worker gets at once. Documents are long, and a worker holds
# what it gets, what it makes of it and what it sends back. A longer row comes by itself.
ROWS_AT_ONCE = 1000
BYTES_AT_ONCE = 1 << 20


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed but run from its folder.

    Also bounds what they get at once, and lets Spark delete a shuffle once its statement has ended.
    """
    spark.conf.set(DROP_SHUFFLES, "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_AT_ONCE)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        joined = os.pathsep.join(x for x in (root, known) if x)
        spark.sparkContext.environment["PYTHONPATH"] = joined


BROADCAST_BYTES = 4 << 20


def sent_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table, to be sent to every executor if its rows are few bytes together.

    Beyond ``BROADCAST_BYTES`` the same join shuffles both sides; the result does not differ.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
