"""Documents outside parquet: a sink that sets fields by key, on Spark's Python data sources.

Tasks write JSON lines under names that no other attempt uses and report these names; once all are
done, the driver lists the reported files in the write's own list, which makes them visible at once.
A failed or repeated attempt is in no list, so readers never see it.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tidemark.operators.upsert import newest_fields
from tidemark.sources.batch_table import full_path
from tidemark.sources.tables import read_lookup

_ORDER = "_batch"
_TIMES = {  # whole microseconds; by default JSON keeps milliseconds
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _opened(address: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a full address, as workers reach it."""
    if address.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(address.replace("s3a://", "s3://", 1))


@dataclass
class Written(WriterCommitMessage):
    """The file that a task has finished."""

    name: str


class FieldWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.address, self.list_name = options["path"], options["list"]

    def write(self, iterator: Iterator) -> Written:
        files, folder = _opened(self.address)
        files.create_dir(f"{folder}/files", recursive=True)
        name = f"{uuid.uuid4().hex}.json"
        with files.open_output_stream(f"{folder}/files/{name}") as stream:
            for row in iterator:
                stream.write(f"{row[0]}\n".encode())
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = _opened(self.address)
        files.create_dir(f"{folder}/lists", recursive=True)
        draft = f"{folder}/lists/_{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as stream:
            stream.write("\n".join(m.name for m in messages if m).encode())
        files.move(draft, f"{folder}/lists/{self.list_name}")

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = _opened(self.address)
        for message in messages:
            if message:
                files.delete_file(f"{folder}/files/{message.name}")


class DocumentFields(DataSource):
    """``df.write.format("document_fields")`` of one column of JSON documents."""

    @classmethod
    def name(cls) -> str:
        return "document_fields"

    def schema(self) -> str:
        return "document string"

    def writer(self, schema: T.StructType, overwrite: bool) -> FieldWriter:
        return FieldWriter(self.options)


# Workers get these classes with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def set_fields(
    updates: DataFrame, path: str, key: str | list[str], writer: str, batch_id: int
) -> None:
    """Set the fields that ``updates`` carry in the documents of their keys; others survive.

    ``writer`` names the job that writes; its batch repeated replaces what the first attempt set. A
    null field sets nothing, rows without a key are left out, and a table without rows is a batch
    that sets nothing.
    """
    spark = updates.sparkSession
    for name in [key] if isinstance(key, str) else key:
        updates = updates.where(F.col(name).isNotNull())
    whole = F.struct("*", F.lit(batch_id).cast("long").alias(_ORDER))
    spark.dataSource.register(DocumentFields)
    updates.select(F.to_json(whole, _TIMES).alias("document")).write.format("document_fields").options(
        path=full_path(spark, path), list=f"{writer}-{batch_id}"
    ).mode("append").save()


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType, key: str | list[str]
) -> DataFrame:
    """The documents with the fields of ``schema``: of each the value of the last batch to set it.

    If several rows of one batch set a field of one key, any of their values stays.
    """
    keys = [key] if isinstance(key, str) else list(key)
    address = full_path(spark, path)
    files, folder = _opened(address)
    found = files.get_file_info(pafs.FileSelector(f"{folder}/lists", allow_not_found=True))
    names = []
    for entry in found:
        if not entry.base_name.startswith("_"):
            with files.open_input_stream(entry.path) as stream:
                names += stream.read().decode().split()
    stored = T.StructType([*schema.fields, T.StructField(_ORDER, T.LongType())])
    if not names:
        return spark.createDataFrame([], schema)
    paths = [f"{address}/files/{name}" for name in names]
    rows = read_lookup(spark, paths, stored, "json", **_TIMES)
    fields = [name for name in schema.names if name not in keys]
    return newest_fields(rows, keys, fields, _ORDER).select(*schema.names)
