"""Tables that micro-batches add to, on Spark's own parquet writer.

A batch is a partition ``batch_id=N``, written by dynamic partition overwrite: files are staged and
moved into place when the whole write is committed. A batch that dies, on its first attempt or a
repeated one, leaves the table as it was; a repeated batch replaces its own rows. Adding costs the
size of the batch. Where rows of one key come in several batches, readers reduce them, and
:meth:`BatchTable.compact` does so for the batches that no stream repeats any more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPRESSION = "zstd"  # of stored tables


class BatchTable:
    """Rows of ``schema`` below ``path``, by batch and then by ``partition_by``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        partition_by: tuple[str, ...] = (),
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.partition_by = partition_by

    def add(
        self,
        batch_id: int,
        rows: DataFrame,
        finish: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Store a batch; ``finish`` adds what need not be shuffled, as it derives from the row."""
        if self.partition_by:  # else every task writes a file of its own into every folder
            rows = rows.hint("rebalance", *self.partition_by)
        rows = finish(rows) if finish else rows
        named = rows.select(*self.schema.names, F.lit(batch_id).cast("long").alias("batch_id"))
        (
            named.write.mode("overwrite")
            .option("compression", COMPRESSION)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", *self.partition_by)
            .parquet(self.path)
        )

    def read(self, before: int | None = None) -> DataFrame:
        """All rows with their ``batch_id``, or those of batches before one."""
        stored = T.StructType(self.schema.fields + [T.StructField("batch_id", T.LongType())])
        if not self.batches():
            # The filter lets the planner see that there are no rows, so nothing is shuffled for them.
            return self.spark.createDataFrame([], stored).where(F.lit(False))
        rows = self.spark.read.schema(stored).parquet(self.path).select(*stored.names)
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def batches(self) -> list[int]:
        """The stored batches in order."""
        prefix = "batch_id="
        names = folder_names(self.spark, self.path)
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))

    def compact(self, reduce: Callable[[DataFrame], DataFrame]) -> None:
        """Replace all batches but the last, which a stream may repeat, by one reduced batch.

        ``reduce`` must give the same rows whether or not a part of its input is reduced already,
        so a compaction that dies half-way changes nothing that readers see.
        """
        older = self.batches()[:-1]
        if len(older) < 2:
            return
        self.add(older[-1], reduce(self.read(before=older[-1] + 1)))
        for batch in older[:-1]:
            delete_folder(self.spark, f"{self.path}/batch_id={batch}")


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def full_path(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark finds it in."""
    files, folder = _file_system(spark, path)
    return files.makeQualified(folder).toString()


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _file_system(spark, path)
    return files.exists(folder)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return []
    return [status.getPath().getName() for status in files.listStatus(folder)]


def delete_folder(spark: SparkSession, path: str) -> None:
    files, folder = _file_system(spark, path)
    files.delete(folder, True)
