"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


# Files of a shuffle are deleted when the statement that wrote them has ended. Else they stay until
# the driver collects garbage, so the disk holds all shuffles of a long job at once.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A task that writes several folders keeps so many files open; it sorts, and spills, only beyond.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
DISK_SETTINGS = {DROP_SHUFFLES: "true", OPEN_FILES: "4"}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC, ANSI and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in DISK_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for one run below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_garbage(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that Spark deletes the shuffles of frames no longer kept."""
    gc.collect()
    spark._jvm.System.gc()


def together(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Run independent jobs at the same time, so that small ones do not wait for large ones.

    The threads inherit the caller's job group, so stopping a stream cancels the jobs of its batch.
    All steps end before the first failure, if any, is raised; else their results are returned.
    """
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]
