import datetime as dt
import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tidemark.schemas import FEED  # noqa: E402
from tidemark.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture
def feed(spark):
    """Build feed records from ``(key, value)``; a dict becomes JSON text."""

    def build(*records):
        rows = [
            (str(i), f"topic.{key}", key, json.dumps(value) if isinstance(value, dict) else value)
            for i, (key, value) in enumerate(records)
        ]
        return spark.createDataFrame(rows, FEED)

    return build


def change(after, op="c", ts_ms=0):
    record = {"after": after, "op": op, "ts_ms": ts_ms}
    return {k: v for k, v in record.items() if v is not ...}


def day(text):
    return dt.date.fromisoformat(text)
