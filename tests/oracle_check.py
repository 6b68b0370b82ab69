"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf] [query ...]``."""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TESTDATA = "/root/testdata"


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for path in glob.glob(f"{sf_dir}/*.parquet"):
            name = os.path.basename(path).removesuffix(".parquet")
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
        result = db.execute(sql)
        names = [c[0] for c in result.description]
        return names, result.fetchall()


def normalized(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    cell = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def difference(spark, name: str, sf_dir: str) -> str | None:
    """None if the query and its SQL agree, else what differs first."""
    from tidemark.plans.oracles import ORACLES
    from tidemark.plans.queries import REGISTRY

    df = REGISTRY[name](spark, sf_dir)
    ours = normalized(df.columns, df.collect())
    if name not in ORACLES:
        return None if ours else "no rows"
    names, rows = oracle_rows(sf_dir, ORACLES[name])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs = normalized(names, rows)
    if ours == theirs:
        return None if ours else "no rows"
    first = next((p for p in zip(ours, theirs, strict=False) if p[0] != p[1]), None)
    return f"{len(ours)} rows != {len(theirs)} rows; first difference {first}"


if __name__ == "__main__":
    from tidemark.plans.queries import REGISTRY
    from tidemark.session import build_session

    work = tempfile.TemporaryDirectory(prefix="oracle-check-")
    spark = build_session(
        "oracle-check", "local[8]", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=work.name, spark__sql__warehouse__dir=f"{work.name}/warehouse",
    )
    spark.sparkContext.setLogLevel("ERROR")
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    for query in sys.argv[2:] or REGISTRY:
        started = time.time()
        try:
            found = difference(spark, query, f"{TESTDATA}/sf{scale}")
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if found is None else 'FAIL'} {time.time() - started:6.1f}s {query} "
              f"{found or ''}", flush=True)
    spark.stop()
    work.cleanup()
