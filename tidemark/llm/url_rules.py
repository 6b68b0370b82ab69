"""Rules for hosts and paths applied to urls: a sort-merge range join.

A host is written from its last label to its first, so all its subdomains begin with its key and
form one interval in the order of keys. Pages and rules are dealt out by ranges of that order, a
rule to every range that its interval meets, and each range is swept once with a stack of the rules
whose intervals are open, the nested ones on top.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import sample_of
from tidemark.llm.store import materialize

SAMPLES = 64  # pages looked at per range to choose where ranges begin
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW = (
    "part int, key string, kind int, salt long, page_id long, host string, path string,"
    " verdict string"
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_key(host: Column) -> Column:
    """The labels from last to first, each ended by a dot: a host's key begins its subdomains'."""
    return F.when(
        host == "", ""
    ).otherwise(F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit(".")))


def _bounds(pages: DataFrame, parts: int) -> list[tuple[str, int]]:
    """Where ranges of pages begin: quantiles of a sample, so a busy host has several ranges."""
    sample = sample_of(pages.select("key", "salt"), parts * SAMPLES)
    keys = sorted((row.key, row.salt) for row in sample.collect())
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def _dealt(bounds: list[tuple[str, int]]):
    def deal(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A page to its range, a rule to all ranges from its interval's first to its last."""
        for batch in rows:
            parts, which = [], []
            keys, kinds = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            salts = batch.column(3).to_pylist()
            for at, (key, kind, salt) in enumerate(zip(keys, kinds, salts, strict=True)):
                if kind:
                    found = [bisect.bisect_right(bounds, (key, salt))]
                else:
                    after = (key[:-1] + "/", -(1 << 63))  # "/" is the character after "."
                    low = bisect.bisect_right(bounds, (key, -(1 << 63)))
                    found = range(low, bisect.bisect_right(bounds, after) + 1)
                parts.extend(found)
                which.extend([at] * len(found))
            taken = batch.take(pa.array(which, pa.int64()))
            columns = [pa.array(parts, pa.int32()), *taken.columns[1:]]
            yield pa.record_batch(columns, batch.schema.names)

    return deal


class _Open:
    """The rules of one host: verdicts by path, and the lengths of the paths."""

    def __init__(self, key: str):
        self.key = key
        self.verdicts: dict[str, tuple[str, str]] = {}
        self.lengths: list[int] = []

    def add(self, host: str, path: str, verdict: str) -> None:
        known = self.verdicts.get(path)
        if known is None or known[1] != "block":
            self.verdicts[path] = (host + path, verdict)
        self.lengths = sorted({*self.lengths, len(path)}, reverse=True)

    def longest(self, path: str) -> tuple[str, str] | None:
        for length in self.lengths:
            found = self.verdicts.get(path[:length]) if length <= len(path) else None
            if found:
                return found
        return None


def _sweep(default: str):
    def sweep(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Open] = []
        part = None
        for batch in rows:
            found: list[tuple] = []
            for now, key, kind, _, page_id, host, path, verdict in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if now != part:
                    stack, part = [], now
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if not kind:
                    if not stack or stack[-1].key != key:
                        stack.append(_Open(key))
                    stack[-1].add(host, path, verdict)
                    continue
                best = None
                for rules in reversed(stack):
                    other = rules.longest(path)
                    if other and (best is None or len(other[0]) > len(best[0])):
                        best = other
                found.append((page_id, host, path, *(best or (None, default))))
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = (pa.int64(), *[pa.string()] * 4)
            yield pa.record_batch(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return sweep


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    ``rules`` has ``host``, ``path`` (null: empty) and ``verdict``. A rule fits its host and the
    host's subdomains where the url's path starts with the rule's path; of several, the one whose
    host and path are longest together wins, then the longer host. ``rule`` is that host and path,
    null where no rule fits and ``default`` is the verdict.

    A null url or one without ``://`` has an empty host and path and meets no rule. Rules without
    host or verdict are ignored; of rules with the same host and path, ``block`` wins. Repeated rows
    and rows without id are judged each; other columns are ignored.
    """
    url = F.col(f"`{url_column}`").cast("string")
    named = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.coalesce(host_of(url), F.lit("")).alias("host"),
        F.coalesce(path_of(url), F.lit("")).alias("path"),
    )
    named = named.select(
        F.lit(0).alias("part"), host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"),
        F.xxhash64("page_id", "path").alias("salt"), "page_id", "host", "path",
        F.lit(None).cast("string").alias("verdict"),
    )
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    wanted = rules.where("host != '' AND verdict IS NOT NULL").select(
        F.lit(0).alias("part"), host_key(host).alias("key"), F.lit(0).alias("kind"),
        F.lit(0).cast("long").alias("salt"), F.lit(None).cast("long").alias("page_id"),
        host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict",
    )
    named = materialize(named, "urls")
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = named.union(wanted).mapInArrow(_dealt(_bounds(named, parts)), _ROW)
    ordered = dealt.repartition(parts, "part").sortWithinPartitions(
        "part", "key", "kind", "path", "verdict"
    )
    return ordered.mapInArrow(
        _sweep(default), "page_id long, host string, path string, rule string, verdict string"
    )
