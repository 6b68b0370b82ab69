"""Pages as WARC archives, each record compressed by itself with the archive's own dictionary.

A task writes archives of its pages: a Zstandard dictionary is built from the first records, stored
in a leading skippable frame, and every record is a frame of its own. Payloads that occur several
times are stored once; the other records refer to that one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import NewFile, materialize, open_file, sent_if_small
from tidemark.session import work_dir

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D  # frame with a WARC dictionary
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 2 << 20  # records of an archive that its dictionary is built from
ARCHIVE_BYTES = 1 << 30  # compressed size after which a task begins another archive
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"

_ID = "urn:tidemark:page:"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_text(value: str) -> str:
    """A header value without line ends and other control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    revisit = refers_to is not None
    head = _HTTP % len(payload)
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _header_text(url or "")),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
    ]
    if revisit:
        fields += [("WARC-Refers-To", f"<{_ID}{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict:
    """A trained dictionary, or the samples' own bytes where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples)
    except zstandard.ZstdError:
        raw = b"".join(samples)[-size:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class _Archive:
    def __init__(self, folder: str, samples: list[bytes], size: int):
        dictionary = _dictionary(samples, size)
        self.frames = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        self.file = NewFile(folder, ".warc.zst")
        content = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
        self.file.write(struct.pack("<II", SKIPPABLE, len(content)) + content)
        self.records = 0
        for record in samples:
            self.add(record)

    def add(self, record: bytes) -> None:
        self.file.write(self.frames.compress(record))
        self.records += 1


def _write(folder: str, date: str, dictionary_bytes: int):
    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(archive: _Archive) -> pa.RecordBatch:
            archive.file.close()
            return pa.record_batch(
                [pa.array([archive.file.name]), pa.array([archive.records], pa.int64())],
                ["file", "records"],
            )

        archive, held, size = None, [], 0
        for batch in rows:
            for page_id, url, html, refers_to in zip(*batch.columns, strict=True):
                payload = html.as_py().encode()
                record = _record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), date)
                if archive:
                    archive.add(record)
                    if archive.file.size >= ARCHIVE_BYTES:
                        yield closed(archive)
                        archive = None
                    continue
                held.append(record)
                size += len(record)
                if size >= SAMPLE_BYTES:
                    archive, held, size = _Archive(folder, held, dictionary_bytes), [], 0
        if held:
            archive = _Archive(folder, held, dictionary_bytes)
        if archive:
            yield closed(archive)

    return write


class Archives(NamedTuple):
    """Written archives: their folder, and a stored table of ``file, records``."""

    folder: str
    files: DataFrame


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    min_bytes: int = 0,
    date: str = DATE,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> Archives:
    """Write a record per row of ``pages``; the payload is the text in UTF-8, null as empty.

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the largest id are
    responses and the others revisit it. Smaller payloads are all responses. Rows that repeat the
    largest id are all responses; rows without id revisit if another row has one. A null url is an
    empty target. Other columns are ignored; an empty table has no archives.
    """
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload_column}`").cast("string"), F.lit("")).alias("html"),
    )
    digest = F.sha1(F.col("html").cast("binary"))
    size = F.octet_length("html")
    several = rows.where(size >= min_bytes).groupBy(digest.alias("digest")).agg(
        F.max("page_id").alias("kept"), F.count("*").alias("n")
    ).where("n > 1 AND kept IS NOT NULL").select("digest", "kept")
    several = sent_if_small(materialize(several, "payloads"), 64)
    joined = rows.join(several, digest == several["digest"], "left")
    refers_to = F.when(
        F.col("kept").isNotNull() & (F.col("page_id").isNull()
                                     | (F.col("page_id") < F.col("kept"))), F.col("kept")
    )
    written = joined.select("page_id", "url", "html", refers_to.alias("refers_to")).mapInArrow(
        _write(folder, date, dictionary_bytes), "file string, records long"
    )
    return Archives(folder, materialize(written, "archives"))


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of a decompressed archive."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        stream.read(4)
        yield fields, block


def read_archive(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive, with the dictionary of its leading frame."""
    import io

    magic, size = struct.unpack("<II", file.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the archive does not begin with a dictionary")
    raw = zstandard.ZstdDecompressor().decompress(file.read(size))
    frames = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    with frames.stream_reader(file, read_across_frames=True) as stream:
        yield from _records(io.BufferedReader(stream, 1 << 20))


def _number(uri: str) -> int | None:
    text = uri.strip("<>").removeprefix(_ID)
    return int(text) if text else None


def _read(folder: str):
    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for name in batch.column(0).to_pylist():
                with open_file(folder, name) as file:
                    yield from _described(read_archive(file))

    return read


def _described(records) -> Iterator[pa.RecordBatch]:
    found = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [()] * 6
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return pa.record_batch(
            [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
            ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        )

    for fields, block in records:
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not match its digest")
        refers_to = _number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
        found.append((
            _number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], size, digest, kind,
            refers_to,
        ))
        if len(found) == 4096:
            yield batch()
            found.clear()
    yield batch()


def read_archives(archives: Archives) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` of every record.

    Responses are checked against their digests. Each archive is read by one task.
    """
    files = archives.files.select("file")
    spread = files.repartition(max(1, min(files.count(), 10_000)), "file")
    return spread.mapInArrow(
        _read(archives.folder),
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
        " refers_to long",
    )


def new_folder(df: DataFrame, name: str) -> str:
    """A fresh folder below the shared one."""
    return work_dir(df.sparkSession, name)
