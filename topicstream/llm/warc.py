"""WARC archives, dictionary-compressed.

Every archive is one ``.warc.zst`` file: a leading skippable frame with a Zstandard dictionary, then one frame per record. A writer task holds
back its first records (up to ``sample_bytes``), builds the dictionary from them, writes the frame and
compresses each record on its own, so any record can be read alone. Archives roll at ``archive_bytes``.

Of records with equal payloads of at least ``least_bytes`` bytes, the one with the smallest page_id is a response and the others revisit it.
Only ids and digests are grouped; the payloads are shuffled by page, never by digest, so a frequent payload is no hot key.

Archives lie in the folder all machines share. Their names are unique to a task attempt and only those in the written
manifest count, so a lost executor leaves at most an unlisted file behind. The folder's file system must be one that pyarrow can write.

Defined results: null payloads are empty, a null url is written as ``about:blank``; a record without page_id is never referred to
unless its whole group has none, and then all of the group are responses; rows that repeat the smallest page_id of their group are all
responses. Extra columns are ignored; an empty table gives no archive and an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicstream.session import new_run_dir, staged_table

DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROL = re.compile(rb"[\x00-\x20\x7f]")


@dataclass(frozen=True)
class Settings:
    least_bytes: int = 0
    dictionary_bytes: int = 65536
    sample_bytes: int = 4_000_000
    archive_bytes: int = 1 << 30  # of compressed records
    level: int = 3
    date: str = "2024-01-01T00:00:00Z"


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> bytes:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>".encode()


def page_of(record: bytes) -> int | None:
    page = record.split(b":")[2]
    return int(page) if page else None


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, settings: Settings) -> bytes:
    digest = digest_text(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    target = CONTROL.sub(lambda m: b"%%%02X" % m[0][0], (url or "about:blank").encode())
    lines = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: " + record_id(page_id, digest),
        b"WARC-Date: " + settings.date.encode(),
        b"WARC-Target-URI: " + target,
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
    ]
    if refers_to is not None:
        lines += [b"WARC-Refers-To: " + record_id(refers_to, digest), b"WARC-Profile: " + PROFILE]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(record: bytes) -> dict:
    """Fields of one record; the payload of a revisit is null. Broken records raise."""
    head, rest = record.split(b"\r\n\r\n", 1)
    version, *lines = head.split(b"\r\n")
    fields = dict(line.split(b": ", 1) for line in lines)
    block = rest[: int(fields[b"Content-Length"])]
    if version != b"WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC/1.1 record")
    http, payload = block.split(b"\r\n\r\n", 1)
    length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
    kind = fields[b"WARC-Type"].decode()
    if kind == "response" and (len(payload) != length or digest_text(payload) != digest):
        raise ValueError(f"payload of {fields[b'WARC-Record-ID'].decode()} does not match its digest")
    return {
        "page_id": page_of(fields[b"WARC-Record-ID"]),
        "url": fields[b"WARC-Target-URI"].decode(),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page_of(fields[b"WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def build_dictionary(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; with too little to train on, the end of the samples themselves."""
    if len(samples) >= 16 and sum(map(len, samples)) >= 10 * size:
        try:
            return zstandard.train_dictionary(size, samples, k=512, d=8)
        except zstandard.ZstdError:
            pass  # samples without anything in common
    return zstandard.ZstdCompressionDict(b"".join(samples)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """One archive: the dictionary frame, then a frame per record."""

    def __init__(self, folder: str, samples: list[bytes], settings: Settings):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        files, place = pyarrow.fs.FileSystem.from_uri(self.path)
        files.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(place, compression=None)  # the name must not add a layer
        dictionary = build_dictionary(samples, settings.dictionary_bytes)
        content = dictionary.as_bytes()
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
        self.compressor = zstandard.ZstdCompressor(level=settings.level, dict_data=dictionary)
        self.records, self.bytes = 0, 0

    def write(self, record: bytes) -> None:
        frame = self.compressor.compress(record)
        self.out.write(frame)
        self.records, self.bytes = self.records + 1, self.bytes + len(frame)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.bytes


def read_frames(path: str, chunk: int = 65536) -> Iterator[bytes]:
    """The records of one archive in order, in memory of one record and one chunk."""
    files, place = pyarrow.fs.FileSystem.from_uri(path)
    with files.open_input_stream(place, compression=None) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != DICTIONARY_MAGIC:
            raise ValueError(f"{path} has no dictionary frame")
        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(source.read(size)))
        data = source.read(chunk)
        while data:
            frame, parts = decompressor.decompressobj(), []
            while True:
                parts.append(frame.decompress(data))
                if frame.eof:
                    data = frame.unused_data or source.read(chunk)
                    break
                data = source.read(chunk)
                if not data:
                    raise ValueError(f"{path} ends inside a record")
            yield b"".join(parts)


def write_archives(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``pages`` (page_id, url, html) to archives; returns their written manifest (archive, records, bytes)."""
    folder = new_run_dir(pages.sparkSession, "warc")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    keys = staged_table(rows.select("page_id", "digest", F.octet_length("html").alias("n")), "warc-digests")
    keys = keys.filter(F.col("n") >= settings.least_bytes).select("page_id", "digest")
    first = keys.groupBy("digest").agg(F.count("*").alias("c"), F.min("page_id").alias("first")).filter("c > 1 and first is not null")
    revisits = keys.join(first, "digest").filter("page_id is null or page_id > first").distinct()
    revisits = staged_table(revisits.select(F.col("page_id").alias("p"), F.col("digest").alias("d"), F.col("first").alias("refers_to")), "warc-revisits")
    rows = rows.join(revisits, rows.page_id.eqNullSafe(revisits.p) & (rows.digest == revisits.d), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, held, size = None, [], 0
        done = []

        def begin() -> ArchiveWriter:
            writer = ArchiveWriter(folder, held, settings)
            for record in held:
                writer.write(record)
            held.clear()
            return writer

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to")), strict=True):
                page_id, url, html, refers_to = (x.as_py() for x in row)
                record = encode_record(page_id, url, html.encode(), refers_to, settings)
                if archive:
                    archive.write(record)
                    if archive.bytes >= settings.archive_bytes:
                        done.append(archive.close())
                        archive, size = None, 0
                    continue
                held.append(record)
                size += len(record)
                if size >= settings.sample_bytes:
                    archive = begin()
        if held:
            archive = begin()
        if archive:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["archive", "records", "bytes"])

    manifest = rows.select("page_id", "url", "html", "refers_to").mapInArrow(run, "archive string, records long, bytes long")
    return staged_table(manifest, "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives in ``manifest``, one task per archive at most; payload digests are verified."""
    ddl = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    ddl += ", payload binary" if payloads else ""
    names = [x.split()[0] for x in ddl.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            columns = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=False)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for path in batch.column("archive").to_pylist():
                rows, size = [], 0
                for record in read_frames(path):
                    rows.append(decode_record(record))
                    size += len(record) if payloads else 200
                    if size > 4_000_000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    archives = max(1, manifest.count())
    return manifest.select("archive").repartition(archives, "archive").mapInArrow(run, ddl)
