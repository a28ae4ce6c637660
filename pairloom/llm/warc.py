"""WARC archives: written from tables of pages, read back record by record.

An archive is a file of gzip members, one record each.  The reader takes a file in blocks,
inflates one member at a time, finds the end of the block by its Content-Length, and checks the
block digest and, for responses, the payload digest and length; it holds one inflated block at a
time unless payloads are asked for.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the one with the largest id is
written as a response and the others as revisits of it.  Null payloads count as empty, null
ids are smaller than all others; rows that tie for the largest id of a payload are all responses.
An empty table makes no archive.

Archives go to a folder all executors share.  Every attempt of a task writes files of its own
name; the list of files that counts is a table which holds successful attempts only, so a lost
executor leaves at most an unlisted file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.shared import shared_folder, stored
from pairloom.operators.joins import lookup_join

MIN_REVISIT = 1000
ROLL_BYTES = 256 << 20  # a file is closed after the record that passes this
READ_BYTES = 1 << 16

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


class BadRecord(ValueError):
    pass


def _fields(pairs: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs).encode()


def record_id(ident: int | None) -> str:
    return f"<urn:page:{'' if ident is None else ident}>"


def _ident(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def sha1_hex(label: str) -> str:
    return base64.b32decode(label.removeprefix("sha1:")).hex()


def encode_record(ident: int | None, uri: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member.  A revisit has the HTTP header of its payload, but not the payload."""
    http = b"HTTP/1.1 200 OK\r\n" + _fields([("Content-Type", "text/html; charset=utf-8"),
                                            ("Content-Length", str(len(payload)))]) + b"\r\n"
    block = http if revisit else http + payload
    named = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(ident)),
             ("WARC-Date", "1970-01-01T00:00:00Z"),
             ("WARC-Target-URI", " ".join(uri.split())), ("WARC-Payload-Digest", _sha1(payload)),
             ("WARC-Block-Digest", _sha1(block))]
    if revisit:
        named += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    named += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(VERSION + _fields(named) + b"\r\n" + block + END) + pack.flush()


def decode_members(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """The inflated gzip members of a file given in blocks, one after another."""
    inflate, parts = None, []
    for block in blocks:
        while block:
            inflate = inflate or zlib.decompressobj(31)
            parts.append(inflate.decompress(block))
            block = inflate.unused_data
            if inflate.eof:
                yield b"".join(parts)
                inflate, parts = None, []
    if inflate is not None:
        raise BadRecord("the file ends inside a member")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and the payload, checked against lengths and digests."""
    head, found, rest = data.partition(END)
    if not found or not head.startswith(VERSION):
        raise BadRecord("no WARC header")
    fields = {k.lower(): v.strip() for k, _, v in
              (line.partition(":") for line in head[len(VERSION):].decode().split("\r\n"))}
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != END:
        raise BadRecord(f"{fields.get('warc-record-id')}: the block is not {length} bytes long")
    if _sha1(block) != fields["warc-block-digest"]:
        raise BadRecord(f"{fields.get('warc-record-id')}: block digest differs")
    http, _, payload = block.partition(END)
    named = (line.partition(":") for line in http.decode().split("\r\n")[1:])
    fields["http-length"] = next(v.strip() for k, _, v in named if k.lower() == "content-length")
    if fields["warc-type"] == "response" and (
            _sha1(payload) != fields["warc-payload-digest"] or len(payload) != int(fields["http-length"])):
        raise BadRecord(f"{fields.get('warc-record-id')}: payload digest or length differs")
    return fields, payload


def _file_blocks(path: str) -> Iterator[bytes]:
    system, name = pafs.FileSystem.from_uri(path)
    with system.open_input_stream(name, compression=None) as stream:
        while block := stream.read(READ_BYTES):
            yield block


def read_file(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    return map(parse_record, decode_members(_file_blocks(path)))


def _as_uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def write_archives(pages: DataFrame, ident: str, uri: str, payload: str, folder: str | None = None) -> DataFrame:
    """Write one record per row; the result lists the files: path, records, bytes."""
    rows = pages.select(F.col(f"`{ident}`").cast("bigint").alias("ident"),
                        F.coalesce(F.col(f"`{uri}`"), F.lit("")).alias("uri"),
                        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"))
    same = F.when(F.octet_length("payload") >= MIN_REVISIT, F.concat(F.sha1("payload"), F.octet_length("payload")))
    keyed = rows.withColumn("same", same)
    # One row per payload that occurs more than once.
    first = keyed.where("same IS NOT NULL").groupBy("same").agg(
        F.max("ident").alias("response"), F.count("*").alias("n")).where("n > 1").select("same", "response", "n")
    planned = lookup_join(keyed, stored(first), "same", "same", "left")
    planned = planned.select("ident", "uri", "payload", "response", (F.col("n").isNotNull() & ~F.col("ident").eqNullSafe(
        F.col("response"))).alias("revisit"))
    target = _as_uri(folder or f"{shared_folder(pages.sparkSession)}/warc")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(target)
        system.create_dir(base, recursive=True)
        stream, name, records, size = None, "", 0, 0
        for batch in parts:
            for row in zip(*batch.columns, strict=True):
                number, link, body, response, revisit = (v.as_py() for v in row)
                if stream is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream = system.open_output_stream(f"{base}/{name}", compression=None)
                data = encode_record(number, link, body, response, revisit)
                stream.write(data)
                records, size = records + 1, size + len(data)
                if size >= ROLL_BYTES:
                    stream.close()
                    stream = None
                    yield listed(name, records, size)
        if stream is not None:
            stream.close()
            yield listed(name, records, size)

    def listed(name: str, records: int, size: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": [f"{target}/{name}"], "records": [records], "bytes": [size]})

    return stored(planned.mapInArrow(write, "path string, records bigint, bytes bigint"))


RECORD = ("page_id bigint, uri string, record_type string, payload_bytes bigint, payload_digest string, "
          "refers_to bigint, payload binary")


def read_archives(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the files listed in column ``path``: one task reads a file from end to end."""
    names = [field.split()[0] for field in RECORD.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for fields, payload in read_file(path):
                    refers = fields.get("warc-refers-to")
                    rows.append((_ident(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"],
                                 int(fields["http-length"]), sha1_hex(fields["warc-payload-digest"]),
                                 _ident(refers) if refers else None, payload if with_payload else None))
                    size += len(payload) if with_payload else 100
                    if size >= 4 << 20:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    tasks = max(files.sparkSession.sparkContext.defaultParallelism, 1)
    return files.select("path").repartition(max(tasks, files.count()), "path").mapInArrow(read, RECORD)
