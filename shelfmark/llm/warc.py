"""WARC records packaged in ZIP archives, written and read back without extraction.

An archive is a ZIP file whose members are stored, not compressed: the data (one gzip
member per WARC record) and an index of it. A reader parses the central directory (ZIP64
too), finds the index, and reads just the byte ranges of the records that it wants.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, shared_dir, table, text_column

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: An archive is closed once its data has so many bytes.
ARCHIVE_BYTES = 32 << 20
#: Neighbouring records are read together up to so many bytes.
READ_BYTES = 1 << 20
#: Payloads shorter than this are always stored.
REVISIT_BYTES = 0
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PRINTABLE = "".join(map(chr, range(33, 127)))


# --- ZIP directories


class Member(NamedTuple):
    name: str
    method: int  # 0: stored
    size: int
    packed: int
    header_at: int


def _zip64(extra: bytes, fields: dict[str, int]) -> dict[str, int]:
    """Fill the fields that are all ones, in their order, from the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            return {k: next(values) if v == 0xFFFFFFFF else v for k, v in fields.items()}
        at += 4 + n
    return fields


def read_directory(f: BinaryIO) -> list[Member]:
    """The central directory of a seekable file."""
    end = f.seek(0, io.SEEK_END)
    tail_at = max(0, end - (1 << 16) - 22 - 20)
    f.seek(tail_at)
    tail = f.read(end - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    locator = at - 20
    if 0xFFFF == count or 0xFFFFFFFF in (size, start) or (locator >= 0 and tail[locator : locator + 4] == b"PK\x06\x07"):
        if locator < 0 or tail[locator : locator + 4] != b"PK\x06\x07":
            raise ValueError("broken ZIP file: no ZIP64 locator")
        f.seek(struct.unpack_from("<Q", tail, locator + 8)[0])
        record = f.read(56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("broken ZIP file: no ZIP64 directory record")
        count, size, start = struct.unpack_from("<QQQ", record, 32)
    f.seek(start)
    raw, out, p = f.read(size), [], 0
    for _ in range(count):
        if raw[p : p + 4] != b"PK\x01\x02":
            raise ValueError("broken ZIP file: bad directory entry")
        method = struct.unpack_from("<H", raw, p + 10)[0]
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, p + 20)
        header = struct.unpack_from("<I", raw, p + 42)[0]
        name = raw[p + 46 : p + 46 + n_name].decode()
        extra = raw[p + 46 + n_name : p + 46 + n_name + n_extra]
        got = _zip64(extra, {"size": full, "packed": packed, "header_at": header})
        out.append(Member(name, method, **got))
        p += 46 + n_name + n_extra + n_comment
    return out


def data_start(f: BinaryIO, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method:
        raise ValueError(f"{member.name} is compressed, so it has no byte ranges to read")
    f.seek(member.header_at)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("broken ZIP file: bad local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header_at + 30 + n_name + n_extra


# --- WARC records


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _http(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def build_record(key: str, url: str, kind: str, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One gzip member. A revisit holds the HTTP head only, whose length is that of the full payload."""
    block = _http(len(payload)) + (payload if kind == "response" else b"")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:key:{quote(key, safe='')}>"), ("WARC-Target-URI", quote(url, safe=_PRINTABLE)), ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), *([("WARC-Refers-To", f"<urn:key:{quote(refers_to, safe='')}>"), ("WARC-Profile", _REVISIT)] if refers_to is not None else []),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """(WARC fields, payload as stored, length of the full payload) of one gzip member."""
    record = zlib.decompress(raw, 31)
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    full = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return fields, payload, full


# --- archives on the shared file system


class _Writer:
    """Gathers records; one archive each time the data is large enough, and one at the end."""

    def __init__(self, folder: str):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.folder, self.data, self.index = folder, io.BytesIO(), []

    def add(self, entry: dict, record: bytes) -> None:
        self.index.append(entry | {"offset": self.data.tell(), "length": len(record)})
        self.data.write(record)

    def close(self) -> tuple[str, int, int]:
        name = f"part-{uuid.uuid4().hex}.zip"  # a task that runs again writes other files, which the manifest then names
        with self.store.open_output_stream(f"{self.root}/{name}") as sink, zipfile.ZipFile(_Sink(sink), "w", zipfile.ZIP_STORED) as z:
            for member, content in ((DATA, self.data.getvalue()), (INDEX, "".join(json.dumps(e) + "\n" for e in self.index).encode())):
                with z.open(zipfile.ZipInfo(member), "w", force_zip64=True) as out:
                    out.write(content)
        done = (f"{self.folder}/{name}", len(self.index), self.data.tell())
        self.data, self.index = io.BytesIO(), []
        return done


class _Sink(io.RawIOBase):
    """A file that can only be written onward, for ``zipfile``."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, b) -> int:
        self.out.write(bytes(b))
        return len(b)


def write_archives(pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write all rows as WARC records; returns the manifest (path, records, bytes).

    Of the rows with equal payloads of at least ``min_bytes``, those with the smallest key are
    responses and the others revisits of it; repeated rows of that key are all responses. A null
    payload is empty; a null URL is the empty string; a null key never is the smallest, and
    rows that only have null keys are responses. Very long payloads are one record; members are stored as ZIP64
    where they need it. An empty table writes no archive. Columns of other names do not matter.
    """
    body = F.coalesce(text_column(pages, payload), F.lit(""))
    rows = pages.select(pages[f"`{key}`"].alias("key"), F.coalesce(text_column(pages, url), F.lit("")).alias("url"), F.encode(body, "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    shared = rows.where(F.length("payload") >= min_bytes).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    shared = checkpoint(shared.where("n > 1").drop("n"))  # most payloads occur once and need no partner
    copies = rows.select("key", "digest").join(shared, "digest").where("key is null or key <> first").select(F.col("key").alias("copy"), F.col("digest").alias("copied"), "first").distinct()
    full = rows.join(copies, (F.col("digest") == F.col("copied")) & F.col("key").eqNullSafe(F.col("copy")), "left")
    full = full.select(F.col("key").cast("string").alias("key"), "url", "payload", F.col("first").cast("string").alias("first"))

    def run(batches):
        out = _Writer(folder)
        done = []
        for batch in batches:
            for k, u, p, first in zip(*(batch.column(c) for c in ("key", "url", "payload", "first")), strict=True):
                k, first, kind = k.as_py(), first.as_py(), "response" if first.as_py() is None else "revisit"
                out.add({"key": k, "url": u.as_py(), "type": kind}, build_record(k or "", u.as_py(), kind, p.as_py(), first, date))
                if out.data.tell() >= archive_bytes:
                    done.append(out.close())
        if out.index:
            done.append(out.close())
        paths, counts, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "records", "bytes"])

    return table(full.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def read_index(f: BinaryIO) -> tuple[int, list[dict]]:
    """(where the data begins, the index entries) of an open archive."""
    members = {m.name: m for m in read_directory(f)}
    at = data_start(f, members[INDEX])
    f.seek(at)
    entries = [json.loads(x) for x in f.read(members[INDEX].size).splitlines()]
    return data_start(f, members[DATA]), entries


def read_records(f: BinaryIO, wanted=None) -> Iterator[tuple[dict, dict[str, str], bytes, int]]:
    """(entry, fields, payload, full length) of the entries that ``wanted`` accepts, by range reads."""
    base, entries = read_index(f)
    entries = [e for e in entries if wanted is None or wanted(e)]
    i = 0
    while i < len(entries):
        j, end = i + 1, entries[i]["offset"] + entries[i]["length"]
        while j < len(entries) and entries[j]["offset"] == end and end - entries[i]["offset"] < READ_BYTES:
            end += entries[j]["length"]
            j += 1
        f.seek(base + entries[i]["offset"])
        raw, start = f.read(end - entries[i]["offset"]), entries[i]["offset"]
        for e in entries[i:j]:
            yield e, *parse_record(raw[e["offset"] - start : e["offset"] - start + e["length"]])
        i = j


def read_archives(manifest: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives in ``path``: key, url, record_type, payload_digest, payload_bytes, refers_to.

    Stored payloads are digested anew; a difference is an error. A revisit has the digest and
    length of its full payload and no payload.
    """
    names = ["key", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"][: 7 if with_payload else 6]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(name) as f:
                    for e, fields, payload, full in read_records(f):
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if fields["WARC-Type"] == "response" and (len(payload) != full or base32_sha1(payload) != digest):
                            raise ValueError(f"the payload of {fields['WARC-Record-ID']} in {path} differs from its digest")
                        rows.append((e["key"], e["url"], fields["WARC-Type"], digest, full, _key_of(fields.get("WARC-Refers-To")), payload if fields["WARC-Type"] == "response" else None)[: len(names)])
                        held += len(payload) * with_payload + 200
                        if held > 4 << 20:
                            yield _batch(rows, names, types)
                            rows, held = [], 0
                yield _batch(rows, names, types)

    kinds = ["string"] * 4 + ["long", "string", "binary"]
    return manifest.select("path").repartition(max(1, manifest.count()), "path").mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=False)))


def _key_of(urn: str | None) -> str | None:
    return None if urn is None else unquote(urn.removeprefix("<urn:key:").removesuffix(">"))


def _batch(rows: list, names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(range(len(names)), types, strict=False)], names)


def archive_folder(pages: DataFrame) -> str:
    """A new folder for archives in the session's shared folder."""
    root = shared_dir(pages.sparkSession)
    folder = f"{root}/warc-{uuid.uuid4().hex}"
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)
    return folder
