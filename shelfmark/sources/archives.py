"""ZIP archives as a splittable source: a partition for each run of members, read by ranges.

Small archives share a partition; a large one is planned from its directory, which lies at its end, and read by as
many tasks as its size calls for. A task holds one member and one bounded batch at a time, however
large the archive is.
"""

from __future__ import annotations

import hashlib
import io
import posixpath
import struct
import zipfile
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from shelfmark.functions.text import PARSEABLE

MEMBER_LIMIT = 50 << 20
#: Bytes of archives that one partition reads, and of members in one batch.
SPLIT_BYTES, BATCH_BYTES = 64 << 20, 8 << 20
FIRST_NAMES = 100
_BROKEN = (zipfile.BadZipFile, OSError, ValueError)
MEMBER_FIELDS = ["file_id", "bundle_id", "source_path", "original_filename", "checksum_sha256", "content", "status", "problem"]
_TYPES = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string()]
#: Members that tell best what an archive is, by the end of their lower-case names; others of these kinds serve where there are none.
TELLING, TELLING_KINDS = ("index.html", "messages.json", "archive_browser.html"), (".html", ".json")


def clean_name(name: str) -> str:
    return posixpath.normpath("/" + name.replace("\\", "/")).lstrip("/")


def member_rows(archive: zipfile.ZipFile, file_id: str, checksum: str | None, status: str | None, limit: int, infos=None) -> Iterator[tuple]:
    """Rows of an archive's readable members; one that is broken has a problem and no content, and does not stop the rest."""
    for info in archive.infolist() if infos is None else infos:
        path = clean_name(info.filename)
        if info.is_dir() or info.file_size > limit or posixpath.splitext(path)[1].lower() not in PARSEABLE:
            continue
        own = file_id + "_" + hashlib.sha256(((checksum or file_id) + path).encode()).hexdigest()
        try:
            with archive.open(info) as f:
                data = f.read(limit + 1)  # a member's header may tell less than it holds
            problem = None if len(data) <= limit else f"longer than {limit} bytes"
        except Exception as e:  # noqa: BLE001  any member can be broken in its own way
            problem = f"{type(e).__name__}: {e}"
        if problem:
            yield (own, file_id, path, posixpath.basename(path), None, None, status, problem)
        else:
            yield (own, file_id, path, posixpath.basename(path), hashlib.sha256(data).hexdigest(), data, status, None)


def broken_archive(file_id: str, status: str | None, problem: Exception) -> tuple:
    return (file_id, file_id, "", "", None, None, status, str(problem))


def in_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about BATCH_BYTES of content each."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[5] or b"") + 200
        if size >= BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], MEMBER_FIELDS)


def told_by(archive: zipfile.ZipFile, limit: int) -> tuple[int, list[str], str | None, str | None]:
    """(number of names, the first of them, the member that tells best what the archive is, its text)."""
    names = archive.namelist()
    low = [n.lower() for n in names]
    telling = next((n for n, x in zip(names, low, strict=True) if x.endswith(TELLING[:2]) or TELLING[2] in x), None) or next((n for n, x in zip(names, low, strict=True) if x.endswith(TELLING_KINDS)), None)
    text = None
    if telling is not None:
        try:
            with archive.open(telling) as f:
                text = f.read(limit).decode("utf-8", errors="ignore")
        except Exception:  # noqa: BLE001  an unreadable member tells nothing
            text = None
    return len(names), [clean_name(n) for n in islice(names, FIRST_NAMES)], telling, text


class _Run(InputPartition):
    """Whole archives, or members of one: where their part of its directory lies, and where the first member begins and the last one may end."""

    def __init__(self, paths: list[str], part: tuple[int, int, int, int] | None = None):
        self.paths, self.part = paths, part


def _entry_bytes(info: zipfile.ZipInfo) -> int:
    name = info.orig_filename.encode("utf-8" if info.flag_bits & 0x800 else "cp437")
    return zipfile.sizeCentralDir + len(name) + len(info.extra) + len(info.comment)


def _opened(f, part: tuple[int, int, int, int]) -> zipfile.ZipFile:
    """An archive that knows the members of a part of its directory only, so that no task reads the whole of it."""
    at, size, first, end = part
    f.seek(at)
    archive = zipfile.ZipFile(io.BytesIO(f.read(size) + struct.pack(zipfile.structEndArchive, zipfile.stringEndArchive, 0, 0, 0, 0, size, 0, 0)))
    infos = archive.infolist()
    shift, last = first - infos[0].header_offset, max(infos, key=lambda i: i.header_offset)
    for i in infos:
        i.header_offset += shift
        i._end_offset = end if i is last else i._end_offset + shift
    archive.fp = f
    return archive


class _Reader(DataSourceReader):
    def __init__(self, options, summary: bool):
        self.options, self.summary = options, summary
        self.split, self.limit = int(options.get("splitBytes", SPLIT_BYTES)), int(options.get("memberLimit", MEMBER_LIMIT))

    def _listed(self) -> list[tuple[str, int]]:
        fs, root = pafs.FileSystem.from_uri(self.options["path"])
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True)) if not fs.get_file_info(root).is_file else [fs.get_file_info(root)]
        return sorted((f.path, f.size) for f in found if f.is_file and f.path.lower().endswith(".zip"))

    def partitions(self) -> list[InputPartition]:
        fs, _ = pafs.FileSystem.from_uri(self.options["path"])
        out, held, size = [], [], 0
        for path, bytes_ in self._listed():
            if bytes_ > self.split and not self.summary:
                out += self._runs(fs, path)
                continue
            held.append(path)
            size += bytes_
            if size >= self.split:
                out.append(_Run(held))
                held, size = [], 0
        return [*out, _Run(held)] if held or not out else out

    def _runs(self, fs: pafs.FileSystem, path: str) -> list[_Run]:
        """Runs of members of about the split size, packed and unpacked bytes weighed alike."""
        try:
            with fs.open_input_file(path) as f, zipfile.ZipFile(f) as archive:
                infos, at = archive.infolist(), archive.start_dir
        except _BROKEN:
            return [_Run([path])]  # the task tells what is wrong
        runs, first, size, bytes_ = [], 0, 0, 0
        for k, i in enumerate(infos):
            size += i.compress_size + (i.file_size if i.file_size <= self.limit else 0)
            bytes_ += _entry_bytes(i)
            if size >= self.split or k + 1 == len(infos):
                last = max(infos[first : k + 1], key=lambda i: i.header_offset)
                runs.append(_Run([path], (at, bytes_, infos[first].header_offset, last._end_offset)))
                first, at, size, bytes_ = k + 1, at + bytes_, 0, 0
        return runs or [_Run([path])]

    def read(self, partition: _Run) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.options["path"])
        if self.summary:
            for path in partition.paths:
                yield self._summary(fs, path)
            return

        def rows() -> Iterator[tuple]:
            for path in partition.paths:
                try:
                    with fs.open_input_file(path) as f, zipfile.ZipFile(f) if partition.part is None else _opened(f, partition.part) as archive:
                        yield from member_rows(archive, path, None, None, self.limit)
                except _BROKEN as e:
                    yield broken_archive(path, None, e)

        yield from in_batches(rows())

    def _summary(self, fs: pafs.FileSystem, path: str) -> pa.RecordBatch:
        try:
            with fs.open_input_file(path) as f, zipfile.ZipFile(f) as archive:
                row = (path, *told_by(archive, self.limit), None)
        except _BROKEN as e:
            row = (path, None, None, None, None, str(e))
        types = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], ["bundle_id", "n_members", "archive_files", "telling_member", "raw_text", "problem"])


class ZipMembers(DataSource):
    """``spark.read.format("zip_members").load(folder)``: a row for each readable member of every ZIP file below it.

    Options: memberLimit (longer members are left out), splitBytes. A member's ``bundle_id`` is its archive's path.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return "file_id string, bundle_id string, source_path string, original_filename string, checksum_sha256 string, content binary, status string, problem string"

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options, summary=False)


class ZipArchives(DataSource):
    """``spark.read.format("zip_archives").load(folder)``: what each archive holds: the number of names, the first hundred, a telling text."""

    @classmethod
    def name(cls) -> str:
        return "zip_archives"

    def schema(self) -> str:
        return "bundle_id string, n_members long, archive_files array<string>, telling_member string, raw_text string, problem string"

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options, summary=True)


def register(spark: SparkSession) -> None:
    for source in (ZipMembers, ZipArchives):
        spark.dataSource.register(source)
