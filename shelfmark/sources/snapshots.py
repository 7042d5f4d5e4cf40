"""Keyed tables under one version: a manifest names the data files of all sections.

A section's rows lie in hash buckets of its key, as a base and the changes since. A version is a
manifest, a small file that is written once and lists every section's files by bucket, so that a reader sees all
sections of one version, and what is written is what has changed: a delta of changed rows, or
only the buckets that they touch. Two writers that start from the same version race for the next
number, and one of them gets a ``Conflict``. Files that no kept manifest names are removed by ``vacuum``.
"""

from __future__ import annotations

import copy
import json
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from shelfmark.sources.tables import _fs

NAME = "MANIFEST-{}.json"
BUCKETS = 64
#: Up to so many changed keys go to every task of a reader; more are joined by a shuffle.
BROADCAST_KEYS = 500_000
#: A bucket whose changes weigh this share of its base and so many bytes, or lie in so many files, is written anew.
COMPACT_SHARE, COMPACT_BYTES, COMPACT_FILES = 0.5, 4 << 20, 16
_BUCKET, _GONE, _ORDER = "__bucket", "__gone", "__commit"


class Conflict(RuntimeError):
    """Another writer has committed the version that this one meant to."""


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        fs, folder, _ = _fs(self.spark, self.root)
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(m[1]) for m in (re.fullmatch(NAME.format(r"(\d+)"), n) for n in names) if m)

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or the one named; version 0 is the empty store."""
        known = self.versions()
        number = (known[-1] if known else 0) if version is None else version
        if not number:
            return Snapshot(self, 0, {"sections": {}, "applied": {}})
        text = self.spark.read.text(f"{self.root}/{NAME.format(f'{number:012d}')}", wholetext=True).first()[0]
        return Snapshot(self, number, json.loads(text))

    def begin(self) -> Change:
        return Change(self.snapshot())

    def vacuum(self, keep: int = 2, min_age_seconds: float = 86_400) -> int:
        """Remove all but the newest ``keep`` manifests, and data files that none of those names; returns the number of files.

        Files younger than ``min_age_seconds`` stay, as a writer may be about to name them.
        """
        versions = self.versions()
        used = {p for v in versions[-keep:] for s in self.snapshot(v).state["sections"].values() for files in s["files"].values() for p, *_ in files}
        fs, root, path = _fs(self.spark, self.root)
        for v in versions[:-keep]:
            fs.delete(path(f"{self.root}/{NAME.format(f'{v:012d}')}"), False)
        removed, oldest = 0, (time.time() - min_age_seconds) * 1000
        for name, _, when in self._files("data"):
            if name not in used and when <= oldest:
                removed += bool(fs.delete(path(f"{self.root}/{name}"), False))
        return removed

    def _files(self, below: str) -> list[tuple[str, int, int]]:
        """(path below the root, bytes, time) of the data files below a folder."""
        fs, folder, _ = _fs(self.spark, f"{self.root}/{below}")
        if not fs.exists(folder):
            return []
        out, each, start = [], fs.listFiles(folder, True), len(fs.makeQualified(_fs(self.spark, self.root)[1]).toString()) + 1
        while each.hasNext():
            f = each.next()
            if f.getPath().getName().startswith("part-"):
                out.append((f.getPath().toString()[start:], f.getLen(), f.getModificationTime()))
        return out


class Snapshot:
    """One version, as readers see it."""

    def __init__(self, store: SnapshotStore, number: int, state: dict):
        self.store, self.number, self.state = store, number, state

    @property
    def sections(self) -> list[str]:
        return list(self.state["sections"])

    def applied(self, stream: str) -> int:
        """The last batch of a stream that this version holds, -1 if none."""
        return self.state["applied"].get(stream, -1)

    def schema(self, section: str) -> StructType:
        return StructType.fromJson(self.state["sections"][section]["schema"])

    def files(self, section: str) -> dict[int, list[str]]:
        return {int(b): [f[0] for f in files] for b, files in self.state["sections"][section]["files"].items()}

    def _bucket(self, section: str):
        s = self.state["sections"][section]
        return F.pmod(F.xxhash64(F.col(f"`{s['key']}`").cast("string")), F.lit(s["buckets"])).cast("int")

    def _load(self, section: str, delta: bool, buckets: set[int] | None) -> DataFrame:
        chosen = [f[0] for b, files in self.state["sections"][section]["files"].items() if buckets is None or int(b) in buckets for f in files if bool(f[2]) == delta]
        schema = self.schema(section)
        if delta:
            schema = schema.add(StructField(_GONE, BooleanType()))
        root = self.store.root
        if not chosen:
            return self.store.spark.createDataFrame([], schema.add(_ORDER, "long").add(_BUCKET, "integer"))
        return self.store.spark.read.schema(schema).option("basePath", f"{root}/data/{section}").parquet(*[f"{root}/{f}" for f in chosen])

    def read(self, section: str, schema: StructType | str | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The section's current rows, one for each key; those of ``buckets`` alone if told.

        The base is read where it lies: the changed keys go to it by broadcast, if they are few, and it is
        shuffled only if they are not. A section that does not exist has no rows of ``schema``.
        """
        s = self.state["sections"].get(section)
        if s is None:
            return self.store.spark.createDataFrame([], schema)
        columns = [f"`{c}`" for c in self.schema(section).names]
        base = self._load(section, False, buckets).select(*columns)
        n = sum(f[3] for b, files in s["files"].items() if buckets is None or int(b) in buckets for f in files if f[2])
        if not n:
            return base
        key = f"`{s['key']}`"
        changes = self._load(section, True, buckets)
        last = changes.groupBy(key).agg(F.max_by(F.struct(*[f"`{c}`" for c in self.schema(section).names if c != s["key"]], _GONE), _ORDER).alias("__row"))
        rows = last.where(f"not __row.{_GONE}").select(*[F.col("__row")[c].alias(c) if c != s["key"] else F.col(key) for c in self.schema(section).names])
        keys = changes.select(key).distinct()
        return base.join(F.broadcast(keys) if n <= BROADCAST_KEYS else keys, s["key"], "left_anti").select(*columns).unionByName(rows)

    def buckets_of(self, section: str, keys: DataFrame) -> set[int]:
        """The buckets that rows with these keys lie in; at most as many as the section has."""
        return {r[0] for r in keys.select(self._bucket(section).alias("b")).distinct().collect()}


class Change:
    """A version in the making: sections are put, changed or rewritten, then committed together."""

    def __init__(self, base: Snapshot):
        self.base, self.store = base, base.store
        self.after = Snapshot(base.store, base.number + 1, copy.deepcopy(base.state))
        self.written = 0

    def _write(self, section: str, rows: DataFrame, delta: bool) -> dict[str, list]:
        """Write rows by bucket; {bucket: [[file, bytes, is it a delta, rows]]}."""
        s = self.after.state["sections"][section]
        # a commit's number is the order of changes; what a writer that lost the race has written is in another folder
        below = f"data/{section}/{_ORDER}={self.after.number}/__writer=w{uuid.uuid4().hex}"
        path = f"{self.store.root}/{below}"
        rows.withColumn(_BUCKET, self.after._bucket(section)).hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, f"`{s['key']}`").write.partitionBy(_BUCKET).parquet(path)
        out: dict[str, list] = {}
        found = self.store._files(below)
        counts = {r[0]: r[1] for r in self.store.spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).count().collect()} if delta and found else {}
        for name, size, _ in found:
            self.written += size
            out.setdefault(re.search(rf"{_BUCKET}=(\d+)", name)[1], []).append([name, size, int(delta), counts.get(name.rpartition("/")[2], 0)])
        return out

    def put(self, section: str, rows: DataFrame, key: str, buckets: int = BUCKETS) -> None:
        """Replace a section by rows, one for each key, none of them null."""
        self.after.state["sections"][section] = {"key": key, "buckets": buckets, "schema": json.loads(rows.schema.json()), "files": {}}
        self.after.state["sections"][section]["files"] = self._write(section, rows, False)

    def _changes(self, section: str, rows: DataFrame | None, gone: DataFrame | None) -> DataFrame:
        schema, key = self.after.schema(section), self.after.state["sections"][section]["key"]
        parts = []
        if rows is not None:
            parts.append(rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema], F.lit(False).alias(_GONE)))
        if gone is not None:
            parts.append(gone.select(*[(F.col(f"`{key}`") if f.name == key else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema], F.lit(True).alias(_GONE)))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def upsert(self, section: str, rows: DataFrame | None = None, gone: DataFrame | None = None) -> None:
        """Rows replace those of their key, keys of ``gone`` go: written as a delta of just these.

        A key is in at most one row of both. Buckets whose deltas have grown to a share of their base are written anew.
        """
        files = self._write(section, self._changes(section, rows, gone), True)
        held = self.after.state["sections"][section]["files"]
        for b, new in files.items():
            held.setdefault(b, []).extend(new)
        weigh = lambda fs, delta: sum(f[1] for f in fs if f[2] == delta)
        full = {int(b) for b, fs in held.items() if weigh(fs, 1) and (weigh(fs, 1) >= max(COMPACT_BYTES, COMPACT_SHARE * weigh(fs, 0)) or sum(f[2] for f in fs) >= COMPACT_FILES)}
        self.compact(section, full)

    def rewrite(self, section: str, rows: DataFrame | None = None, gone: DataFrame | None = None) -> set[int]:
        """The same change without a delta: the buckets that it touches are written anew, and no others; returns them."""
        key = self.after.state["sections"][section]["key"]
        changes = self._changes(section, rows, gone)
        touched = self.after.buckets_of(section, changes)
        if touched:
            old = self.after.read(section, buckets=touched).join(changes.select(f"`{key}`"), key, "left_anti")
            self._replace(section, old.unionByName(changes.where(f"not {_GONE}").drop(_GONE)), touched)
        return touched

    def compact(self, section: str, buckets: set[int]) -> None:
        """Write base and deltas of these buckets anew, as a base."""
        if buckets:
            self._replace(section, self.after.read(section, buckets=buckets), buckets)

    def _replace(self, section: str, rows: DataFrame, buckets: set[int]) -> None:
        files = self._write(section, rows, False)
        held = self.after.state["sections"][section]["files"]
        for b in map(str, buckets):
            held.pop(b, None)
        held.update(files)

    def drop(self, section: str) -> None:
        self.after.state["sections"].pop(section, None)

    def mark(self, stream: str, batch: int) -> None:
        """Note that a stream's batch is in this version, so that its repetition can be left out."""
        self.after.state["applied"][stream] = batch

    def commit(self) -> int:
        """Make this the next version, or raise ``Conflict`` if another writer already has; returns its number.

        The manifest is written under another name and takes its place by a rename that does not overwrite.
        """
        spark, root = self.store.spark, self.store.root
        jvm = spark.sparkContext._jvm
        fs, fresh, path = _fs(spark, f"{root}/_manifest-{uuid.uuid4().hex}")
        out = fs.create(fresh, False)
        out.write(bytearray(json.dumps(self.after.state).encode()))
        out.close()
        target = path(f"{root}/{NAME.format(f'{self.after.number:012d}')}")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(fresh), fs.makeQualified(target), spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:
            fs.delete(fresh, False)
            if fs.exists(target):
                raise Conflict(f"version {self.after.number} was committed by another writer") from e
            raise
        return self.after.number
