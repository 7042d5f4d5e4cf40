"""A change feed as a streaming source: a listing first, then pages of changes, each named by the one before.

Offsets are the feed's own cursors, so that they lie in the stream's checkpoint and a restart goes
on at the page after the last one that was processed. The driver only follows cursors; pages are
read by tasks, one for each page.
"""

from __future__ import annotations

import importlib
import json
import re
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType


#: A page's end in which its cursor is looked for: a quote in a string is escaped, so these are the last field's name and value.
TAIL_BYTES = 4096
_NEXT = re.compile(rb'"next"\s*:\s*(null|"(?:[^"\\]|\\.)*")\s*\}\s*\Z')


class PagesInFolder:
    """A feed kept as files: ``<phase>-<cursor>.json`` is {"rows": [...], "next": cursor or null}.

    Rows are objects; the first page of each phase has the cursor 0. Any object with these three methods, named
    by the source's option ``client`` as ``module:name``, serves as well, over a remote interface for example.
    """

    def __init__(self, path: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(path)

    def first(self, phase: str) -> str:
        return "0"

    def _page(self, phase: str, cursor: str) -> dict | None:
        name = f"{self.folder}/{phase}-{cursor}.json"
        if self.fs.get_file_info(name).type != pafs.FileType.File:
            return None
        with self.fs.open_input_stream(name) as f:
            return json.loads(f.read())

    def following(self, phase: str, cursor: str) -> tuple[bool, str | None]:
        """(whether the page exists, the cursor after it or None if it is the phase's last).

        Where ``next`` is a page's last field, its end is all that is read.
        """
        name = f"{self.folder}/{phase}-{cursor}.json"
        info = self.fs.get_file_info(name)
        if info.type != pafs.FileType.File:
            return False, None
        with self.fs.open_input_file(name) as f:
            f.seek(max(0, info.size - TAIL_BYTES))
            end = _NEXT.search(f.read())
        return True, json.loads(end[1]) if end else self._page(phase, cursor)["next"]

    def rows(self, phase: str, cursor: str) -> Iterator[dict]:
        yield from self._page(phase, cursor)["rows"]


def _client(options):
    module, _, name = options.get("client", f"{__name__}:PagesInFolder").partition(":")
    return getattr(importlib.import_module(module), name)(options["path"])


class _Page(InputPartition):
    def __init__(self, phase: str, cursor: str, at: int):
        self.phase, self.cursor, self.at = phase, cursor, at


class _Reader(DataSourceStreamReader):
    """Offsets: {"phase", "cursor", "pages"}: the page to read next, and how many have been read.

    A batch has ``pagesPerTrigger`` pages; with ``growth``, as many more as that share of the pages that have been read, so that
    a long feed takes batches by the logarithm of its length. Each page is a task's, however many a batch has.
    """

    def __init__(self, options, schema: StructType):
        self.options, self.names = options, schema.fieldNames()
        self.pages = int(options.get("pagesPerTrigger", "1000000"))
        self.growth = float(options.get("growth", "0"))
        self.reached: dict | None = None

    def initialOffset(self) -> dict:
        return {"phase": "listing", "cursor": _client(self.options).first("listing"), "pages": 0}

    def _after(self, client, at: dict) -> dict | None:
        """The offset behind a page, or None if the page is not there yet. Behind the listing's last page come the changes."""
        there, cursor = client.following(at["phase"], at["cursor"])
        if not there or (cursor is None and at["phase"] == "changes"):
            return None
        phase = at["phase"] if cursor is not None else "changes"
        return {"phase": phase, "cursor": client.first("changes") if cursor is None else cursor, "pages": at["pages"] + 1}

    def latestOffset(self) -> dict:
        client, at = _client(self.options), self.reached or self.initialOffset()
        for _ in range(self.pages + int(self.growth * at["pages"])):
            after = self._after(client, at)
            if after is None:
                break
            at = after
        self.reached = at
        return at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        client, at, out = _client(self.options), start, []
        while at["pages"] < end["pages"]:
            out.append(_Page(at["phase"], at["cursor"], at["pages"]))
            at = self._after(client, at)
        if self.reached is None or self.reached["pages"] < end["pages"]:
            self.reached = end  # after a restart: go on from what the checkpoint has planned
        return out

    def commit(self, end: dict) -> None:
        if self.reached is None or self.reached["pages"] < end["pages"]:
            self.reached = end

    def read(self, partition: _Page) -> Iterator[tuple]:
        client = _client(self.options)
        for k, row in enumerate(client.rows(partition.phase, partition.cursor)):
            told = row | {"page": partition.at, "phase": partition.phase, "place": k}
            yield tuple(told.get(n) for n in self.names)


class ChangeFeed(DataSource):
    """``spark.readStream.format("change_feed")``; options: path, client, pagesPerTrigger, growth; a schema of the rows' fields is needed.

    Columns named ``page``, ``phase`` and ``place`` tell where in the feed a row stood, if the schema has them.
    """

    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def streamReader(self, schema: StructType) -> _Reader:
        return _Reader(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ChangeFeed)
