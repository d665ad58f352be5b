"""Landed result pages as a Python data source, read as a batch or as a stream of what is new, and written."""

from __future__ import annotations

import os
import pickle
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

SCHEMA = "entity string, page string, payload string, failure string, landed long"

#: Folder value of a NULL entity, as Spark's own writers name it.
NULL_ENTITY = "__HIVE_DEFAULT_PARTITION__"
#: A partition takes pages until they come to so many bytes, each counted with what opening a file costs.
PARTITION_BYTES, OPEN_BYTES = 32 << 20, 64 << 10


class Page(NamedTuple):
    """One landed page; ``landed`` is when its file was last written, in nanoseconds, ``folder`` the name
    of its entity's folder, ``<key>=<entity>`` with signs that paths don't take escaped."""

    landed: int
    folder: str
    name: str
    size: int

    @property
    def mark(self) -> tuple[int, str, str]:
        return self.landed, self.folder, self.name

    @property
    def entity(self) -> str | None:
        value = self.folder.split("=", 1)[1]
        return None if value == NULL_ENTITY else unquote(value)


class PagePartition(InputPartition):
    """Some landed pages. Their names are packed, as the driver holds all partitions."""

    def __init__(self, pages: list[Page]):
        super().__init__(pages[0].mark)
        self.packed = zlib.compress(pickle.dumps([tuple(p) for p in pages]), 1)

    @property
    def pages(self) -> Iterator[Page]:
        return (Page(*p) for p in pickle.loads(zlib.decompress(self.packed)))


def partitioned(pages: Iterable[Page]) -> list[PagePartition]:
    """All the pages in their order, as many to a partition as ``PARTITION_BYTES`` take, one at least."""
    parts, held, room = [], [], PARTITION_BYTES
    for page in pages:
        cost = page.size + OPEN_BYTES
        if held and cost > room:
            parts.append(PagePartition(held))
            held, room = [], PARTITION_BYTES
        held.append(page)
        room -= cost
    return [*parts, PagePartition(held)] if held else parts


def landed_pages(folder: str, key: str) -> list[Page]:
    """All pages under ``folder/<key>=<entity>/``, in the order of their landing."""
    found = []
    for entry in os.scandir(folder) if os.path.isdir(folder) else ():
        if entry.is_dir() and entry.name.startswith(f"{key}="):
            for p in os.scandir(entry.path):
                if p.is_file() and p.name[0] not in "._":
                    facts = p.stat()
                    found.append(Page(facts.st_mtime_ns, entry.name, p.name, facts.st_size))
    return sorted(found)


def read_page(folder: str, page: Page) -> tuple:
    """The page's row. One that can't be read as UTF-8 text is a row without a payload that tells why."""
    payload = failure = None
    try:
        with open(os.path.join(folder, page.folder, page.name), encoding="utf-8") as file:
            payload = file.read()
    except (OSError, UnicodeDecodeError) as error:
        failure = type(error).__name__
    return page.entity, page.name, payload, failure, page.landed


class _Batch(DataSourceReader):
    def __init__(self, folder: str, key: str):
        self.folder, self.key = folder, key

    def partitions(self) -> list[PagePartition]:
        return partitioned(landed_pages(self.folder, self.key))

    def read(self, partition: PagePartition | None) -> Iterator[tuple]:
        for page in partition.pages if partition else ():
            yield read_page(self.folder, page)


class _Stream(DataSourceStreamReader):
    """Offsets are the landing mark of the last page taken, so a restart goes on behind it."""

    def __init__(self, folder: str, key: str):
        self.folder, self.key = folder, key

    def initialOffset(self) -> dict:
        return {"landed": -1, "folder": "", "name": ""}

    def latestOffset(self) -> dict:
        landed = landed_pages(self.folder, self.key)
        return dict(zip(("landed", "folder", "name"), landed[-1].mark)) if landed else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[PagePartition]:
        after, until = _mark(start), _mark(end)
        return partitioned(p for p in landed_pages(self.folder, self.key) if after < p.mark <= until)

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        return (read_page(self.folder, page) for page in partition.pages)


def _mark(offset: dict) -> tuple[int, str, str]:
    return offset["landed"], offset["folder"], offset["name"]


class _Landing(DataSourceWriter):
    """Each row's payload becomes the file of its page, whole or not at all; a page that is written again,
    by a repeated task too, replaces the former."""

    def __init__(self, folder: str, key: str):
        self.folder, self.key = folder, key

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        mark, known = uuid.uuid4().hex, set()
        for row in rows:
            value = NULL_ENTITY if row["entity"] is None else quote(row["entity"], safe="")
            home = os.path.join(self.folder, f"{self.key}={value}")
            if home not in known:
                os.makedirs(home, exist_ok=True)
                known.add(home)
            hidden = os.path.join(home, f".{mark}")
            with open(hidden, "wb") as file:
                file.write(row["payload"])
            os.replace(hidden, os.path.join(home, row["page"]))
        return WriterCommitMessage()


class LandedPages(DataSource):
    """``spark.read.format("landed_pages").option("path", folder).option("key", "company").load()``.

    A partition takes as many pages as ``PARTITION_BYTES`` allow, so that many small pages are not
    as many tasks; a page that can't be read still fails alone, as a row with its
    ``failure``. As a stream it takes the pages that landed since the last run; a page that is
    written again lands again. Rows of ``entity``, ``page`` and ``payload`` (binary) are landed by
    ``write.format("landed_pages").mode("append")``. It lists, reads and writes with Python, so the
    folder must be mounted on all machines; ``landing.read_payloads`` reads from any store of Spark's.
    """

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def _where(self) -> tuple[str, str]:
        return self.options["path"].removeprefix("file:"), self.options["key"]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(*self._where())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(*self._where())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("pages are landed with mode append")
        return _Landing(*self._where())


def register(session: SparkSession) -> None:
    """Make ``landed_pages`` known to the session, once."""
    try:
        session.dataSource.register(LandedPages)
    except AnalysisException as error:
        if error.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise
