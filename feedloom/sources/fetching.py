"""Fetching paged feeds: budget, retries, breaker, pacing, walks that stop at a mark and resume, and a Spark source over them.

Nothing here opens a connection by itself: what fetches is handed in, so the same code reads a service or landed files.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader


class Refused(Exception):
    """A request that was not or must not be made: budget used up, circuit open, or a permanent error."""


class Passing(Exception):
    """An error that may pass; after is the least wait the other side asked for."""

    def __init__(self, text: str, after: float = 0.0) -> None:
        super().__init__(text)
        self.after = after


@dataclass
class Guard:
    """Counts every attempt against budget, waits between and after failures, and opens a circuit per label after `breaks` failures in a row."""

    budget: int
    tries: int = 3
    base: float = 2.0
    pace: float = 0.0
    breaks: int = 3
    sleep: Callable[[float], None] = lambda _: None
    clock: Callable[[], float] = lambda: 0.0
    used: int = 0
    retried: int = 0
    _failed: dict = field(default_factory=dict)
    _last: dict = field(default_factory=dict)

    def call(self, label: str, fetch: Callable[[], object]) -> object:
        """The result of fetch; raises Refused, or the last Passing error."""
        for attempt in range(1, self.tries + 1):
            if self._failed.get(label, 0) >= self.breaks:
                raise Refused(f"{label}: circuit open")
            if self.used >= self.budget:
                raise Refused("budget used up")
            if (wait := self._last.get(label, float("-inf")) + self.pace - self.clock()) > 0:
                self.sleep(wait)
            self.used += 1
            self._last[label] = self.clock()
            try:
                out = fetch()
            except Passing as error:
                self._failed[label] = self._failed.get(label, 0) + 1
                if attempt == self.tries:
                    raise
                self.retried += 1
                self.sleep(max(self.base ** (attempt - 1), error.after))
            else:
                self._failed[label] = 0
                return out
        raise AssertionError

    def open_circuits(self) -> list[str]:
        return sorted(k for k, n in self._failed.items() if n >= self.breaks)


@dataclass(frozen=True)
class Walk:
    """How a walk ended (mark, end or cap), what it read, and where to go on if it was cut off."""

    stopped_by: str
    pages: list
    cursor: object = None


def walk(fetch: Callable[[object], tuple[list, object]], dates: Callable[[list], list], mark: str | None, cap: int, cursor: object = None) -> Walk:
    """Pages from cursor on until one is wholly at or before mark (None: no mark), the feed ends, or cap pages are read.

    fetch(cursor) gives (entries, next cursor or None). A page without dated entries doesn't stop a walk.
    """
    pages = []
    while len(pages) < cap:
        entries, cursor = fetch(cursor)
        pages.append(entries)
        known = [d for d in dates(entries) if d]
        if mark is not None and known and max(known) <= mark:
            return Walk("mark", pages)
        if cursor is None:
            return Walk("end", pages)
    return Walk("cap", pages, cursor)


def resume(held: dict | None, done: Walk, mark: str | None) -> dict | None:
    """What to keep for the next run: the place a capped walk broke off and the older of the two marks; an unfinished tail stays."""
    if done.stopped_by == "cap":
        marks = [m for m in (mark, (held or {}).get("mark", mark)) if m is not None]
        return {"cursor": done.cursor, "mark": min(marks) if len(marks) == 2 or held is None and marks else None}
    return None if done.stopped_by == "end" else held


class PageReader(DataSourceReader):
    """One partition a file: the pages of a folder are parsed on the executors."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(str(p)) for p in sorted(Path(self.folder).glob("*.json"))] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is not None:
            yield from page_rows(Path(partition.value))


class PageStream(SimpleDataSourceStreamReader):
    """Files by number: the offset is the last page read, so a restart goes on after it."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"page": ""}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        names = [p for p in sorted(Path(self.folder).glob("*.json")) if p.name > start["page"]]
        rows = [r for p in names for r in page_rows(p)]
        return iter(rows), {"page": names[-1].name if names else start["page"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for p in sorted(Path(self.folder).glob("*.json")):
            if start["page"] < p.name <= end["page"]:
                yield from page_rows(p)


def page_rows(path: Path) -> Iterator[tuple]:
    """(page, source, board_id, payload) of a landed page; a file that is no envelope gives its text as payload."""
    text = path.read_text()
    try:
        page = json.loads(text)
        yield path.name, page["source"], page["board_id"], json.dumps(page["payload"])
    except (ValueError, TypeError, KeyError):
        yield path.name, None, None, text


class LandedPages(DataSource):
    """spark.read.format("landed_pages").load(folder), and readStream likewise. Register with spark.dataSource.register(LandedPages)."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "page string, source string, board_id string, payload string"

    def reader(self, schema) -> PageReader:
        return PageReader(self.options["path"])

    def simpleStreamReader(self, schema) -> PageStream:
        return PageStream(self.options["path"])
