"""Paged metadata harvest as a Spark data source, batch and stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import urlencode

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

#: A page: its XML and the token of the next one ("" or None after the last).
Page = tuple[str, str | None]
Fetcher = Callable[[str | None], Page]


def request(base: str, token: str | None, prefix: str = "arXivRaw") -> str:
    """The address of a page: a token stands alone, the first request says what is wanted."""
    return f"{base}?{urlencode({'verb': 'ListRecords', **({'resumptionToken': token} if token else {'metadataPrefix': prefix})})}"


def folder(path: str) -> Fetcher:
    """Pages of a local folder: page files by name; the token is the next one's name. For tests and mirrors."""

    def fetch(token: str | None) -> Page:
        names = sorted(p.name for p in Path(path).iterdir())
        if not names:
            return "", None
        at = names.index(token) if token else 0
        return (Path(path) / names[at]).read_text("utf-8"), names[at + 1] if at + 1 < len(names) else None

    return fetch


def polite(fetch: Fetcher, wait: Callable[[float], None], busy: Callable[[Exception], float | None], tries: int = 5) -> Fetcher:
    """Repeats a request that was refused for being too early: busy gives the seconds to wait, or None for another
    error. The request is repeated as it was."""

    def again(token: str | None) -> Page:
        for left in reversed(range(tries)):
            try:
                return fetch(token)
            except Exception as e:
                seconds = busy(e)
                if seconds is None or not left:
                    raise
                wait(seconds * 1.5)
        raise AssertionError

    return again


class _All(DataSourceReader):
    def __init__(self, fetch: Fetcher):
        self.fetch = fetch

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        token, page = None, 0
        while True:
            xml, token = self.fetch(token)
            if xml:
                yield page, xml, token
            if not token:
                return
            page += 1


class _Stream(SimpleDataSourceStreamReader):
    """The offset is the token of the next page, so a restart goes on where the checkpoint stands; after the last page
    nothing more comes."""

    def __init__(self, fetch: Fetcher):
        self.fetch = fetch

    def initialOffset(self) -> dict:
        return {"page": 0, "token": "", "end": False}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if start["end"]:
            return iter(()), start
        xml, token = self.fetch(start["token"] or None)
        rows = [(start["page"], xml, token)] if xml else []
        return iter(rows), {"page": start["page"] + 1, "token": token or "", "end": not token}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        while start != end:
            rows, start = self.read(start)
            yield from rows


def register(spark: SparkSession, name: str, fetch: Fetcher) -> None:
    """Makes spark.read.format(name) and spark.readStream.format(name) give pages: page, xml, next_token."""

    class Harvest(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "page INT, xml STRING, next_token STRING"

        def reader(self, schema) -> DataSourceReader:
            return _All(fetch)

        def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
            return _Stream(fetch)

    spark.dataSource.register(Harvest)
