"""The change feed as a Structured Streaming source: offsets are package numbers, a commit confirms them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from tidemark.sources.metadata import checked
from tidemark.sources.transport import FolderTransport, HttpTransport, Transport, entries


def transport_of(options: dict[str, str]) -> Transport:
    if "folder" in options:
        return FolderTransport(options["folder"])
    return HttpTransport(options["url"], options["exchange"], options["node"], options.get("user", ""), options.get("password", ""))


class ChangeFeed(DataSource):
    """``spark.readStream.format("change_feed")``: rows (message_no, entry). Options: folder, or url, exchange and node."""

    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def schema(self) -> str:
        return "message_no long, entry string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Reader(transport_of(self.options), self.options.get("confirm", "true") == "true")


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, transport: Transport, confirm: bool):
        self.transport, self.confirm = transport, confirm

    def initialOffset(self) -> dict:
        return {"message_no": self.transport.received()}

    def _package(self, number: int) -> list[tuple[int, str]] | None:
        body = self.transport.package(number)
        if body is None:
            return None
        checked(body, "feed")
        return [(number, e) for e in entries(body)]

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        number = int(start["message_no"]) + 1
        rows = self._package(number)
        return (iter(rows), {"message_no": number}) if rows else (iter(()), start)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for number in range(int(start["message_no"]) + 1, int(end["message_no"]) + 1):
            yield from self._package(number) or ()

    def commit(self, end: dict) -> None:
        """Called once the batch is written: only then the source may forget it."""
        number = int(end["message_no"])
        if self.confirm and number > self.transport.received():
            self.transport.confirm(number)
