"""Whole objects from an OData service: ordered pages read by tasks, one per window, in sizes that the service bears."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime
from decimal import Decimal
from typing import Any
from urllib.error import HTTPError

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.plans.full_load import MOST_PAGES, SMALLEST_PAGE, Ask, PageSize, Read, Window
from tidemark.sources.metadata import BadAnswer, checked
from tidemark.sources.transport import PERMANENT, HttpTransport, entries
from tidemark.spec import RECORDERS, TableSpec

log = logging.getLogger(__name__)


def literal(value: Any, declared: str) -> str:
    """A value as the service's filter language writes it: four-digit years, no exponents, doubled quotes."""
    if value is None:
        return "null"
    if declared == "DateTime":
        return f"datetime'{value.year:04d}-{value:%m-%dT%H:%M:%S}'"
    if declared == "Guid":
        return f"guid'{value}'"
    if declared == "Boolean":
        return "true" if value else "false"
    if declared in ("Int64", "Int32", "Int16", "Double"):
        return format(Decimal(str(value)), "f")
    return "'" + str(value).replace("'", "''") + "'"


def window_filter(spec: TableSpec, name: str | None, window: Window) -> str:
    """The window as a filter; of a recorder's register, of entries with one record that satisfies it."""
    if name is None or (window.start is None and window.end is None and not window.undated):
        return ""
    nested = bool(spec.is_register and spec.group_key)
    at = f"r/{name}" if nested else name
    tests = [f"{at} eq null"] if window.undated else []
    tests += [f"{at} ge {literal(window.start, 'DateTime')}"] if window.start is not None else []
    tests += [f"{at} lt {literal(window.end, 'DateTime')}"] if window.end is not None else []
    told = " and ".join(tests)
    return f"RecordSet/any(r: {told})" if nested else told


def page_order(spec: TableSpec) -> list[str]:
    """A total order: what entries are paged by first, then the rest of the key; a recorder alone where entries are its sets."""
    first = spec.page_key
    if spec.is_register and spec.group_key:
        return [first, *(k for k in spec.group_key if k != first and k not in RECORDERS)]
    return [first, *(k for k in spec.pk if k != first)]


def too_heavy(e: Exception) -> bool:
    """Whether the service might bear a smaller page: it failed, took too long or answered too much. A broken connection says nothing about size."""
    if isinstance(e, HTTPError):
        return e.code >= 500 and e.code not in PERMANENT
    return isinstance(e, (TimeoutError, BadAnswer))


class TooMuch(RuntimeError):
    """A selection that the service refuses, or that goes on after so many pages."""


def pages(get: Callable[[str], bytes], published: str, order: list[str], condition: str, size: PageSize, may_refuse: bool = False, whole: bool = False) -> Iterator[list[str]]:
    """Entries page by page. A page that is too heavy is asked for again in a quarter of its size, which is never exceeded again; the next size follows the bytes per entry.

    With ``may_refuse`` a selection is ``TooMuch`` that has more than so many pages or of which not even one entry comes.
    The service makes a selection up ``whole`` if it is of record sets: then a failure is about the selection and not the page.
    """
    skip = asked = 0
    while True:
        top = size.size
        told = f"{published}?$orderby={','.join(order)}&$top={top}&$skip={skip}" + (f"&$filter={condition}" if condition else "")
        try:
            body = get(told)
            checked(body, "feed")
        except Exception as e:
            if not too_heavy(e):
                raise
            if may_refuse and (top <= SMALLEST_PAGE or whole and isinstance(e, HTTPError)):
                raise TooMuch(f"{published}: {e}") from e
            if top <= SMALLEST_PAGE:
                raise
            log.warning("a page of %d entries of %s is refused (%s), now %d", top, published, e, size.refused())
            continue
        found, asked = list(entries(body)), asked + 1
        if found:
            yield found
        skip += len(found)
        if len(found) < top:
            return
        if may_refuse and asked >= MOST_PAGES:
            raise TooMuch(f"{published}: more than {asked} pages")
        size.after(len(found), len(body))


@dataclass
class _Part(InputPartition):
    windows: list[tuple[int, str, bool]]


class ODataPages(DataSource):
    """``spark.read.format("odata_pages")``: rows (part, entry, found, complete) of windows that tasks read side by side.

    An entry's row has its window's number; after its entries, a window has one row that says how many there were and
    whether that was all. Options: url, exchange, node, user, password, timeout; object; order (JSON list); windows (JSON
    list of filter and whether it may be refused); whole; page; parallel (tasks, so requests, at a time).
    """

    @classmethod
    def name(cls) -> str:
        return "odata_pages"

    def schema(self) -> str:
        return "part int, entry string, found long, complete boolean"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[_Part]:
        told = [(k, *w) for k, w in enumerate(json.loads(self.options["windows"]))]
        n = min(len(told), int(self.options.get("parallel", "8")))
        return [_Part(told[k::n]) for k in range(n)]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        o = self.options
        get = HttpTransport(o["url"], o.get("exchange", "x"), o.get("node", ""), o.get("user", ""), o.get("password", ""), float(o.get("timeout", "600")))._open

        def batch(k: int, texts: list[str | None], found: int | None = None, complete: bool | None = None) -> pa.RecordBatch:
            n = len(texts)
            return pa.RecordBatch.from_arrays([pa.array([k] * n, pa.int32()), pa.array(texts, pa.string()), pa.array([found] * n, pa.int64()), pa.array([complete] * n, pa.bool_())], names=["part", "entry", "found", "complete"])

        size = PageSize(int(o.get("page", "1000")))
        for k, condition, may_refuse in partition.windows:
            n, complete = 0, True
            try:
                for found in pages(get, o["object"], json.loads(o["order"]), condition, size, may_refuse, o.get("whole") == "true"):
                    n += len(found)
                    yield batch(k, found)
            except TooMuch as e:
                log.info("%s: is cut", e)
                complete, size = False, PageSize(size.most)  # sizes that refusals left say nothing of a narrower selection
            yield batch(k, [None], n, complete)


_VALUE = r"<d:{}(?:\s[^>]*)?>([^<]+)</d:{}>"


@dataclass
class ODataFetched:
    reads: list[Read]
    entries: DataFrame
    make: Callable[[DataFrame], dict[str, DataFrame]]

    def rows(self) -> dict[str, DataFrame]:
        return self.make(self.entries)


@dataclass
class ODataSnapshot:
    """A snapshot source for full loads. ``rows`` makes flat rows by table of an object's raw entries.

    The service doesn't say how much it has: a window is read until it ends or turns out too deep or heavy. What tasks
    read lands in a table first, as a window's end has to be known before its entries count.
    """

    spark: SparkSession
    transport: HttpTransport
    rows: Callable[[DataFrame, TableSpec], dict[str, DataFrame]]
    page: int = 1000
    parallel: int = 8
    published: dict[str, str] = field(default_factory=dict)

    def _get(self, asked: str) -> bytes:
        return self.transport._open(asked)

    def _named(self, spec: TableSpec) -> str:
        return self.published.get(spec.name, spec.name)

    def bounds(self, spec: TableSpec, name: str) -> tuple[datetime | None, datetime | None]:
        """(oldest, newest) by one entry from either end; unknown for record sets, which the service can't order by a record's field."""
        if spec.is_register and spec.group_key:
            return None, None
        out: list[datetime | None] = []
        for way, pick in (("asc", min), ("desc", max)):
            body = self._get(f"{self._named(spec)}?$orderby={name} {way}&$top=1&$filter={name} ne null").decode("utf-8-sig")
            found = [datetime.fromisoformat(v) for v in re.findall(_VALUE.format(name, name), body)]
            out.append(pick(found) if found else None)
        return out[0], out[1]

    def read(self, spec: TableSpec, name: str | None, asks: list[Ask]) -> DataFrame:
        """What ``ODataPages`` gives for the windows."""
        self.spark.dataSource.register(ODataPages)
        t = self.transport
        options = {"url": t.url, "exchange": t.exchange, "node": t.node, "user": t.user, "password": t.password, "timeout": str(t.timeout), "object": self._named(spec), "page": str(self.page), "parallel": str(self.parallel)}
        windows = [(window_filter(spec, name, a.window), a.may_refuse) for a in asks]
        told = {"order": json.dumps(page_order(spec)), "windows": json.dumps(windows), "whole": str(bool(spec.is_register and spec.group_key)).lower()}
        return self.spark.read.format("odata_pages").options(**options, **told).load()

    def fetch(self, spec: TableSpec, name: str | None, asks: list[Ask], landing: str) -> ODataFetched:
        self.read(spec, name, asks).write.parquet(landing)
        landed = self.spark.read.parquet(landing)
        ends = {r["part"]: Read(r["found"], r["complete"]) for r in landed.where("entry IS NULL").collect()}  # one row a window
        whole = [k for k, r in ends.items() if r.complete]
        got = landed.where(F.col("part").isin(whole) & F.col("entry").isNotNull())
        if len(whole) > 1:  # an entry of several windows comes once, as the last of them has it
            key = [F.regexp_extract("entry", rf"<d:{k}(?:\s[^>]*)?>([^<]*)<", 1).alias(f"__{n}") for n, k in enumerate(page_order(spec))]
            got = got.groupBy(*key).agg(F.max_by("entry", "part").alias("entry"))
        return ODataFetched([ends[k] for k in range(len(asks))], got.select("entry"), lambda e: self.rows(e, spec))
