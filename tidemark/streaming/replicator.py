"""Replication: packages are parsed, merged in order, published in one commit and then confirmed."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import shape
from tidemark.plans import apply
from tidemark.plans.full_load import Backoff
from tidemark.plans.state import CONFIRM_BUDGET, Claims, InFlight, Journal, Lease, Registry, unique
from tidemark.plans.store import Conflict, Fence, Staged, Store
from tidemark.sources import metadata, packages
from tidemark.sources.transport import PERMANENT, Transport
from tidemark.spec import TableSpec, save_order
from tidemark.streaming.feed import ChangeFeed

log = logging.getLogger(__name__)

#: A package is given back so often for an object that can't be parsed; then it is confirmed without that object.
FAILURES = 3


class PackageHeld(RuntimeError):
    """A package that isn't confirmed yet, because an object of it failed."""


@dataclass
class Cycle:
    """What became of one package; ``rows`` counts flat rows, nested ones included."""

    entries: int = 0
    rows: int = 0
    modified: int = 0
    confirmed: bool = False
    unsupported: dict[str, int] = field(default_factory=dict)
    failed: list[str] = field(default_factory=list)
    lost: list[str] = field(default_factory=list)
    unplaced: dict[str, int] = field(default_factory=dict)
    unknown_fields: dict[str, list[str]] = field(default_factory=dict)
    #: By table and field, texts that were no values; they are null in the table and rows of ``apply.REJECTED``.
    rejected: dict[str, dict[str, int]] = field(default_factory=dict)


def parts_of(spec: TableSpec, specs: dict[str, TableSpec]) -> dict[str, TableSpec]:
    """Specifications of an object's table parts, by the fields that hold them."""
    return {p.removeprefix(f"{spec.name}_"): specs[p] for p in spec.parts}


def rows_of(entry_rows: DataFrame, spec: TableSpec, specs: dict[str, TableSpec], message_no: int) -> dict[str, DataFrame]:
    """Flat rows by table with what was rejected in them, from the raw entries of one object, as ``specs`` describes it now."""
    n, spec = F.lit(message_no), specs.get(spec.name, spec)
    if spec.is_register and spec.group_key:
        return {spec.name: packages.register_rows(entry_rows, spec, n, rejects=True)}
    if spec.is_register:
        return {spec.name: packages.flat_register_rows(entry_rows, spec, n, rejects=True)}
    return packages.entity_rows(entry_rows, spec, n, parts_of(spec, specs), rejects=True)


class Replicator:
    """Takes packages one by one. A package is confirmed after its commit only, so it may come twice; merges bear that.

    An empty package is not confirmed; one of unsupported objects alone is. An object that fails, whenever in its reading
    or writing, is tried again with the package while the others are saved; after three times the package is confirmed
    without it, and that is told. Failures are counted in the store, so they outlive this object.

    A field that no specification names has the metadata read again, once per object; a field that the source still
    doesn't describe is stored as text. Objects under a full load are written with every delivered row as a change.
    """

    FAILED = "feed-failures"

    def __init__(
        self, spark: SparkSession, store: Store, transport: Transport, specs: dict[str, TableSpec], owner: str | None = None, under_full_load: Callable[[str], bool] | None = None,
        confirm: bool = True, clock: Callable[[], float] = time.monotonic, read_metadata: Callable[[], dict[str, TableSpec]] | None = None, buckets: int | None = None,
    ):
        self.spark, self.store, self.transport, self.specs = spark, store, transport, dict(specs)
        owner = owner or unique("replicator")
        self.registry, self.journal, self.lease, self.flights, self.claims = Registry(store), Journal(store), Lease(store, "feed", owner), InFlight(store), Claims(store, owner)
        self.under_full_load = under_full_load or (lambda name: self.claims.covers(name, {p: s.name for s in self.specs.values() for p in s.parts}))
        self.confirm, self.clock, self.read_metadata, self.buckets = confirm, clock, read_metadata, buckets
        self._looked_up: set[str] = set()
        self.stopping = threading.Event()

    # -- one package

    def apply(self, raw: DataFrame, message_no: int, now: datetime | None = None, fence: Fence | None = None) -> Cycle:
        """Merge the entries (column ``entry``) of one package and publish all tables at once."""
        out = Cycle()
        named, others = shape.route(raw, F.regexp_extract("entry", r'<category\b[^>]*\bterm="([^"]*)"', 1))
        named, others = named.cache(), others.cache()
        try:
            counts = {r["object"]: r["count"] for r in named.groupBy("object").count().collect()}
            out.unsupported = {r["object"] or "?": r["count"] for r in others.groupBy("object").count().collect()}
            out.entries = sum(counts.values()) + sum(out.unsupported.values())
            if out.unsupported:
                log.error("CHANGES LOST: package %d has entries of unsupported classes: %s", message_no, out.unsupported)
            stamp = F.lit(now or datetime.now()).cast("timestamp_ntz")
            with self.flights.track(counts, f"package {message_no}"):
                for attempt in range(apply.MERGES):
                    out.failed, out.rows, done, rejects = [], 0, Staged(), []
                    for name in save_order(list(counts)):
                        try:
                            done.add(self._staged(named.where(F.col("object") == name), name, message_no, stamp, out, rejects))
                        except Exception as e:  # this object alone fails
                            log.warning("%s of package %d: %s", name, message_no, e)
                            out.failed.append(name)
                    if rejects:
                        done.add(apply.staged_rejects(self.store, rejects, stamp))
                    try:
                        self.store.put(done, f"package {message_no}", fence=fence)
                        break
                    except Conflict:
                        if attempt == apply.MERGES - 1:
                            raise
            out.modified = done.modified
            for name in counts.keys() - set(out.failed):
                self.registry.require_full_load(name, only_if_new=True)
        finally:
            named.unpersist()
            others.unpersist()
        return out

    def _staged(self, rows: DataFrame, name: str, message_no: int, stamp: Column, told: Cycle, rejects: list[DataFrame]) -> Staged:
        spec = self._spec(rows, name, told)
        if spec.is_register and spec.group_key and (lost := packages.unplaced(rows, spec).count()):
            told.unplaced[name] = lost
            log.error("%s of package %d: %d emptied record sets of an unknown recorder are lost", name, message_no, lost)
        out = Staged()
        with apply.page(self.store, self.specs, lambda: rows_of(rows, spec, self.specs, message_no), rejects) as (flat, found):
            told.rejected |= found
            told.rows += sum(f.count() for f in flat.values())
            for table, f in flat.items():
                out.add(apply.staged(self.store, f, self.specs[table], stamp, always_touch=self.under_full_load(name), buckets=self.buckets, on_retired=lambda _: self.registry.require_full_load(name)))
        return out

    def _spec(self, rows: DataFrame, name: str, told: Cycle) -> TableSpec:
        """The object's specification, read anew once if it is missing or lacks a field, and then with the field as text."""
        spec = self.specs.get(name)
        fields = lambda s: sorted(r["field"] for r in packages.unknown_fields(rows, s, parts_of(s, self.specs)).collect())
        unknown = fields(spec) if spec else []
        if (spec is None or unknown) and name not in self._looked_up and self.read_metadata:
            self._looked_up.add(name)
            self.specs |= self.read_metadata()
            spec = self.specs.get(name)
            unknown = fields(spec) if spec else []
        if spec is None:
            raise KeyError(f"no metadata for {name}")
        if unknown:
            log.warning("%s: fields that no metadata names are stored as text: %s", name, unknown)
            told.unknown_fields[name] = unknown
            own = spec if not spec.parts or spec.is_register else None
            if own is not None:
                spec = self.specs[name] = replace(spec, fields=spec.fields | {f: "String" for f in unknown})
            else:  # a field of an entry with parts may be the part's: it is stored where it stands
                at_entry = [f for f in unknown if rows.where(F.regexp_replace("entry", r"(?s)<d:element>.*?</d:element>", "").rlike(rf"<d:{f}[\s/>]")).limit(1).count()]
                spec = self.specs[name] = replace(spec, fields=spec.fields | {f: "String" for f in at_entry})
                for p in spec.parts:
                    self.specs[p] = replace(self.specs[p], fields=self.specs[p].fields | {f: "String" for f in unknown if f not in at_entry})
        return spec

    def _blocked(self, cycle: Cycle) -> bool:
        """Whether failures keep the package; an object that has failed three times no longer does."""
        revision, held = self.store.document(self.FAILED)
        if not cycle.failed:
            if any(held.values()):
                self.store.replace_document(self.FAILED, revision, {})
            return False
        counted = {n: held.get(n, 0) + 1 for n in cycle.failed}
        if any(n < FAILURES for n in counted.values()):
            self.store.replace_document(self.FAILED, revision, counted)
            return True
        cycle.lost = list(cycle.failed)
        log.error("CHANGES LOST: the package is confirmed without %s", cycle.lost)
        self.store.replace_document(self.FAILED, revision, {})
        return False

    # -- the loop

    def run_once(self, now: datetime | None = None) -> Cycle:
        """One package: take the lease, land the package, save, confirm."""
        with self.lease.hold() as mine:
            if not mine:
                return Cycle()
            self.flights.deliver()
            number = self.transport.received() + 1
            body = self.transport.package(number)
            if not body:
                return Cycle()
            metadata.checked(body, "feed")
            landed = f"_inbox/msg{number}.xml"
            self.journal.note(number)
            self.store.files.write(landed, body)
            prefix = packages.feed_prefix(body[:4096].decode("utf-8", "replace"))
            del body
            try:
                cycle = self.apply(packages.entries_of_feed(self.spark, f"{self.store.root}/{landed}", prefix), number, now, self.lease.fence)
            finally:
                self.store.files.delete(landed)
            self.journal.note(number, finished_at=time.time(), entries=cycle.entries, rows=cycle.rows, modified=cycle.modified, failed=cycle.failed)
            if self.confirm and cycle.entries and not self._blocked(cycle):
                began = self.clock()
                if self.lease.heartbeat() and self.clock() - began <= CONFIRM_BUDGET:
                    self.transport.confirm(number)
                    cycle.confirmed = True
                    self.journal.note(number, confirmed_at=time.time(), lost=cycle.lost)
            return cycle

    def run_forever(self, interval: float = 60.0, max_iterations: int | None = None, sleep: Callable[[float], object] | None = None) -> list[Cycle | Exception]:
        """Cycles until stopped; failures count as iterations and lengthen the wait, which a stop ends."""
        out: list[Cycle | Exception] = []
        backoff, sleep = Backoff(interval), sleep or self.stopping.wait
        while not self.stopping.is_set() and (max_iterations is None or len(out) < max_iterations):
            wait = interval
            try:
                out.append(self.run_once())
                backoff.succeeded()
            except Exception as e:  # told in the result; the loop goes on
                log.warning("cycle failed: %s", e)
                out.append(e)
                wait = backoff.failed(getattr(e, "code", None) in PERMANENT)
            if interval > 0 and not self.stopping.is_set() and len(out) != max_iterations:
                sleep(wait)
        return out

    def stop(self) -> None:
        self.stopping.set()

    # -- as a streaming query

    def take(self, rows: DataFrame, numbers: Iterable[int]) -> list[Cycle]:
        """Merge packages of one micro-batch in the order of their numbers, under the lease; raises while one of them is held.

        As nothing after a held package is merged and the batch fails, the source neither commits nor confirms it, and a
        restart brings it again, until its failing object has failed three times.
        """
        out = []
        with self.lease.hold() as mine:
            if not mine:
                raise PackageHeld("the feed is another's")
            self.flights.deliver()
            for n in sorted(numbers):
                cycle = self.apply(rows.where(F.col("message_no") == n).select("entry"), n, fence=self.lease.fence)
                if self._blocked(cycle):
                    raise PackageHeld(f"package {n}: {cycle.failed} failed")
                out.append(cycle)
        return out

    def stream(self, checkpoint: str, options: dict[str, str], trigger: dict | None = None) -> StreamingQuery:
        """The same as a streaming query: each micro-batch's packages are merged, and confirmed once it is committed."""
        self.spark.dataSource.register(ChangeFeed)
        feed = self.spark.readStream.format("change_feed").options(**options).load()

        def batch(rows: DataFrame, _: int) -> None:
            rows = rows.cache()
            try:
                self.take(rows, [r["message_no"] for r in rows.select("message_no").distinct().collect()])
            finally:
                rows.unpersist()

        return feed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
