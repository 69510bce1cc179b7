"""Marts kept up to date: subscriptions, cursors of versions, increments, and rebuilds that resume block by block."""

from __future__ import annotations

import logging
import re
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.filters import changed_since
from tidemark.operators.merge import MergeResult
from tidemark.plans.state import LEASE_TTL, Lease, unique
from tidemark.plans.store import ATTEMPTS, LANDING, Conflict, LostLease, Store

log = logging.getLogger(__name__)


@dataclass
class MartContext:
    """What a mart sees of one run: its sources at pinned versions, and the versions its last run saw."""

    spark: SparkSession
    store: Store
    name: str
    pinned: int
    cursor: dict[str, int]
    full_rebuild: bool = False
    rebuild_from: str | None = None
    since: Any = None
    lease_is_mine: Callable[[], bool] = lambda: True
    kept: list[str] = field(default_factory=list)

    def keep(self, frame: DataFrame) -> DataFrame:
        """The frame as a table beside the store's until the run's commit, where several merges need the same: its plan is cut there."""
        at = f"{LANDING}/{uuid.uuid4().hex}"
        self.kept.append(at)
        frame.write.parquet(f"{self.store.root}/{at}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.store.root}/{at}")

    def release(self) -> None:
        while self.kept:
            self.store.files.delete(self.kept.pop())

    def source(self, table: str) -> DataFrame | None:
        return self.store.read(table, self.pinned)

    def before(self, table: str) -> DataFrame | None:
        """The source as the last run saw it."""
        return self.store.read(table, self.cursor["__commit"]) if self.cursor.get("__commit") else None

    def delta(self, table: str, key: list[str]) -> DataFrame | None:
        """Rows of a source that were written since the last run, from parts that changed; all rows in a rebuild or a first run."""
        return self.store.changes(table, key, 0 if self.full_rebuild else self.cursor.get("__commit", 0), self.pinned)

    def mart(self, table: str | None = None, parts: list[str] | None = None) -> DataFrame | None:
        return self.store.read(table or self.name, parts=parts)

    def query(self, sql: str, **values: Any) -> DataFrame:
        """SQL over frames, named in braces, and values, named after a colon: ``query("select * from {t} where x > :low", t=frame, low=3)``."""
        frames = {k: v for k, v in values.items() if isinstance(v, DataFrame)}
        return self.spark.sql(sql, {k: v for k, v in values.items() if k not in frames}, **frames)

    def execute(self, sql: str, **values: Any) -> None:
        """A statement for its effect."""
        self.query(sql, **values).collect()

    def changed_since(self, *stamps: str) -> Column:
        """Whether one of a row's stamps is later than ``since``; all rows where there is none."""
        return changed_since(self.since, *[F.col(s) for s in stamps]) if self.since is not None else F.lit(True)

    def changed(self, table: str) -> bool:
        return self.store.state(self.pinned)[table].number > self.cursor.get(table, 0) if table in self.store.state(self.pinned) else False


@runtime_checkable
class Mart(Protocol):
    """``ON``: names of source tables. Methods return merges; ``rebuild`` yields (label, merges) in ascending order of labels.

    Optional: ``MIN_INTERVAL`` seconds between runs, ``ON_FULL_LOAD`` (whether full loads alone make it run), ``LAYOUTS``
    of its tables, ``setup``, and ``rebuild``.
    """

    NAME: str
    ON: list[str]

    def process_changes(self, context: MartContext) -> dict[str, MergeResult]: ...

    def rebuild(self, context: MartContext) -> Iterator[tuple[str, dict[str, MergeResult]]]: ...


def checked(mart: Any) -> Any:
    """A mart object or module, or an error that says what it lacks."""
    if isinstance(mart, type):
        raise TypeError(f"{mart.__name__} is a class: give an object of it")
    on, name = getattr(mart, "ON", None), getattr(mart, "NAME", getattr(mart, "__name__", ""))
    if not isinstance(on, (list, tuple)) or not on or not all(isinstance(x, str) and x for x in on):
        raise ValueError(f"{name or mart}: ON has to be a list of table names that isn't empty")
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
        raise ValueError(f"{name!r} is no name for a mart: ASCII letters, digits, dots, dashes and underscores")
    interval = getattr(mart, "MIN_INTERVAL", 0)
    if isinstance(interval, bool) or not isinstance(interval, (int, float)) or interval < 0:
        raise ValueError(f"{name}: MIN_INTERVAL has to be a number of seconds")
    if not callable(getattr(mart, "process_changes", None)):
        raise ValueError(f"{name} has no process_changes")
    return mart


@dataclass
class Run:
    ran: str  # "idle", "busy", "lost", "increment" or "rebuild"
    modified: int = 0
    blocks: list[str] = field(default_factory=list)


class MartRunner:
    """Runs one mart. Its cursor is the commit it has seen, so no change between two runs is missed or half seen.

    Data, cursor and a rebuild's progress are carried by one commit, which is announced only while the lease, renewed by
    a thread, is this runner's. So a run that fails or loses its lease leaves nothing behind and is repeated from the
    cursor, by whoever has the lease then. A rebuild takes increments between blocks in the same thread, and resumes
    after its last block; a new order begins it anew.
    """

    def __init__(self, store: Store, mart: Mart, owner: str | None = None, lease_ttl: float = LEASE_TTL):
        self.store, self.mart, self.name = store, checked(mart), mart.NAME
        self.lease, self._is_set_up = Lease(store, f"mart-{self.name}", owner or unique("runner"), lease_ttl), False

    @property
    def document(self) -> str:
        return f"mart-{self.name}"

    def wishes(self) -> dict:
        """What was ordered: order (how many rebuilds), disabled."""
        return self.store.document(self.document)[1]

    def _wish(self, change: Callable[[dict], dict]) -> None:
        for _ in range(ATTEMPTS):
            revision, held = self.store.document(self.document)
            try:
                self.store.replace_document(self.document, revision, held | change(held))
                return
            except Conflict:
                continue
        raise Conflict(f"the wishes for {self.name} change faster than they can be written")

    def request_rebuild(self) -> None:
        self._wish(lambda held: {"order": held.get("order", 0) + 1})

    def disable(self, yes: bool = True) -> None:
        self._wish(lambda _: {"disabled": yes})

    def progress(self) -> dict:
        """cursor, and of rebuilds: done (the last order that was met), building (the order being met), label."""
        return self.store.carried(self.document)

    def pending(self) -> bool:
        """Whether a source has moved since the cursor, or a write to one was abandoned."""
        cursor, now, told = self.progress().get("cursor", {}), self.store.state(), self.store.signals()
        moved = {t for t in self.mart.ON if t in now and now[t].number > cursor.get(t, 0)}
        at = cursor.get("__commit", 0)
        if moved and getattr(self.mart, "ON_FULL_LOAD", True) or any(told.get(t, {}).get("forced", 0) > at for t in self.mart.ON):
            return True
        return any(told.get(t, {}).get("feed", 0) > at for t in moved)

    def run_once(self, rebuild: bool = False) -> Run:
        if rebuild:
            self.request_rebuild()
        with self.lease.hold() as mine:
            if not mine:
                return Run("busy")
            wishes, done = self.wishes(), self.progress()
            if wishes.get("disabled"):
                return Run("idle")
            ordered = wishes.get("order", 0) > done.get("done", -1) or done.get("building") is not None
            try:
                return self._rebuild() if ordered and hasattr(self.mart, "rebuild") else self._increment()
            except LostLease:
                return Run("lost")

    def _context(self, **more: Any) -> MartContext:
        c = MartContext(self.store.spark, self.store, self.name, self.store.head(), self.progress().get("cursor", {}), lease_is_mine=self.lease.still_mine, **more)
        if not self._is_set_up:
            getattr(self.mart, "setup", lambda _: None)(c)
            self._is_set_up = True
        return c

    def _seen(self, pinned: int) -> dict[str, int]:
        return {"__commit": pinned} | {t: v.number for t, v in self.store.state(pinned).items() if t in self.mart.ON}

    def _publish(self, changes: dict[str, MergeResult], **progress: Any) -> int:
        counts = self.store.publish(changes, f"mart {self.name}", getattr(self.mart, "LAYOUTS", None), {self.document: self.progress() | progress}, fence=self.lease.fence)
        return sum(c["inserted"] + c["updated"] + c["deleted"] for c in counts.values())

    def _increment(self) -> Run:
        if not self.pending():
            return Run("idle")
        context = self._context()
        try:
            changes = self.mart.process_changes(context)
            return Run("increment", self._publish(changes, cursor=self._seen(context.pinned)))
        finally:
            context.release()

    def _rebuild(self) -> Run:
        order = self.wishes().get("order", 0)
        if self.progress().get("building") != order:  # increments between blocks start from here
            self._publish({}, building=order, label=None, cursor=self._seen(self.store.head()))
        out = Run("rebuild")
        context = self._context(full_rebuild=True, rebuild_from=self.progress().get("label"))
        try:
            for label, changes in self.mart.rebuild(context):
                if context.rebuild_from is not None and label <= context.rebuild_from:
                    continue
                out.modified += self._publish(changes, label=label)
                out.blocks.append(label)
                if self.wishes().get("order", 0) != order:
                    return out  # ordered anew: the next run begins from the first block
                out.modified += self._increment().modified
        finally:
            context.release()
        if not out.blocks:  # resumed behind its last block: what came while it was down is in no block
            out.modified += self._increment().modified
        # What changed since the rebuild began is looked at again: blocks were made of the sources as they were then.
        self._publish({}, building=None, label=None, done=order, cursor=self._seen(context.pinned))
        return out


def run_all(runners: list[MartRunner]) -> dict[str, Run | Exception]:
    """One pass over all marts; one that fails doesn't stop the others."""
    out: dict[str, Run | Exception] = {}
    for r in runners:
        try:
            out[r.name] = r.run_once()
        except Exception as e:  # told by name
            out[r.name] = e
    return out


class MartLoop:
    """Passes over marts until stopped. A mart runs no sooner than its MIN_INTERVAL after its last run began, and one that failed after a delay."""

    # Fixed values, in seconds.
    RETRY_DELAY, IDLE_POLL = 60.0, 1.0

    def __init__(self, runners: list[MartRunner], clock: Callable[[], float] = time.monotonic):
        self.runners, self.clock, self.stopping = runners, clock, threading.Event()
        self.next = {r.name: 0.0 for r in runners}

    def run_pass(self) -> dict[str, Run | Exception]:
        out: dict[str, Run | Exception] = {}
        for r in self.runners:
            began = self.clock()
            if self.stopping.is_set() or began < self.next[r.name]:
                continue
            out |= run_all([r])
            failed, ran = isinstance(out[r.name], Exception), getattr(out[r.name], "ran", "") in ("increment", "rebuild")
            self.next[r.name] = self.clock() + self.RETRY_DELAY if failed else began + (float(getattr(r.mart, "MIN_INTERVAL", 0.0)) if ran else 0.0)
        return out

    def run_forever(self, max_passes: int | None = None) -> None:
        n = 0
        while not self.stopping.is_set() and (max_passes is None or n < max_passes):
            told, n = self.run_pass(), n + 1
            for name, r in told.items():
                if isinstance(r, Exception):
                    log.warning("mart %s failed: %s", name, r)
            if not any(getattr(r, "ran", "") in ("increment", "rebuild") for r in told.values()):
                self.stopping.wait(self.IDLE_POLL)

    def stop(self) -> None:
        self.stopping.set()
