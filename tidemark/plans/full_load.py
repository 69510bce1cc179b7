"""Full loads: how an object is read in windows and pages, and what a whole snapshot does to its table."""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import filters
from tidemark.operators.merge import mark_missing, mark_orphans
from tidemark.plans import apply
from tidemark.plans.state import Claims, InFlight, Registry
from tidemark.plans.store import LANDING, Staged, Store
from tidemark.spec import FULL_LOAD_MESSAGE, MESSAGE_NO, OWNER_KEY, TableSpec, partition_field

log = logging.getLogger(__name__)

# How a period is walked and a page is sized.
WINDOW_DAYS, NARROWEST_DAYS, NARROWING, EMPTY_TO_STOP, MOST_PAGES = 30, 1, 3, 3, 10
PAGE_TARGET_BYTES, PAGE_SHRINK, SMALLEST_PAGE = 32 << 20, 4, 1
#: Windows of the first round of a walk, and of any round.
FIRST_ROUND, MOST_AT_ONCE = 12, 96


@dataclass(frozen=True)
class Window:
    """[start, end): open where a side is None. ``undated``: the entries without a date instead."""

    start: datetime | None
    end: datetime | None
    undated: bool = False

    def condition(self, c: Column) -> Column:
        if self.undated:
            return c.isNull()
        return filters.in_window(c, self.start, self.end)


@dataclass(frozen=True)
class Ask:
    """A window to read. One that may be refused is given up once it turns out too deep or heavy, and is cut."""

    window: Window
    may_refuse: bool = False


@dataclass
class Read:
    """What reading one window came to: entries found, and whether all of it was read."""

    entries: int
    complete: bool = True


def narrower(w: Window, days: int = WINDOW_DAYS) -> list[Ask]:
    """A window of two bounds in pieces that touch: of the usual width if it is wider, else of a third of its own."""
    length = max(1, -(-(w.end - w.start) // timedelta(days=1)))
    piece = timedelta(days=days if length > days else max(NARROWEST_DAYS, length // NARROWING))
    out, at = [], w.start
    while at < w.end:
        far = min(w.end, at + piece)
        out.append(Ask(Window(at, far), far - at > timedelta(days=NARROWEST_DAYS)))
        at = far
    return out


class _Way:
    """From an edge outwards, in windows that touch: so many at once, more each time, up to the limit or three empty ones in a row.

    After those, all that is left is asked for at once. ``hard`` limits end the last window; else it goes over the limit whole.
    """

    def __init__(self, edge: datetime, step: int, limit: datetime | None, hard: bool, days: int):
        self.edge, self.step, self.limit, self.hard, self.days = edge, step, limit, hard, days
        self.many, self.empty, self.over = FIRST_ROUND, 0, limit is not None and (edge - limit) * step >= timedelta(0)

    def _window(self, far: datetime | None) -> Window:
        return Window(self.edge, far) if self.step > 0 else Window(far, self.edge)

    def ahead(self) -> list[Ask]:
        if self.over:
            return []
        if self.empty >= EMPTY_TO_STOP:
            self.rest = True
            return [Ask(self._window(self.limit if self.hard else None), True)]
        self.rest, out = False, []
        while len(out) < self.many and not self.over:
            try:
                far: datetime | None = self.edge + timedelta(days=self.days * self.step)
            except OverflowError:  # the calendar ends
                far, self.over = None, True
            if far is not None and self.limit is not None and (far - self.limit) * self.step >= timedelta(0):
                far, self.over = self.limit if self.hard else far, True
            out.append(Ask(self._window(far), self.days > NARROWEST_DAYS and far is not None))
            if far is not None:
                self.edge = far
        self.many = min(MOST_AT_ONCE, 2 * self.many)
        return out

    def told(self, reads: list[Read]) -> None:
        if getattr(self, "rest", False):
            self.over, self.empty = reads[0].complete, 0
            return
        if any(not r.complete for r in reads):
            self.days = max(NARROWEST_DAYS, self.days // NARROWING)
        for r in reads:
            self.empty = 0 if r.entries or not r.complete else self.empty + 1


def walk(read: Callable[[list[Ask]], list[Read]], anchor: datetime, oldest: datetime | None = None, start: datetime | None = None, end: datetime | None = None, undated: bool = False, days: int = WINDOW_DAYS) -> list[Window]:
    """Read everything in [start, end), open where a side is None, in rounds of windows that touch; the windows read to their end.

    The first round asks for all from the anchor on, for windows towards the past and, if told so, for what has no date;
    the next ones for more windows, until one covers ``oldest`` or ``start`` or three in a row are empty, after which all
    that is left is asked for at once. A window that was too deep or heavy is cut in the next round, an open one is walked
    the same way. ``read`` gets a round's windows, which it may read side by side, and says what each came to.
    """
    done: list[Window] = []
    hard = start is not None and (oldest is None or oldest < start)
    ways = [_Way(anchor, -1, start if hard else oldest, hard, days)]
    todo = [Ask(Window(anchor, end), True)] if end is None or anchor < end else []
    todo += [Ask(Window(None, None, undated=True))] if undated else []
    while True:
        ahead = [(w, w.ahead()) for w in ways]
        asks = [*todo, *(a for _, out in ahead for a in out)]
        if not asks:
            return done
        reads = read(asks)
        done += [a.window for a, r in zip(asks, reads) if r.complete]
        refused = [a.window for a, r in zip(asks, reads) if not r.complete]
        rest = reads[len(todo) :]
        for w, out in ahead:
            if out:
                w.told(rest[: len(out)])
            rest = rest[len(out) :]
        todo = [a for w in refused if w.start is not None and w.end is not None for a in narrower(w, days)]
        ways += [_Way(w.start, 1, None, False, days) for w in refused if w.start is not None and w.end is None and not any(x.step > 0 for x in ways)]


class PageSize:
    """Entries to ask for: as many as the target weight holds, under the caller's limit and a ceiling that refusals leave."""

    def __init__(self, most: int):
        self.most = self.ceiling = self.size = most

    def after(self, entries: int, size_bytes: int) -> int:
        if entries and size_bytes:
            fits = max(SMALLEST_PAGE, int(PAGE_TARGET_BYTES * entries / size_bytes))
            self.size = min(self.most, self.ceiling, fits)
        return self.size

    def refused(self) -> int:
        """A quarter of the refused size, and never more again."""
        self.size = self.ceiling = max(SMALLEST_PAGE, self.size // PAGE_SHRINK)
        return self.size


class Fetched(Protocol):
    """Windows that were read: what each came to, and the flat rows by table of those that were read to their end."""

    reads: list[Read]

    def rows(self) -> dict[str, DataFrame]: ...


class Snapshot(Protocol):
    """A source of whole objects, which doesn't tell how much it has.

    ``fetch`` reads windows side by side, a window that may be refused up to the source's bounds only; ``landing`` is a
    folder that it may write to. Rows of an object and its parts come by name; an entry that several windows hold comes once.
    """

    def bounds(self, spec: TableSpec, field: str) -> tuple[datetime | None, datetime | None]: ...

    def fetch(self, spec: TableSpec, field: str | None, asks: list[Ask], landing: str) -> Fetched: ...


@dataclass
class FrameFetched:
    reads: list[Read]
    frames: dict[str, DataFrame]

    def rows(self) -> dict[str, DataFrame]:
        return self.frames


@dataclass
class FrameSnapshot:
    """A snapshot source over frames: one per object and part; ``limit`` is the most entries that a window which may be refused may have."""

    frames: dict[str, DataFrame]
    parts: dict[str, tuple[str, ...]] = field(default_factory=dict)
    limit: int | None = None

    def bounds(self, spec: TableSpec, field: str) -> tuple[datetime | None, datetime | None]:
        return tuple(self.frames[spec.name].agg(F.min(field), F.max(field)).first())

    def _within(self, field: str | None, asks: list[Ask]) -> list[Column]:
        return [a.window.condition(F.col(field)) if field and a.window != Window(None, None) else F.lit(True) for a in asks]

    def counts(self, spec: TableSpec, field: str | None, asks: list[Ask]) -> DataFrame:
        """(window, count) of the windows that have entries: a row goes on with its own windows only, whatever their number."""
        unit = [F.col(c).alias(f"u{n}") for n, c in enumerate(spec.group_key or spec.pk)]
        window = F.explode(F.array(*[F.when(w, F.lit(k)) for k, w in enumerate(self._within(field, asks))]))
        return self.frames[spec.name].select(*unit, window.alias("window")).where("window IS NOT NULL").distinct().groupBy("window").count()

    def fetch(self, spec: TableSpec, field: str | None, asks: list[Ask], landing: str) -> FrameFetched:
        f, within = self.frames[spec.name], self._within(field, asks)
        found = {r["window"]: r["count"] for r in self.counts(spec, field, asks).collect()}  # one number for each window
        reads = [Read(n, not (a.may_refuse and self.limit is not None and n > self.limit)) for a, n in zip(asks, (found.get(k, 0) for k in range(len(asks))))]
        hit = f.where(reduce(lambda a, b: a | b, (w for w, r in zip(within, reads) if r.complete), F.lit(False)))
        if spec.group_key:  # whole groups of which one row is in a window
            hit = f.join(hit.select(*spec.group_key).distinct(), list(spec.group_key), "left_semi")
        out = {spec.name: hit}
        for p in self.parts.get(spec.name, ()):
            out[p] = self.frames[p].join(hit.select(OWNER_KEY).distinct(), OWNER_KEY, "left_semi")
        return FrameFetched(reads, out)


def moment(v: filters.Bound, after: bool = False) -> datetime | None:
    """A bound of a period as a moment, exclusive if ``after``: then a bare date ends with its day, a moment with its second, as sources write no less."""
    if v is None:
        return None
    at = datetime.fromisoformat(v) if isinstance(v, str) else v
    if not isinstance(at, datetime):
        return datetime(at.year, at.month, at.day) + timedelta(days=int(after))
    return at.replace(microsecond=0) + timedelta(seconds=1) if after else at


def read_all(source: Snapshot, spec: TableSpec, date_field: str | None, now: datetime, read: Callable[[list[Ask]], list[Read]], start: datetime | None = None, end: datetime | None = None) -> list[Window]:
    """Read an object, or its period, by ``read``; the windows that were read.

    It is asked for as it is first. If that is too deep or heavy and the object has a date, its windows are walked; the
    source makes up a register's record sets whole before it cuts a page, so those are walked at once. What has no date
    belongs to no period.
    """
    if date_field is None:
        return [Window(None, None)] if read([Ask(Window(None, None))]) else []
    sets = bool(spec.is_register and spec.group_key)
    if not sets and read([Ask(Window(start, end), True)])[0].complete:
        return [Window(start, end)]
    oldest, newest = (None, None) if sets else source.bounds(spec, date_field)
    anchor = min(t for t in (newest or now, end) if t is not None)
    anchor = max(t for t in (anchor, start) if t is not None)
    return walk(read, anchor, oldest, start, end, undated=not sets and start is None and end is None)


class Stopped(RuntimeError):
    """A load that was asked to end between two windows."""


class Busy(RuntimeError):
    """Another owner is loading the object."""


class Keys:
    """Keys that a load has seen, window by window, beside the tables; keys may repeat."""

    FOLDER, LANDING, OLDEST = "_keys", LANDING, 24 * 3600

    def __init__(self, store: Store, name: str, clock: Callable[[], float] = time.time):
        self.store, self.path = store, f"{self.FOLDER}/{int(clock())}-{uuid.uuid4().hex[:8]}-{name}"

    def add(self, keys: DataFrame) -> None:
        keys.write.mode("append").parquet(f"{self.store.root}/{self.path}")

    def read(self, spec: TableSpec) -> DataFrame:
        if not self.store.files.names(self.path):
            return self.store.spark.createDataFrame([], spec.schema).select(*spec.pk)
        return self.store.spark.read.parquet(f"{self.store.root}/{self.path}")

    def drop(self) -> None:
        self.store.files.delete(self.path)

    @classmethod
    def drop_orphans(cls, store: Store, now: float | None = None) -> int:
        """Forget keys of loads that died, by the age in their names; how many."""
        old = [n for n in store.files.names(cls.FOLDER) if (now or time.time()) - int(n.split("-")[0]) > cls.OLDEST]
        for n in old:
            store.files.delete(f"{cls.FOLDER}/{n}")
        return len(old)


def full_load(
    store: Store, source: Snapshot, specs: dict[str, TableSpec], name: str, date_field: str | None = None, date_from: filters.Bound = None, date_to: filters.Bound = None,
    started_at: datetime | None = None, now: datetime | None = None, always_touch: bool = False, claims: Claims | None = None,
    stop: threading.Event | None = None, buckets: int | None = None,
) -> int:
    """Load an object and its parts whole, and mark what its table has beyond that; how many rows really changed.

    An unchanged source gives 0. Table parts are loaded with their owner. The date field is the object's own unless told.
    With a period, the source is asked for that only, and only rows within it are marked, which needs the field as a
    column of the table. ``specs`` is the dictionary that the source parses by: scales of numbers may change in it. The
    object is under a claim meanwhile; what is marked is what the windows, as they were read,
    did not hold. A round whose tables another writer changes is merged again; a stop ends the load before anything is marked.
    """
    spec = specs[name]
    if spec.is_table_part:
        raise ValueError(f"{name} is a table part: load its owner")
    date_field = date_field or partition_field(spec)
    if (date_from is not None or date_to is not None) and not date_field:
        raise ValueError("a period needs its field")
    began = started_at or datetime.now()
    stamp = F.lit(now or datetime.now()).cast("timestamp_ntz")
    since = F.lit(began).cast("timestamp_ntz")
    claims = claims or Claims(store, "full load")
    registry, flights, keys = Registry(store), InFlight(store), Keys(store, name)
    period = filters.in_period(F.col(date_field), date_from, date_to) if date_from is not None or date_to is not None else None
    modified, fences = 0, []

    def merged(page: dict[str, DataFrame], rejects: list[DataFrame]) -> Staged:
        out = apply.staged_rejects(store, rejects, stamp) if rejects else Staged()
        for table, rows in page.items():
            out.add(apply.staged(store, rows, specs[table], stamp, since, always_touch, buckets, lambda _: registry.require_full_load(name)))
        return out

    def read(asks: list[Ask]) -> list[Read]:
        nonlocal modified
        if stop is not None and stop.is_set():
            raise Stopped(name)
        landing = f"{Keys.LANDING}/{uuid.uuid4().hex}"
        try:
            got = source.fetch(spec, date_field, asks, f"{store.root}/{landing}")
            log.info("full load of %s: %d windows, %d entries, %d to cut", name, len(asks), sum(r.entries for r in got.reads), sum(not r.complete for r in got.reads))
            if any(r.complete and r.entries for r in got.reads) or store.read(name) is None:
                rejects: list[DataFrame] = []
                with apply.page(store, specs, lambda: {t: rows.withColumn(MESSAGE_NO, F.lit(FULL_LOAD_MESSAGE).cast("long")) for t, rows in got.rows().items()}, rejects) as (page, _):
                    with flights.track(page, f"full load {name}"):
                        modified += apply.repeated(store, lambda: merged(page, rejects), f"full load {name}", fence=fences[0]).modified
                        keys.add(page[name].select(*spec.pk))
        finally:
            store.files.delete(landing)
        return got.reads

    with claims.hold(name) as mine:
        if not mine:
            raise Busy(f"{name} is being loaded already")
        fences.append(claims.fence(name))
        try:
            read_all(source, spec, date_field, began, read, moment(date_from), moment(date_to, after=True))
            if stop is not None and stop.is_set():
                raise Stopped(name)
            held = store.read(name)
            if held is None or period is not None and date_field not in held.columns:
                return modified  # nothing is there, or nothing says which rows the period covers
            seen = keys.read(spec)
            with flights.track([name, *spec.parts], f"marking {name}"):
                modified += apply.repeated(store, lambda: apply.marked(store, name, lambda t: mark_missing(t, seen, spec, stamp, since, period)), f"marking {name}", fence=fences[0]).modified
                for part in spec.parts:
                    modified += apply.repeated(store, lambda part=part: apply.marked(store, part, lambda t: mark_orphans(t, store.read(name), specs[part], stamp, since)), f"orphans of {name}", fence=fences[0]).modified
            return modified
        finally:
            keys.drop()


@dataclass
class Backoff:
    """Waits after failures: doubled up to a cap, at once the cap for failures that a retry cannot mend."""

    first: float
    cap: float = 1800.0
    wait: float = 0.0

    def failed(self, permanent: bool = False) -> float:
        self.wait = self.cap if permanent else min(max(self.wait, self.first) * 2, self.cap)
        return self.wait

    def succeeded(self) -> None:
        self.wait = 0.0


class FullLoads:
    """Ordered full loads in the background, a few at a time, each in a scheduler pool of its own.

    An object is queued once. A failure keeps the order and holds the object back, longer each time; one that another
    owner is loading keeps its order without that; a stop ends running loads, whose jobs it cancels, and drops queued ones.
    """

    def __init__(self, registry: Registry, load: Callable[[str, threading.Event], int], threads: int = 2, clock: Callable[[], float] = time.time):
        self.registry, self.load, self.clock = registry, load, clock
        self.pool, self.stopping, self._lock = ThreadPoolExecutor(threads, "full-load"), threading.Event(), threading.Lock()
        self.tag = f"full-loads-{uuid.uuid4().hex[:8]}"
        self.queued: dict[str, Future] = {}
        self.waits: dict[str, tuple[float, Backoff]] = {}
        self.failures: dict[str, Exception] = {}

    def dispatch(self) -> list[str]:
        """Queue what is ordered, neither queued nor held back; the names."""
        out = []
        with self._lock:
            for name in self.registry.pending():
                if not self.stopping.is_set() and name not in self.queued and self.clock() >= self.waits.get(name, (0.0, None))[0]:
                    self.queued[name] = self.pool.submit(self._run, name)
                    out.append(name)
        return out

    def _run(self, name: str) -> None:
        context = self.registry.store.spark.sparkContext
        context.setLocalProperty("spark.scheduler.pool", f"full-load-{name}")
        context.addJobTag(self.tag)
        began = self.clock()
        try:
            if self.stopping.is_set():
                return
            modified = self.load(name, self.stopping)
            self.registry.mark_full_loaded(name, modified, (self.clock() - began) / 60)
            self.waits.pop(name, None)
            self.failures.pop(name, None)
        except (Busy, Stopped) as e:
            log.info("full load of %s: %s", name, e)
        except Exception as e:  # told by name; other objects go on
            if self.stopping.is_set():  # its jobs were cancelled; it is loaded anew
                log.info("full load of %s was stopped: %s", name, type(e).__name__)
                return
            backoff = self.waits.get(name, (0.0, Backoff(60.0)))[1]
            self.waits[name] = (self.clock() + backoff.failed(), backoff)
            self.failures[name] = e
            log.warning("full load of %s failed: %s", name, e)
        finally:
            with self._lock:
                self.queued.pop(name, None)

    def wait(self) -> None:
        """Until nothing is queued."""
        while held := list(self.queued.values()):
            wait(held)

    def stop(self) -> None:
        """End what runs within seconds: also a load that waits for its source."""
        self.stopping.set()
        self.pool.shutdown(wait=False, cancel_futures=True)
        while any(not f.done() for f in list(self.queued.values())):
            self.registry.store.spark.sparkContext.cancelJobsWithTag(self.tag)  # again, as the next job may have begun
            time.sleep(0.2)
        self.pool.shutdown(wait=True)


class Cron:
    """Five fields of a crontab, in local time: minute, hour, day, month, weekday (0 and 7 are Sunday)."""

    BOUNDS = ((0, 59), (0, 23), (1, 31), (1, 12), (0, 7))

    def __init__(self, text: str):
        fields = text.split()
        if len(fields) != len(self.BOUNDS):
            raise ValueError(f"{text!r} hasn't five fields")
        self.text, self.any_day, self.any_weekday = text, fields[2] == "*", fields[4] == "*"
        self.minutes, self.hours, self.days, self.months, self.weekdays = (self._numbers(f, *b) for f, b in zip(fields, self.BOUNDS))
        if 7 in self.weekdays:
            self.weekdays |= {0}

    @staticmethod
    def _numbers(field: str, low: int, high: int) -> set[int]:
        out: set[int] = set()
        for item in field.split(","):
            span, _, step = item.partition("/")
            first, _, last = span.partition("-")
            try:
                a, b = (low, high) if span == "*" else (int(first), int(last or (high if step else first)))
                found = set(range(a, b + 1, int(step or 1)))
            except ValueError as e:
                raise ValueError(f"{field!r} is no crontab field") from e
            if not found or min(found) < low or max(found) > high:
                raise ValueError(f"{field!r} goes beyond {low}-{high}")
            out |= found
        return out

    def _on(self, day: datetime) -> bool:
        by_day, by_weekday = day.day in self.days, day.isoweekday() % 7 in self.weekdays
        hit = by_day and by_weekday if self.any_day or self.any_weekday else by_day or by_weekday
        return day.month in self.months and hit

    def after(self, moment: datetime) -> datetime:
        """The first tick later than the moment."""
        t = moment.replace(second=0, microsecond=0) + timedelta(minutes=1)
        for _ in range(366 * 8):
            if self._on(t):
                ticks = [(h, m) for h in sorted(self.hours) for m in sorted(self.minutes) if (h, m) >= (t.hour, t.minute)]
                if ticks:
                    return t.replace(hour=ticks[0][0], minute=ticks[0][1])
            t = (t + timedelta(days=1)).replace(hour=0, minute=0)
        raise ValueError(f"{self.text!r} never comes")


class FullLoadCron:
    """Full loads at times of a crontab, of the last days only where a job says so.

    A tick that was missed, as its load or another ran long, is skipped. An object that was never loaded in full is
    loaded whole at its first tick; only that run marks it as loaded.
    """

    def __init__(self, registry: Registry, load: Callable[[str, date | None], int], jobs: dict[str, tuple[str, int | None]], clock: Callable[[], datetime] = datetime.now):
        self.registry, self.load, self.clock = registry, load, clock
        self.jobs = {n: (Cron(c), days) for n, (c, days) in jobs.items()}
        self.next = {n: c.after(clock()) for n, (c, _) in self.jobs.items()}

    def run_due(self) -> dict[str, int | Exception]:
        out: dict[str, int | Exception] = {}
        for name, (cron, days) in self.jobs.items():
            if self.clock() < self.next[name]:
                continue
            whole = not self.registry.was_fully_loaded(name)
            since = None if whole or days is None else self.clock().date() - timedelta(days=days)
            began = self.clock()
            try:
                out[name] = self.load(name, since)
                if whole:
                    self.registry.mark_full_loaded(name, out[name], (self.clock() - began).total_seconds() / 60)
            except Exception as e:  # told by name; the next tick tries again
                log.warning("scheduled load of %s failed: %s", name, e)
                out[name] = e
            self.next[name] = cron.after(self.clock())
        return out
