"""Driver-side state beside the tables: leases, the object registry, load journal and write boundary."""

from __future__ import annotations

import logging
import os
import socket
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from tidemark.plans.store import Conflict, Fence, LostLease, Staged, Store
from tidemark.spec import SUPPORTED, TableSpec

log = logging.getLogger(__name__)

# Fixed values, in seconds.
LEASE_TTL, CLAIM_TTL, WRITE_TTL, CONFIRM_BUDGET = 900, 90, 90, 30


def unique(kind: str) -> str:
    """An owner's name that no other process, and no other object of this one, has."""
    return f"{kind}@{socket.gethostname()}:{os.getpid()}:{uuid.uuid4().hex[:8]}"


class Lease:
    """At most one live owner of a name; taken, renewed and given up by compare and set.

    Its epoch grows with every change of owner, and the new owner announces it in a commit before it does anything: from
    then on no commit under an older epoch is taken (see ``Store.put``).
    """

    def __init__(self, store: Store, name: str, owner: str, ttl: float = LEASE_TTL, clock: Callable[[], float] = time.time):
        self.store, self.name, self.owner, self.ttl, self.clock, self.epoch = store, f"lease-{name}", owner, ttl, clock, 0

    def _put(self, may: Callable[[dict], bool], content: dict) -> bool:
        revision, held = self.store.document(self.name)
        if not may(held):
            return False
        epoch = held.get("epoch", 0)
        if held.get("last") != self.owner:
            epoch = max(epoch, self.store.state_of(self.fence.key, 0)) + 1
        try:
            self.store.replace_document(self.name, revision, content | {"epoch": epoch, "last": self.owner})
        except Conflict:
            return False
        self.epoch = epoch
        return True

    def _live(self, held: dict) -> bool:
        return held.get("owner") is not None and self.clock() - held["heartbeat"] <= self.ttl

    @property
    def fence(self) -> Fence:
        return Fence(self.name, self.epoch)

    def acquire(self) -> bool:
        if not self._put(lambda h: not self._live(h) or h["owner"] == self.owner, {"owner": self.owner, "heartbeat": self.clock()}):
            return False
        if self.store.state_of(self.fence.key, 0) < self.epoch:
            try:
                self.store.put(Staged(), f"epoch of {self.name}", {self.fence.key: self.epoch}, self.fence)
            except LostLease:
                return False
        return True

    def heartbeat(self) -> bool:
        return self._put(lambda h: h.get("owner") == self.owner, {"owner": self.owner, "heartbeat": self.clock()})

    def still_mine(self) -> bool:
        held = self.store.document(self.name)[1]
        return self._live(held) and held["owner"] == self.owner

    def release(self) -> bool:
        return self._put(lambda h: h.get("owner") == self.owner, {"owner": None, "heartbeat": self.clock()})

    @contextmanager
    def hold(self) -> Iterator[bool]:
        """Whether it was got; while held, a thread renews it three times per lifetime."""
        got = self.acquire()
        over = threading.Event()

        def renew() -> None:
            while not over.wait(self.ttl / 3):
                try:
                    if not self.heartbeat():
                        return
                except Exception as e:  # the next beat may succeed; if none does, the lease runs out
                    log.warning("lease %s isn't renewed: %s", self.name, e)

        thread = threading.Thread(target=renew, name=f"{self.name} heartbeat", daemon=True)
        try:
            if got:
                thread.start()
            yield got
        finally:
            over.set()
            if got:
                thread.join()
                self.release()


class Claims:
    """Which objects are being loaded in full, by whom: one thread at a time each, and it may claim again what it has."""

    def __init__(self, store: Store, owner: str | None = None, ttl: float = CLAIM_TTL, clock: Callable[[], float] = time.time):
        self.store, self.owner, self.ttl, self.clock = store, owner or unique("full load"), ttl, clock
        self._mine = threading.local()

    def _lease(self, name: str) -> Lease:
        return Lease(self.store, f"claim-{name}", f"{self.owner}-{threading.get_ident()}", self.ttl, self.clock)

    @contextmanager
    def hold(self, name: str) -> Iterator[bool]:
        held = self._mine.__dict__.setdefault("leases", {})
        if name in held:  # this thread's outer claim holds it for longer
            yield True
            return
        lease = self._lease(name)
        with lease.hold() as got:
            if got:
                held[name] = lease
            try:
                yield got
            finally:
                held.pop(name, None)

    def fence(self, name: str) -> Fence:
        """Of a claim that this thread has."""
        return self._mine.leases[name].fence

    def still_mine(self, name: str) -> bool:
        return self._lease(name).still_mine()

    def live(self) -> set[str]:
        """Objects under a claim whose owner lives."""
        names = [n.removeprefix("lease-claim-") for n in self.store.files.names("_state") if n.startswith("lease-claim-")]
        return {n for n in names if self._lease(n)._live(self.store.document(f"lease-claim-{n}")[1])}

    def covers(self, name: str, owners: dict[str, str] | None = None) -> bool:
        """Whether the object, or the owner of the table part, is under a claim."""
        return bool({name, (owners or {}).get(name, name)} & self.live())


class InFlight:
    """Writes that were begun and not yet announced. A write that its process left behind is told to readers as a change."""

    def __init__(self, store: Store, ttl: float = WRITE_TTL, clock: Callable[[], float] = time.time):
        self.store, self.ttl, self.clock = store, ttl, clock

    def writes(self) -> dict[str, Write]:
        held = {n: self.store.document(n)[1] for n in self.store.files.names("_state") if n.startswith("write-")}
        return {n: Write(tuple(w["objects"]), w["started_at"], w["heartbeat"], w.get("source", "")) for n, w in held.items() if w.get("objects")}

    @contextmanager
    def track(self, objects: Iterable[str], source: str = "") -> Iterator[None]:
        """Registered before the write, renewed during it, and gone once it ended well; an error leaves it to ``deliver``."""
        name, begun, over = f"write-{uuid.uuid4().hex}", self.clock(), threading.Event()
        content = {"objects": sorted(objects), "started_at": begun, "source": source}
        revision = [self.store.replace_document(name, 0, content | {"heartbeat": begun})]

        def renew() -> None:
            while not over.wait(self.ttl / 3):
                revision[0] = self.store.replace_document(name, revision[0], content | {"heartbeat": self.clock()})

        thread = threading.Thread(target=renew, daemon=True)
        thread.start()
        try:
            yield
        finally:
            over.set()
            thread.join()
        self.store.files.delete(f"_state/{name}")

    def boundary(self, objects: Iterable[str]) -> float:
        return boundary(self.clock(), self.writes().values(), objects, self.ttl)

    def deliver(self) -> list[Write]:
        """Tell readers of the tables of abandoned writes as if these had changed, and forget the writes."""
        gone = []
        for name, w in self.writes().items():
            if self.clock() - w.heartbeat > self.ttl:
                self.store.put(Staged(), w.source or "abandoned write", forced=w.objects)
                self.store.files.delete(f"_state/{name}")
                gone.append(w)
        return gone


class Journal:
    """The last packages with what became of them; one without ``confirmed_at`` was not confirmed."""

    DOCUMENT, LAST = "journal", 200

    def __init__(self, store: Store):
        self.store = store

    def entries(self) -> list[dict]:
        return self.store.document(self.DOCUMENT)[1].get("packages", [])

    def note(self, message_no: int, **told) -> None:
        """Add to the package's entry, or begin one; under the feed's lease, so one writer at a time."""
        revision, held = self.store.document(self.DOCUMENT)
        packages = held.get("packages", [])
        if not packages or packages[-1]["message_no"] != message_no or "confirmed_at" in packages[-1]:
            packages = [*packages, {"message_no": message_no, "started_at": time.time()}]
        packages[-1] |= told
        self.store.replace_document(self.DOCUMENT, revision, {"packages": packages[-self.LAST :]})


class Registry:
    """Known objects with their load state. Objects that the source no longer has are marked, never deleted."""

    DOCUMENT = "registry"

    def __init__(self, store: Store):
        self.store = store

    def _change(self, change: Callable[[dict], None]) -> dict:
        for _ in range(20):
            revision, held = self.store.document(self.DOCUMENT)
            change(held)
            try:
                self.store.replace_document(self.DOCUMENT, revision, held)
            except Conflict:
                continue
            return held
        raise Conflict("the registry changes faster than it can be written")

    def objects(self) -> dict[str, dict]:
        return self.store.document(self.DOCUMENT)[1]

    def sync(self, specs: Iterable[TableSpec]) -> None:
        found = {s.name: {"fields": s.fields, "pk": list(s.pk), "group_key": list(s.group_key), "is_table_part": s.is_table_part} for s in specs}

        def change(held: dict) -> None:
            for name, told in found.items():
                held[name] = held.get(name, {"full_load_is_required": False}) | told | {"absent_from_metadata": False}
            for name in held.keys() - found.keys():
                held[name]["absent_from_metadata"] = True

        self._change(change)

    def require_full_load(self, name: str, only_if_new: bool = False) -> bool:
        ordered = []

        def change(held: dict) -> None:
            o = held.setdefault(name, {})
            ordered[:] = [not (only_if_new and o.get("last_full_load_at"))]
            if ordered[0]:
                o["full_load_is_required"] = True

        self._change(change)
        return ordered[0]

    def mark_full_loaded(self, name: str, rows_modified: int, minutes: float, now: float | None = None) -> None:
        told = {"full_load_is_required": False, "last_full_load_at": time.time() if now is None else now, "last_full_load_rows_modified": rows_modified, "last_full_load_minutes": round(minutes, 3)}
        self._change(lambda held: held.setdefault(name, {}).update(told))

    def listed(self, absent: bool = False) -> list[str]:
        """Objects of supported classes, without table parts and, unless asked for, without those the source no longer has."""
        told = self.objects().items()
        return sorted(n for n, o in told if n.startswith(tuple(f"{c}_" for c in SUPPORTED)) and not o.get("is_table_part") and (absent or not o.get("absent_from_metadata")))

    def pending(self) -> list[str]:
        return sorted(n for n, o in self.objects().items() if o.get("full_load_is_required") and not o.get("absent_from_metadata"))

    def was_fully_loaded(self, name: str) -> bool:
        return bool(self.objects().get(name, {}).get("last_full_load_at"))

    def resolve(self, name: str, known_as: dict[str, str]) -> str:
        """A source name, from itself or from its table name; neither or both of different objects is an error."""
        hits = {n for n in (name if name in self.objects() else None, known_as.get(name)) if n}
        if len(hits) != 1:
            raise ValueError(f"{name} is {'ambiguous' if hits else 'unknown'}")
        return hits.pop()


@dataclass
class Write:
    objects: tuple[str, ...]
    started_at: float
    heartbeat: float
    source: str = ""


def boundary(now: float, writes: Iterable[Write], objects: Iterable[str], ttl: float = WRITE_TTL) -> float:
    """Up to when the objects are complete: now, or the start of the oldest live write to any of them.

    Readers that pin commit numbers don't need it; it is kept for those that select by time.
    """
    wanted = set(objects)
    return min([now, *(w.started_at for w in writes if wanted & set(w.objects) and now - w.heartbeat <= ttl)])


def totals(entries: Iterable[dict]) -> dict[str, dict[str, int]]:
    """Per table, counts accumulated over journal entries; marks count as deleted."""
    out: dict[str, dict[str, int]] = {}
    for e in entries:
        t = out.setdefault(e["table"], {"inserted": 0, "updated": 0, "deleted": 0, "rows_modified": 0})
        for k in ("inserted", "updated", "deleted"):
            t[k] += e.get(k, 0)
            t["rows_modified"] += e.get(k, 0)
    return out
