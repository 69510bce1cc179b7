"""Changes of stored tables sent to a table in another engine, at least once, under a version that makes repeats harmless."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merge import MergeResult
from tidemark.plans.mart_runner import MartContext
from tidemark.sources import federated
from tidemark.spec import DELETED


@dataclass
class Outbox:
    """A mart that lives elsewhere: run it by ``MartRunner``; what it sends is read there by ``federated.final``.

    A run appends the rows written since its cursor with the number of the commit that it read as their version, and
    commits its cursor after that. If it dies in between, the next run sends the same rows again, with the same version or a
    later one, so none is lost and the last version is what the store holds. An owner that was replaced
    can only send versions of a commit that it read, and later ones win. A key that a table no longer has is sent as
    deleted, other columns null; for this only parts are compared whose files differ. A rebuild sends all rows again and
    does no more: of keys that the far table alone has it knows nothing. ``shaped`` turns rows into those of the far table
    and has to keep the key.
    """

    NAME: str
    table: str
    key: list[str]
    url: str
    far_table: str
    options: dict[str, str] = field(default_factory=dict)
    shaped: Callable[[DataFrame], DataFrame] = lambda rows: rows

    def __post_init__(self):
        self.ON = [self.table]

    def _send(self, rows: DataFrame, version: int) -> None:
        rows = rows if DELETED in rows.columns else rows.withColumn(DELETED, F.lit(False))
        out = self.shaped(rows)
        if "version" in out.columns:
            raise ValueError(f"{self.table} has a column named version, which the far table has for itself")
        federated.append(out, self.url, self.far_table, F.lit(version).cast("long"), **self.options)

    def _gone(self, c: MartContext) -> DataFrame | None:
        """Keys that the last run saw and that are no longer there; None where that cannot be."""
        at = c.cursor.get("__commit", 0)
        now, was = c.store.state(c.pinned).get(self.table), c.store.state(at).get(self.table) if at else None
        if now is None or was is None or now.number == was.number:
            return None
        parts = None
        if now.partition == was.partition and now.partition:
            parts = sorted(k for k in {*now.paths, *was.paths} if now.paths.get(k) != was.paths.get(k))
        before, after = (c.store.read(self.table, n, parts).select(*self.key) for n in (at, c.pinned))
        return before.join(after.withColumnsRenamed({k: f"__{k}" for k in self.key}), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.key], "left_anti")

    def process_changes(self, c: MartContext) -> dict[str, MergeResult]:
        rows = c.delta(self.table, self.key)
        if rows is None:
            return {}
        rows = rows if DELETED in rows.columns else rows.withColumn(DELETED, F.lit(False))
        if (gone := self._gone(c)) is not None:
            rows = rows.unionByName(gone.withColumn(DELETED, F.lit(True)), allowMissingColumns=True)
        self._send(rows, c.pinned)
        return {}

    def rebuild(self, c: MartContext) -> Iterator[tuple[str, dict[str, MergeResult]]]:
        rows = c.source(self.table)
        if rows is not None and c.rebuild_from is None:
            self._send(rows, c.pinned)
            yield "all", {}
