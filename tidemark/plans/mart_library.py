"""Marts ready to use over a movement register, its documents and its catalog: by row, and by group with lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import marts
from tidemark.operators.merge import MergeResult, merge_mart
from tidemark.plans.mart_runner import MartContext
from tidemark.plans.store import LANDING, by_key


#: Tasks that write one block of a rebuild.
SPLIT = 8


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def _merged(c: MartContext, table: str, fresh: DataFrame, key: list[str], keys: DataFrame, delete: bool) -> MergeResult:
    """Bring the rows of ``keys`` up to date, reading only parts of the mart that these are in."""
    parts = c.store.touched(table, keys.unionByName(fresh.select(*keys.columns)).distinct()) if delete else c.store.touched(table, fresh)
    out = merge_mart(c.mart(table, parts), fresh, key, _now(), scope_keys=keys, delete=delete)
    out.parts = parts
    return out


def blocks(c: MartContext, view: DataFrame, label: Column, key: list[str]) -> Iterator[tuple[str, DataFrame]]:
    """(label, its rows) in order of labels, without those that a rebuild has done before.

    The view is laid out by label once, in SPLIT tasks for each, so a rebuild reads its sources once and not for every block.
    """
    landing, at = f"{LANDING}/{uuid.uuid4().hex}", F.col("__label")
    rest = view.withColumn("__label", label)
    rest = rest if c.rebuild_from is None else rest.where(at > c.rebuild_from)
    try:
        rest.repartition(at, F.pmod(F.xxhash64(*key), F.lit(SPLIT))).write.partitionBy("__label").parquet(f"{c.store.root}/{landing}")
        for name in c.store.files.names(landing):
            if name.startswith("__label="):
                yield name.removeprefix("__label="), c.spark.read.schema(view.schema).parquet(f"{c.store.root}/{landing}/{name}")
    finally:
        c.store.files.delete(landing)


def _near(c: MartContext, table: str, keys: DataFrame, number: int | None = None) -> DataFrame | None:
    """The table's parts that rows with the given keys are in; all of it where its layout needs columns that they lack."""
    v = c.store.state(number).get(table)
    by = v.partition.split(":", 1)[1].split(",") if v and (v.partition or "").startswith("#") else []
    parts = c.store.touched(table, keys, number) if by and set(by) <= set(keys.columns) else None
    return c.store.read(table, number, parts)


def _behind(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose values in the columns of ``keys`` are among them; nulls are values."""
    k = keys.select(*[F.col(x).alias(f"__{x}") for x in keys.columns]).distinct()
    return rows.join(k, reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(f"__{x}")) for x in keys.columns)), "left_semi")


@dataclass
class RowMart:
    """One row per movement with its catalog code. A row is computed anew if its movement or its catalog entry changed; rows are never removed, as movements are marked and not removed.

    An index has the movements' places by item, laid out by item, so an increment opens only parts of the register that
    changed movements, or those of changed catalog entries, are in. ``place`` are the columns that the register is laid
    out by, which are part of its key; an index entry stays when a movement gets another item, which opens a part in vain.
    """

    NAME: str
    register: str
    catalog: str
    key: list[str] = field(default_factory=lambda: ["Recorder", "LineNumber"])
    buckets: int = 64
    place: list[str] = field(default_factory=lambda: ["Recorder"])

    def __post_init__(self):
        self.index = f"{self.NAME}_index"
        self.ON = [self.register, self.catalog]
        self.LAYOUTS = {self.NAME: by_key(self.key, self.buckets), self.index: by_key(["Item"], self.buckets)}

    def view(self, rows: DataFrame, catalog: DataFrame) -> DataFrame:
        return marts.row_view(rows, catalog).drop("merged_on", "catalog_merged_on")

    def _indexed(self, c: MartContext, rows: DataFrame) -> dict[str, MergeResult]:
        places = rows.where(F.col("Item").isNotNull()).select("Item", *self.place).distinct()
        return {self.index: _merged(c, self.index, places, places.columns, places, delete=False)}

    def process_changes(self, c: MartContext) -> dict[str, MergeResult]:
        if not c.cursor or c.mart(self.index) is None:
            rows = c.source(self.register)
            return {self.NAME: _merged(c, self.NAME, self.view(rows, c.source(self.catalog)), self.key, rows.select(*self.key), delete=False)} | self._indexed(c, rows)
        moved = c.keep(c.delta(self.register, self.key).select(*dict.fromkeys([*self.key, *self.place, "Item"])))
        items = c.keep(c.delta(self.catalog, ["Ref_Key"]).select(F.col("Ref_Key").alias("Item")).distinct())
        known = _near(c, self.index, items).join(items, "Item", "left_semi")
        places = c.keep(moved.select(*self.place).unionByName(known.select(*self.place)).distinct())
        rows = _near(c, self.register, places, c.pinned)
        changed = moved.select(*self.key).unionByName(rows.join(items, "Item", "left_semi").select(*self.key)).distinct()
        mine = c.keep(rows.join(changed, self.key, "left_semi"))
        fresh = self.view(mine, _near(c, self.catalog, mine.select(F.col("Item").alias("Ref_Key")), c.pinned))
        return {self.NAME: _merged(c, self.NAME, fresh, self.key, mine.select(*self.key), delete=False)} | self._indexed(c, moved)

    def rebuild(self, c: MartContext) -> Iterator[tuple[str, dict[str, MergeResult]]]:
        rows = c.source(self.register)
        more = self._indexed(c, rows)  # whole with the first block, so that increments between blocks find all
        for label, block in blocks(c, self.view(rows, c.source(self.catalog)), F.coalesce(F.date_format("Period", "yyyy-MM"), F.lit(marts.NO_MONTH)), self.key):
            yield label, {self.NAME: _merged(c, self.NAME, block, self.key, block.select(*self.key), delete=False)} | more
            more = {}


@dataclass
class GroupMart:
    """Signed sums by document number, year and article, and which recorders and items lie behind each group.

    Groups are computed anew that a changed key lies behind now or lay behind before; groups that nothing is behind any
    more go. The lineage is laid out by group; an index has the same by key, with the places of the movements in the
    register (``place``: the columns that it is laid out by, which are part of its key). So an increment goes from
    changed keys to groups, from groups to all keys behind them and from these to places, and opens only parts of the
    mart, both its tables and the sources that these are in.
    """

    NAME: str
    register: str
    documents: str
    catalog: str
    document_type: str
    buckets: int = 64
    place: list[str] = field(default_factory=lambda: ["Recorder"])

    def __post_init__(self):
        self.lineage, self.index = f"{self.NAME}_lineage", f"{self.NAME}_index"
        self.ON = [self.register, self.documents, self.catalog]
        self.LAYOUTS = {self.NAME: by_key(marts.GROUP, self.buckets), self.lineage: by_key(marts.GROUP, self.buckets), self.index: by_key(["key"], self.buckets)}

    def rows(self, register: DataFrame, documents: DataFrame, catalog: DataFrame) -> DataFrame:
        return marts.group_rows(register, documents, catalog, self.document_type, self.place)

    def _all(self, c: MartContext) -> DataFrame:
        return self.rows(c.source(self.register), c.source(self.documents), c.source(self.catalog))

    def _at(self, c: MartContext, places: DataFrame) -> DataFrame:
        """Movements at the places with their groups, from the parts of the sources that they need."""
        register = _behind(_near(c, self.register, places, c.pinned), places)
        needed = lambda x: register.select(F.col(x).alias("Ref_Key"))
        return self.rows(register, _near(c, self.documents, needed("Recorder"), c.pinned), _near(c, self.catalog, needed("Item"), c.pinned))

    def _entries(self, rows: DataFrame) -> DataFrame:
        """(source, key, place, group): the index's rows."""
        pairs = F.array(*[F.struct(F.lit(s).alias("source"), F.col(s).cast("string").alias("key")) for s in ("Recorder", "Item")])
        return rows.select(*self.place, *marts.GROUP, F.explode(pairs).alias("x")).where("x.key is not null").select("x.source", "x.key", *self.place, *marts.GROUP).distinct()

    def _known(self, c: MartContext, keys: DataFrame) -> DataFrame:
        return _near(c, self.index, keys).join(keys, ["source", "key"], "left_semi")

    def _keys(self, c: MartContext, groups: DataFrame) -> DataFrame:
        """(source, key) that lie behind groups."""
        return _behind(_near(c, self.lineage, groups), groups).select("source", "key").distinct()

    def _indexed(self, c: MartContext, groups: DataFrame) -> DataFrame | None:
        """What the index has of groups."""
        if c.mart(self.index) is None or c.mart(self.lineage) is None:
            return None
        return _behind(self._known(c, c.keep(self._keys(c, groups))), groups)

    def _changes(self, c: MartContext, mine: DataFrame, groups: DataFrame, indexed: DataFrame | None) -> dict[str, MergeResult]:
        """Merges that bring ``groups``, of which the index has the entries ``indexed``, to what ``mine``, all their movements, makes of them."""
        fresh, entries = marts.grouped(mine, lineage=False).drop("rows_merged_on"), c.keep(self._entries(mine))
        scope = entries if indexed is None else entries.unionByName(indexed.select(*entries.columns)).distinct()
        return {
            self.NAME: _merged(c, self.NAME, fresh, marts.GROUP, groups, delete=True),
            self.lineage: _merged(c, self.lineage, marts.lineage_table(mine), ["source", "key", *marts.GROUP], groups, delete=True),
            self.index: _merged(c, self.index, entries, entries.columns, scope, delete=True),
        }

    def process_changes(self, c: MartContext) -> dict[str, MergeResult]:
        held = c.mart()
        if not c.cursor or any(c.mart(t) is None for t in (self.NAME, self.lineage, self.index)):
            rows = self._all(c)
            groups = c.keep(_union([f.select(*marts.GROUP) for f in (rows, held) if f is not None]).distinct())
            return self._changes(c, rows, groups, self._indexed(c, groups))
        moved = c.keep(c.delta(self.register, ["Recorder", "LineNumber"]).select(*dict.fromkeys(["Recorder", *self.place])).distinct())
        told = {"Recorder": [moved.select(F.col("Recorder").alias("key")), c.delta(self.documents, ["Ref_Key"]).select(F.col("Ref_Key").alias("key"))], "Item": [c.delta(self.catalog, ["Ref_Key"]).select(F.col("Ref_Key").alias("key"))]}
        keys = c.keep(_union([f.select(F.lit(s).alias("source"), F.col("key").cast("string").alias("key")) for s, fs in told.items() for f in fs]).where("key is not null").distinct())
        known = c.keep(self._known(c, keys))
        near = c.keep(self._at(c, moved.select(*self.place).unionByName(known.select(*self.place)).distinct()))
        changed = lambda s: _behind(near.withColumn("key", F.col(s).cast("string")), keys.where(F.col("source") == s).select("key"))
        groups = c.keep(_union([f.select(*marts.GROUP) for f in (known, changed("Recorder"), changed("Item"))]).distinct())
        indexed = c.keep(self._indexed(c, groups))
        places = c.keep(_union([f.select(*self.place) for f in (moved, known, indexed)]).distinct())
        return self._changes(c, c.keep(_behind(self._at(c, places), groups)), groups, indexed)

    def rebuild(self, c: MartContext) -> Iterator[tuple[str, dict[str, MergeResult]]]:
        """Blocks by month of a group's latest row: a group is in one block, whatever months its rows are in.

        Groups of the mart that nothing is behind any more are in the block of the month that the mart has for them.
        """
        rows, held = self._all(c).withColumn("__gone", F.lit(False)), c.mart()
        months = rows.groupBy(*marts.GROUP).agg(F.date_format(F.max("Period"), "yyyy-MM").alias("__month"))
        view = rows.join(months, marts.GROUP)
        if held is not None:
            gone = held.join(months, marts.GROUP, "left_anti").select(*marts.GROUP, F.date_format("Period", "yyyy-MM").alias("__month"), F.lit(True).alias("__gone"))
            view = view.unionByName(gone, allowMissingColumns=True)
        for label, block in blocks(c, view, F.col("__month"), ["Recorder", "Item"]):
            groups = c.keep(block.select(*marts.GROUP).distinct())
            indexed = self._indexed(c, groups)
            yield label, self._changes(c, block.where(~F.col("__gone")).drop("__gone", "__month"), groups, indexed if indexed is None else c.keep(indexed))
            c.release()
