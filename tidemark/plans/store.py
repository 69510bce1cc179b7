"""Versioned tables in a shared folder: immutable files, one atomic commit for data and its announcement."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.filters import in_window
from tidemark.operators.merge import ACTION, MergeResult
from tidemark.spec import MERGED_ON, TableSpec


class Conflict(RuntimeError):
    """Another writer committed first."""


class LostLease(RuntimeError):
    """Another owner has the lease under which something was to be announced."""


@dataclass(frozen=True)
class Fence:
    """A lease as it was got: its epoch grows whenever the owner changes, and commits carry the last one."""

    lease: str
    epoch: int

    @property
    def key(self) -> str:
        return f"epoch-{self.lease}"


class Files:
    """Small text files of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf, self.root, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), root.rstrip("/"), spark.sparkContext._gateway
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str | None:
        p = self._path(name)
        if not self.fs.exists(p):
            return None
        stream = self.fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file that doesn't exist yet; False if another was first. Readers never see a part of it.

        A whole file is put in place by a step that fails where the name is taken: a hard link on a local or mounted
        disk, else a rename that doesn't replace, which HDFS has. Stores without such a rename must not be used.
        """
        p, tmp = self._path(name), self._path(f"_tmp/{uuid.uuid4().hex}")
        if self.fs.exists(p):
            return False
        stream = self.fs.create(tmp, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.fs.mkdirs(p.getParent())
        try:
            if self.fs.getUri().getScheme() == "file":
                at = lambda x: self.jvm.java.io.File(x.toUri().getPath()).toPath()
                self.jvm.java.nio.file.Files.createLink(at(p), at(tmp))
            else:
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
                context.rename(tmp, p, self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
                return True
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False
        finally:
            if self.fs.exists(tmp):
                self.fs.delete(tmp, False)
        return True

    def write(self, name: str, data: bytes) -> None:
        """Put or replace a file; large ones go in portions."""
        stream = self.fs.create(self._path(name), True)
        try:
            for at in range(0, len(data), 4 << 20):
                stream.write(bytearray(data[at : at + (4 << 20)]))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def size(self, path: str) -> int:
        """Bytes of all files under a full path."""
        return self.fs.getContentSummary(self.jvm.org.apache.hadoop.fs.Path(path)).getLength()

    def age(self, name: str) -> float:
        """Seconds since the file or folder was last changed."""
        return time.time() - self.fs.getFileStatus(self._path(name)).getModificationTime() / 1000


@dataclass
class Version:
    """A table at one commit: where its partitions' files are, and their schema."""

    number: int
    paths: dict[str, str] = field(default_factory=dict)
    schema: str = ""
    partition: str | None = None
    #: By part, least and greatest value of columns that readers select by, as text.
    stats: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    #: Of parts that a growth wrote: the former files with the same rows among others.
    origin: dict[str, list[str]] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


#: Buckets of a table that is laid out by key, at first and at most, and what one should hold: a batch reads and rewrites the
#: buckets of its keys only, so they have to grow in number with the table.
BUCKETS, MOST_BUCKETS, BUCKET_ROWS, BUCKET_BYTES = 64, 16_384, 200_000, 256 << 20
#: How sources of commits of full loads begin: a mart may ask not to be woken by them.
FULL_LOADS = ("full load", "marking", "orphans")
#: Attempts to put a commit after one that touched other tables.
ATTEMPTS = 20
#: What a running job has written for itself.
LANDING = "_landing"
_SERVICE = "__part"


def by_key(columns: Iterable[str], buckets: int = BUCKETS) -> str:
    """The layout of a table by a hash of columns; by a date's months, a layout is the column's name."""
    return f"#{buckets}:{','.join(columns)}"


def layout_of(spec: TableSpec, buckets: int = BUCKETS) -> str:
    """By group key, so that a group is in one bucket, else by primary key."""
    return by_key(spec.group_key or spec.pk, buckets)


def enough(wanted: float) -> int:
    """A number of buckets, doubled from the first until it suffices: so a bucket splits into whole buckets."""
    n = BUCKETS
    while n < wanted and n < MOST_BUCKETS:
        n *= 2
    return n


def spread(label: str, was: str, now: str) -> list[str]:
    """The parts of a layout that rows of a part of a former layout by the same columns are in now."""
    old, new = (int(x[1:].split(":", 1)[0]) for x in (was, now))
    n = int(label)
    return [f"{k:06d}" for k in range(n % old, new, old)] if new >= old else [f"{n % new:06d}"]


def _told(v: datetime | str) -> str:
    """A moment as statistics have it: without trailing zeros."""
    text = str(v)
    return text.rstrip("0").rstrip(".") if "." in text else text


def _label(layout: str, schema: T.StructType) -> Column:
    """Which part a row belongs to; keys are hashed in their stored type."""
    if layout.startswith("#"):
        n, columns = layout[1:].split(":", 1)
        return F.lpad(F.pmod(F.xxhash64(*[F.col(c).cast(schema[c].dataType) for c in columns.split(",")]), F.lit(int(n))).cast("string"), 6, "0")
    return F.coalesce(F.date_format(layout, "yyyy-MM"), F.lit("0000-00"))


@dataclass
class Staged:
    """Written files of some tables, not yet in any commit; ``base`` are the versions that they were made from."""

    versions: dict[str, Version] = field(default_factory=dict)
    counts: dict[str, dict] = field(default_factory=dict)
    base: dict[str, int] = field(default_factory=dict)

    def add(self, other: Staged) -> None:
        self.versions |= other.versions
        self.counts |= other.counts
        self.base |= other.base

    @property
    def modified(self) -> int:
        return sum(c[k] for c in self.counts.values() for k in ("inserted", "updated", "deleted"))


class Store:
    """Tables under one root, changed by numbered commits.

    A commit file holds the new versions of all tables it changes, what was done to each and what readers carry along
    (cursors), so data and its announcement cannot diverge. It is created if absent: of two writers with one number, one
    gets it, and the other puts its commit behind if that touched none of its tables, else gets ``Conflict``. A table
    laid out by key or by month is rewritten only in parts that a merge touched, old and new month of a moved row included.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root)

    # -- reading

    def head(self) -> int:
        found = self.files.names("_commits")
        return int(found[-1].split(".")[0]) if found else 0

    def commit(self, number: int) -> dict:
        text = self.files.read(f"_commits/{number:012d}.json")
        if text is None:
            raise KeyError(f"no commit {number}")
        return json.loads(text)

    def state(self, number: int | None = None) -> dict[str, Version]:
        number = self.head() if number is None else number
        return {k: Version(**v) for k, v in self.commit(number)["tables"].items()} if number else {}

    def carried(self, name: str, number: int | None = None) -> dict:
        """What the last commit up to ``number`` carries under a name: it changed together with that commit's data."""
        return self.state_of(name, {}, number)

    def state_of(self, name: str, default: Any, number: int | None = None) -> Any:
        number = self.head() if number is None else number
        return self.commit(number)["state"].get(name, default) if number else default

    def read(self, table: str, number: int | None = None, parts: Iterable[str] | None = None) -> DataFrame | None:
        """The table at a commit, the last by default; None if it isn't there yet. ``parts``: only files of these labels."""
        v = self.state(number).get(table)
        if v is None:
            return None
        paths = sorted({p for k, p in v.paths.items() if parts is None or k in parts})
        return self.spark.read.schema(v.struct).parquet(*paths) if paths else self.spark.createDataFrame([], v.struct)

    def read_window(self, table: str, column: str, start: datetime | None = None, end: datetime | None = None, number: int | None = None) -> DataFrame | None:
        """Rows whose moment ``column`` is in [start, end), open where a side is None; parts that can hold none aren't listed."""
        v = self.state(number).get(table)
        if v is None:
            return None

        def may(label: str) -> bool:
            if column not in (known := v.stats.get(label, {})):
                return True
            low, high = known[column]
            return low is not None and (start is None or high >= _told(start)) and (end is None or low < _told(end))

        return self.read(table, number, [k for k in v.paths if may(k)]).where(in_window(F.col(column), start, end))

    def touched(self, table: str, batch: DataFrame, number: int | None = None) -> list[str] | None:
        """Labels of the parts that rows with a batch's keys are in; None if the table isn't laid out by key."""
        v = self.state(number).get(table)
        if v is None or not (v.partition or "").startswith("#"):
            return None
        return sorted(r[0] for r in batch.select(_label(v.partition, v.struct)).distinct().collect())  # as many as buckets at most

    def changes(self, table: str, key: Iterable[str], since: int, until: int | None = None) -> DataFrame | None:
        """Rows of the table that are new or were written between two commits; only parts whose files differ are read.

        A table that was given more buckets meanwhile is compared bucket by bucket with those that they came from.
        """
        now, was = self.state(until).get(table), self.state(since).get(table) if since else None
        if now is None or was is None:
            return self.read(table, until)
        if now.partition == was.partition:
            parts = [k for k, p in now.paths.items() if was.paths.get(k) != p]
            before: list[str] = parts
        elif all((p or "").startswith("#") for p in (now.partition, was.partition)) and now.partition.split(":", 1)[1] == was.partition.split(":", 1)[1]:
            from_ = {k: spread(k, now.partition, was.partition)[0] for k in now.paths}
            parts = [k for k in now.paths if was.paths.get(from_[k]) not in (now.paths[k], *now.origin.get(k, []))]
            before = sorted({from_[k] for k in parts})
        else:
            return self.read(table, until)
        old = self.read(table, since, before)
        on = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*key, MERGED_ON)]
        return self.read(table, until, parts).alias("n").join(old.select(*key, MERGED_ON).alias("o"), on, "left_anti")

    def signals(self) -> dict[str, dict[str, int]]:
        """Per table, the last commits that changed it: ``feed``, by anything but a full load, and ``forced``, told without a change."""
        at = self.head()
        return self.commit(at).get("signals", {}) if at else {}

    def versions(self) -> dict[str, int]:
        return {k: v.number for k, v in self.state().items()}

    def log(self, since: int = 0) -> list[dict]:
        """What the commits after ``since`` that are still kept did: table, version, source, counts."""
        kept = [int(n.split(".")[0]) for n in self.files.names("_commits")]
        return [e | {"version": n, "committed_at": c["committed_at"]} for n in kept if n > since for c in [self.commit(n)] for e in c["log"]]

    # -- writing

    def stage(self, changes: dict[str, MergeResult], layouts: dict[str, str] | None = None, force: bool = False) -> Staged:
        """Write merges of tables; all that could fail in them fails here, before anything is announced.

        One pass counts what is done in which part, another writes the parts where something is. A merge into few parts is
        kept between the passes; one over a whole table is computed again, which costs less than holding the table.
        """
        at, out = self.head(), Staged()
        tables = self.state(at)
        for name, result in changes.items():
            old = tables.get(name)
            layout = (layouts or {}).get(name) or (old.partition if old else None)
            struct = T.StructType([T.StructField(f.name, f.dataType) for f in result.rows.schema if f.name != ACTION])
            rows = result.rows.withColumn(_SERVICE, _label(layout, struct) if layout else F.lit(""))
            rows = rows.cache() if result.parts is not None else rows
            out.base[name] = result.base if result.base is not None else old.number if old else 0
            try:
                dated = [f.name for f in struct if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
                ends = [g(F.when(F.col(ACTION) != "removed", F.col(c))).cast("string").alias(f"{k}{c}") for c in dated for k, g in (("<", F.min), (">", F.max))]
                told = rows.groupBy(_SERVICE, ACTION).agg(F.count(F.lit(1)).alias("n"), *ends).collect()  # a few rows a part
                done = {(r[0], r[1]): r["n"] for r in told}
                stats: dict[str, dict[str, list[str]]] = {}
                for r in told:
                    for c in dated:
                        if r[f"<{c}"] is not None:
                            low, high = stats.setdefault(r[0], {}).get(c, (r[f"<{c}"], r[f">{c}"]))
                            stats[r[0]][c] = [min(low, r[f"<{c}"]), max(high, r[f">{c}"])]
                for label in {part for part, _ in done}:
                    stats[label] = {c: stats.get(label, {}).get(c, [None, None]) for c in dated}
                count = lambda *actions: sum(n for (_, a), n in done.items() if not actions or a in actions)
                out.counts[name] = {"inserted": count("inserted"), "updated": count("updated"), "deleted": count("deleted", "removed"), "total": count()}
                touched = sorted({part for part, action in done if action != "kept"})
                if old and not force and not touched:
                    continue
                out.versions[name] = self._written(name, rows, struct, old, layout, at, result.parts, touched)
                kept_parts = out.versions[name].paths
                out.versions[name].stats = {k: (stats.get(k) or (old.stats.get(k, {}) if old and old.paths.get(k) == p else {})) for k, p in kept_parts.items()}
            finally:
                if result.parts is not None:
                    rows.unpersist()
        return out

    def put(self, staged: Staged, source: str, state: dict | None = None, fence: Fence | None = None, forced: Iterable[str] = (), as_it_is: bool = False) -> int:
        """Announce what was staged in one commit, together with ``state``; its number, 0 if there is nothing to announce.

        A commit carries the fence's epoch. It is refused once any commit carries a greater one: as a new owner announces
        its epoch before it does anything, and of two writers with one number one gets it, no owner that was replaced can
        announce anything later, however long it was asleep. ``forced`` tables are told without a change; with
        ``as_it_is`` the staged versions keep their numbers, as their rows did not change.
        """
        forced = list(forced)
        if not staged.versions and not state and not forced:
            return 0
        for _ in range(ATTEMPTS):
            at = self.head()
            last = self.commit(at) if at else {"tables": {}, "state": {}}
            if fence is not None and last["state"].get(fence.key, 0) > fence.epoch:
                raise LostLease(f"{source}: the lease is another's")
            tables = {k: Version(**v) for k, v in last["tables"].items()}
            if any((tables[k].number if k in tables else 0) != n for k, n in staged.base.items()):
                raise Conflict(f"{sorted(staged.base)} changed meanwhile")
            for k, v in staged.versions.items():
                tables[k] = v if as_it_is else replace(v, number=at + 1)
            signals = {k: dict(v) for k, v in last.get("signals", {}).items()}
            for k in (staged.versions if not as_it_is and not source.startswith(FULL_LOADS) else ()):
                signals.setdefault(k, {})["feed"] = at + 1
            for k in forced:
                signals.setdefault(k, {})["forced"] = at + 1
            entry = {
                "tables": {k: vars(v) for k, v in tables.items()},
                "log": [{"table": k, "source": source} | c for k, c in staged.counts.items()] + [{"table": k, "source": source, "forced": True} for k in forced],
                "state": last.get("state", {}) | (state or {}) | ({fence.key: fence.epoch} if fence is not None else {}),
                "signals": signals,
                "committed_at": datetime.now(UTC).isoformat(),
            }
            if self.files.create(f"_commits/{at + 1:012d}.json", json.dumps(entry)):
                return at + 1
        raise Conflict(f"{source} finds no free commit")

    def publish(self, changes: dict[str, MergeResult], source: str, layouts: dict[str, str] | None = None, state: dict | None = None, force: bool = False, fence: Fence | None = None) -> dict[str, dict]:
        """Commit merges of several tables at once; counts by table. A merge that changes nothing leaves its table's version."""
        staged = self.stage(changes, layouts, force)
        if staged.versions or state:
            self.put(staged, source, state, fence)
        return staged.counts

    def _written(self, name: str, rows: DataFrame, struct: T.StructType, old: Version | None, layout: str | None, at: int, parts: list[str] | None, touched: list[str]) -> Version:
        path = f"{self.root}/{name}/v={at + 1}-{uuid.uuid4().hex[:8]}"
        kept = rows.where(F.col(ACTION) != "removed")
        if layout is None:
            kept.select(*struct.names).write.parquet(path)
            return Version(at + 1, {"": path}, struct.json())
        same = old is not None and old.partition == layout and {(f.name, f.dataType) for f in old.struct} <= {(f.name, f.dataType) for f in struct}
        if parts is not None and not same:
            raise ValueError(f"{name} was read in part but has to be rewritten whole")
        paths = dict(old.paths) if same else {}
        if paths:
            if not layout.startswith("#"):
                touched = sorted({*touched, *self._left_months(rows, old, layout)})
            kept = kept.where(F.col(_SERVICE).isin(touched))
        kept = kept.drop(ACTION).repartition(_SERVICE)
        if MERGED_ON in struct.names:  # so that statistics of row groups tell what a window of change times needs
            kept = kept.sortWithinPartitions(_SERVICE, MERGED_ON)
        kept.write.partitionBy(_SERVICE).parquet(path)
        written = {n.split("=", 1)[1]: f"{path}/{n}" for n in Files(self.spark, path).names("") if n.startswith(f"{_SERVICE}=")}
        left = {m: p for m, p in paths.items() if m not in touched}
        return Version(at + 1, left | written, struct.json(), layout, origin={m: o for m, o in old.origin.items() if m in left} if same else {})

    def _left_months(self, rows: DataFrame, old: Version, by: str) -> list[str]:
        """Months that updated rows have left: those whose row count in the store isn't that of the new rows."""
        month = _label(by, old.struct).alias("m")
        before = self.spark.read.schema(old.struct).parquet(*sorted(set(old.paths.values()))).groupBy(month).agg(F.count(F.lit(1)).alias("b"), F.sum(F.xxhash64(by).cast("decimal(38,0)")).alias("hb"))
        after = rows.where(F.col(ACTION) != "removed").groupBy(month).agg(F.count(F.lit(1)).alias("a"), F.sum(F.xxhash64(by).cast("decimal(38,0)")).alias("ha"))
        moved = before.join(after, "m", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")) | ~F.col("ha").eqNullSafe(F.col("hb")))
        return [r["m"] for r in moved.select("m").collect()]

    def grow(self, table: str, bucket_bytes: int = BUCKET_BYTES, fence: Fence | None = None) -> int:
        """Lay a table that has outgrown its buckets out in more of them; how many it has then, 0 if it isn't laid out by key.

        The rows stay as they are and no reader is told of a change. A writer that changes the table meanwhile wins, and
        the growth is given up until the next call.
        """
        v = self.state().get(table)
        if v is None or not (v.partition or "").startswith("#"):
            return 0
        now, columns = v.partition[1:].split(":", 1)
        wanted = enough(sum(map(self.files.size, v.paths.values())) / bucket_bytes)
        if wanted <= int(now):
            return int(now)
        layout = f"#{wanted}:{columns}"
        path = f"{self.root}/{table}/v=grown-{uuid.uuid4().hex[:8]}"
        rows = self.spark.read.schema(v.struct).parquet(*sorted(set(v.paths.values())))
        rows.withColumn(_SERVICE, _label(layout, v.struct)).repartition(_SERVICE).write.partitionBy(_SERVICE).parquet(path)
        written = {n.split("=", 1)[1]: f"{path}/{n}" for n in Files(self.spark, path).names("") if n.startswith(f"{_SERVICE}=")}
        came = {k: spread(k, layout, v.partition)[0] for k in written}
        origin = {k: [v.paths[o], *v.origin.get(o, [])] for k, o in came.items()}
        stats = {k: v.stats[o] for k, o in came.items() if o in v.stats}  # of more rows than the part has
        try:
            self.put(Staged({table: Version(v.number, written, v.schema, layout, stats, origin)}, {}, {table: v.number}), f"growing {table}", fence=fence, as_it_is=True)
        except Conflict:
            self.files.delete(path.removeprefix(f"{self.root}/"))
            return int(now)
        return wanted

    # -- state documents: leases, cursors, registry

    def document(self, name: str) -> tuple[int, dict]:
        """(revision, content) of a state document; (0, {}) where there is none."""
        found = self.files.names(f"_state/{name}")
        if not found:
            return 0, {}
        return int(found[-1].split(".")[0]), json.loads(self.files.read(f"_state/{name}/{found[-1]}"))

    def replace_document(self, name: str, revision: int, content: dict) -> int:
        """Compare and set: the new revision, or ``Conflict`` if the document has moved on."""
        if not self.files.create(f"_state/{name}/{revision + 1:012d}.json", json.dumps(content)):
            raise Conflict(f"{name} has revision {revision + 1}")
        if revision > 4:
            self.files.delete(f"_state/{name}/{revision - 4:012d}.json")
        return revision + 1

    def vacuum(self, keep: int = 5, age: float = 86_400.0, retention: float = 0.0) -> int:
        """Delete commits and files that are no longer needed; how many version folders went.

        The last ``keep`` commits stay, those within ``retention`` seconds, and those that a carried cursor names, however
        old, as their readers begin there; files that none of them reads go, unless they are younger than ``age``
        seconds, as a writer may be about to announce them.
        """
        kept = [int(n.split(".")[0]) for n in self.files.names("_commits")]
        carried = (self.commit(kept[-1])["state"] if kept else {}).values()
        cursors = {held["cursor"].get("__commit", 0) for held in carried if isinstance(held, dict) and isinstance(held.get("cursor"), dict)}
        old = [n for n in kept[:-keep] if n not in cursors and self.files.age(f"_commits/{n:012d}.json") >= retention]
        for n in old:
            self.files.delete(f"_commits/{n:012d}.json")
        used = {p for n in kept if n not in old for v in self.state(n).values() for p in v.paths.values()}
        gone = 0
        for table in (n for n in self.files.names("") if not n.startswith("_")):
            for v in self.files.names(table):
                path = f"{self.root}/{table}/{v}"
                if not any(u == path or u.startswith(f"{path}/") for u in used) and self.files.age(f"{table}/{v}") >= age:
                    self.files.delete(f"{table}/{v}")
                    gone += 1
        return gone
