"""Shared folders, written intermediate tables, sized joins and connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of two or three longs that one broadcast may hold (about 8 MB); beyond it the join shuffles.
BROADCAST_ROWS = 200_000
#: ASCII white space, as ``bytes.split()`` sees it.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one pass of a text operator looks at; a longer single text gets a pass of its own.
CHUNK = 1 << 20

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``; a temporary one only in local mode where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _OWN[app]


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Workspace:
    """Tables written under one folder of the shared directory.

    ``save`` writes a frame as Parquet and returns the frame that reads it, which cuts lineage and survives the loss of
    any executor. ``drop`` removes a table that no later step reads. What a returned result still reads stays until the
    application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        atexit.register(self._close)

    def path(self, label: str) -> str:
        return f"{self.root}/{label}-{uuid.uuid4().hex[:8]}"

    def save(self, df: DataFrame, label: str) -> DataFrame:
        path = self.path(label)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        out._tidemark_path = path  # keeps the id from being reused while the frame lives
        return out

    def drop(self, *frames: DataFrame) -> None:
        for f in frames:
            if path := self._paths.pop(id(f), None):
                delete(self.spark, path)

    def _close(self) -> None:
        try:
            delete(self.spark, self.root)
        except Exception:  # the JVM is gone already; its shared folder has its own life cycle
            pass


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit the bound; else unchanged, so the join shuffles and AQE splits skew."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def running(df: DataFrame, keys: list[str], order: str, value: str, out: str, width: int = 1024) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of equal ``keys`` that come before in ``order``.

    ``df`` has one row for each keys and ``order``, which counts from 0 without large gaps. Sums run within ranges of
    ``width`` numbers, on top of the totals of the lower ranges, so a task orders ``width`` rows or the ranges of one key.
    Null keys are a key of their own; an empty table gives none.
    """
    df = df.withColumn("__range", F.floor(F.col(order) / width).cast("long"))
    lower = lambda *by: Window.partitionBy(*[F.col(c) for c in keys], *by)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    whole = lower() if keys else Window.partitionBy(F.lit(0))
    ranges = df.groupBy(*keys, "__range").agg(F.sum(value).alias("__sum"))
    ranges = ranges.select(*[F.col(c).alias(f"__k{n}") for n, c in enumerate(keys)], F.col("__range").alias("__r"), F.coalesce(F.sum("__sum").over(before(whole.orderBy("__range"))), F.lit(0)).alias("__base"))
    on = F.col("__range") == F.col("__r")
    for n, c in enumerate(keys):
        on = on & F.col(c).eqNullSafe(F.col(f"__k{n}"))
    within = F.coalesce(F.sum(value).over(before(lower("__range").orderBy(order))), F.lit(0))
    return df.withColumn("__within", within).join(ranges, on).withColumn(out, F.col("__base") + F.col("__within")).select(*[c for c in df.columns if c != "__range"], out)


def utf8(c: str | Column) -> Column:
    """Text as its UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("binary")


def chunks(column: pa.Array) -> Iterator[list[bytes]]:
    """The values of a binary column in lists of about ``CHUNK`` bytes."""
    held, size = [], 0
    for v in column:
        t = v.as_py() or b""
        if held and size + len(t) > CHUNK:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def keep_rows(docs: DataFrame, text_col: str, keep: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` whose text ``keep`` accepts, all columns as they are; a null text is shown to it as empty.

    Rows are judged one by one, so repeated ones stay or go together; an empty table gives none.
    """
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [keep(t) for t in chunks(b.column(place).cast(pa.binary()))]
            yield b.filter(pa.array(np.concatenate(ok) if ok else np.zeros(0, bool)))

    return docs.mapInArrow(run, docs.schema)


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, root) per node, root its component's smallest.

    Alternates large-star and small-star steps until the edge set no longer changes; each step's table is written, so
    no task gathers a component and the driver sees counts only. Node minima are pre-aggregated before their shuffle,
    and a hub's rows meet its one minimum in a join that is broadcast if small and else may be split as skewed.
    """
    e = ws.save(
        edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges"
    )  # v > u

    def state(df: DataFrame) -> tuple[int, int]:
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], int(r["h"] or 0)

    now = state(e)
    while now[0]:
        both = e.select("v", "u").union(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = ws.save(both.groupBy("v").agg(F.least("v", F.min("u")).alias("m")), "low")
        large = ws.save(
            both.where("u > v").join(sized(low, low.count()), "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct(),
            "large",
        )
        ws.drop(low)
        low = ws.save(large.groupBy("v").agg(F.min("u").alias("m")), "low")
        moved = large.join(sized(low, low.count()), "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        new = ws.save(low.select("v", F.col("m").alias("u")).union(moved.where("v > u")).distinct(), "edges")
        ws.drop(large, low, e)
        e, was, now = new, now, state(new)
        if now == was:
            break
    return ws.save(
        e.select(F.col("v").alias("node"), F.col("u").alias("root")).union(e.select("u", "u").distinct()), "components"
    )
