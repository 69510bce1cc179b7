"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, then Hamming verification."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, components, sized, utf8

SEED = 42
BITS = 64


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the whole text's word shingles, repeats included, as an unsigned 64-bit number; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    first, last = (ends - lens)[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(first, last)], np.uint64)
    bits = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):  # bounds the unpacked bits of a very long text
        part = h[at : at + (1 << 16)]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(h), bitorder="little").view(np.uint64)[0])


def _hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, hashed: bool = False) -> DataFrame:
    """(doc_id, fp): one row per input row, fp a signed long with the fingerprint's 64 bits; with ``hashed``, also a hash of the text.

    A null or empty text has fingerprint 0; null ids are carried; other columns are not read; an empty table gives none.
    """
    more = ["text"] if hashed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *more])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t"), *[_hash(text_col).alias(c) for c in more])
    return rows.mapInArrow(run, "doc_id long, fp long" + ", text long" * hashed)


def masks(distance: int, spare: int = 2) -> list[int]:
    """Bit masks, each of ``spare`` whole blocks of distance + spare: of fingerprints within the distance, some pair of blocks agrees."""
    n = distance + spare
    cuts = [round(BITS * k / n) for k in range(n + 1)]
    block = [((1 << cuts[k + 1]) - 1) ^ ((1 << cuts[k]) - 1) for k in range(n)]
    return [sum(block[k] for k in pick) for pick in combinations(range(n), spare)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(ws: Workspace, distinct: DataFrame, distance: int = 2, hot: int = 48) -> DataFrame:
    """Edges (a, b) that connect exactly what Hamming ``distance`` 2 or less connects among the distinct ``fp``: by a join on blocks, and for blocks of more than ``hot`` fingerprints by points that close ones share.

    The fingerprints are distinct and not null, however many rows or texts each stands for; none gives no edge. Every
    block key holds a mask's bits. Keys of at most ``hot`` fingerprints are joined with themselves and verified.
    For fingerprints under a hotter key the pairs could be quadratic; two fingerprints within distance 2 share a point
    at distance 1 or less from both, so those emit their 65 points and each point links its at most 65 owners in a star.
    That is exact too, and linear.
    """
    if distance != 2:
        raise ValueError("hot keys are resolved for distance 2")
    spark = distinct.sparkSession
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(signed(m)).alias("m")) for k, m in enumerate(masks(distance))])
    keyed = distinct.select("fp", F.explode(table).alias("x")).select("x.k", F.col("fp").bitwiseAND(F.col("x.m")).alias("key"), "fp")
    heavy = ws.save(keyed.groupBy("k", "key").count().where(F.col("count") > hot).select("k", "key"), "heavy")
    n = heavy.count()
    light = keyed.join(sized(heavy, n), ["k", "key"], "left_anti") if n else keyed
    other = light.select("k", "key", F.col("fp").alias("b"))
    pairs = (
        light.withColumnRenamed("fp", "a")
        .join(other, ["k", "key"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
        .select("a", "b")
    )
    if not n:
        return pairs
    flips = F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << k)) for k in range(BITS)])
    crowded = keyed.join(sized(heavy, n), ["k", "key"], "left_semi").select("fp").distinct()
    points = crowded.select("fp", F.explode(flips).alias("f")).select(F.col("fp").bitwiseXOR(F.col("f")).alias("p"), "fp")
    owners = points.groupBy("p").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)  # at most 65 a point
    stars = owners.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return pairs.union(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every input row; component_id is the smallest id reachable over links.

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows stay repeated. A null id is carried
    and never becomes a component_id unless its whole component has null ids. An empty table gives an empty result;
    other columns of ``docs`` are not read.
    """
    ws = Workspace(docs.sparkSession, "simhash")
    fps = ws.save(fingerprints(docs, id_col, text_col, shingle), "fps")
    return fps.join(_named(ws, fps, distance), "fp").select("doc_id", "fp", "component_id")


def _named(ws: Workspace, fps: DataFrame, distance: int, root: bool = False) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint; with ``root``, also its component's smallest fingerprint, which no other component has."""
    distinct = ws.save(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    edges = ws.save(links(ws, distinct, distance), "links")
    comp = components(ws, edges)
    ws.drop(edges)
    n = comp.count()
    members = distinct.join(sized(comp.withColumnRenamed("node", "fp"), n), "fp")
    lows = ws.save(members.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    more = ["root"] if root else []
    linked = comp.join(sized(lows, n), "root").select(F.col("node").alias("fp"), "component_id", *more)
    named = distinct.join(sized(linked, n), "fp", "left")
    lone = F.col("root").isNull() if root else F.col("component_id").isNull()
    named = named.select("fp", F.when(lone, F.col("low")).otherwise(F.col("component_id")).alias("component_id"), *[F.coalesce(c, "fp").alias(c) for c in more])
    return ws.save(named, "named")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, with its smallest id; of several texts with that id, that of the smallest fingerprint.

    Rows are made unique by id and text first, with a partial pass before the shuffle, and the join reuses that
    partitioning: the texts are shuffled once, whatever the number of kept rows. Texts are told apart by a 64-bit hash
    among the rows of one id. Which row stays is the same in every run, but among rows of one id and one text.

    A null id comes after all others: its row stays where its component has no other id. Null and empty texts are one
    component; an empty table gives none; columns of any name pass through unchanged.
    """
    ws = Workspace(docs.sparkSession, "simhash")

    def key(c: str, text: Column) -> dict[str, Column]:
        return {"__none": F.col(c).isNull(), "__key": F.coalesce(F.col(c).cast("long"), F.lit(0)), "__text": text}

    found = ws.save(fingerprints(docs, id_col, text_col, hashed=True), "fps")
    found = found.join(_named(ws, found, 2, root=True), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    best = found.groupBy("root").agg(F.min(F.struct("fp", "text", "doc_id")).alias("x")).select("x.*").withColumns(key("doc_id", F.col("text"))).select("__none", "__key", "__text")
    one = docs.withColumns(key(id_col, _hash(text_col))).dropDuplicates(["__none", "__key", "__text"])
    return one.join(best, ["__none", "__key", "__text"], "left_semi").select(*docs.columns)
