"""Target-distribution importance resampling: hashed counts as CSR blocks, gains from column sums, weights as products.

The document-by-bucket count matrix is written once, in blocks of compressed sparse rows. Its column sums and those of a
target give each bucket's gain; the matrix times the gains gives each document's weight; seeded Gumbel noise on top of
the weights turns the highest scores into a draw without replacement.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, chunks, utf8

_WORD = np.array([48 <= c < 58 or 97 <= c < 123 or c >= 128 for c in range(256)])
_TABLE = bytes(c + 32 if 65 <= c < 91 else c if _WORD[c] else 32 for c in range(256))

#: Bytes of texts in one block. Readers hold thousands of rows at once, so a row is kept as small as a few texts.
BLOCK_BYTES = 1 << 13
#: Blocks that one pass over a batch looks at.
PASS = 256

#: One block: cells indptr[i] to indptr[i + 1] of buckets and counts belong to ids[i].
BLOCK = "ids array<long>, n_words array<long>, n_features array<long>, indptr array<int>, buckets array<int>, counts array<int>"


@dataclass(frozen=True)
class Features:
    """Runs of 1 to ``longest`` consecutive words, hashed by CRC-32 to ``buckets`` buckets."""

    longest: int = 1
    buckets: int = 10_000

    def words(self, text: bytes) -> list[bytes]:
        """Runs of a-z, 0-9 and bytes above 0x7F, A-Z lower-cased."""
        return text.translate(_TABLE).split()

    def hashed(self, words: list[bytes], memo: dict[bytes, int]) -> np.ndarray:
        """The bucket of every feature, repeats included."""
        out = []
        for n in range(1, min(self.longest, len(words)) + 1):
            runs = words if n == 1 else map(b" ".join, zip(*(words[k:] for k in range(n))))
            for run in runs:
                k = memo.get(run)
                if k is None:
                    if len(memo) >= 1 << 18:
                        memo.clear()
                    k = memo[run] = zlib.crc32(run) % self.buckets
                out.append(k)
        return np.array(out, np.int64)


def _lists(edges: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values, kind))


def _edges(lengths: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _blocks(sizes: list[int]) -> np.ndarray:
    """Where blocks of ``BLOCK_BYTES`` begin, and the end; a longer text is a block of its own."""
    starts, held = [], 0
    for k, n in enumerate(sizes):
        if not starts or held + n > BLOCK_BYTES:
            starts.append(k)
            held = 0
        held += n
    return np.array([*starts, len(sizes)])


def matrix(docs: DataFrame, features: Features, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The count matrix of ``docs`` in CSR blocks, one block for ``BLOCK_BYTES`` of texts or a single longer text.

    A null or empty text is an empty row of the matrix; repeated rows are repeated rows; null ids are carried; other
    columns are not read; an empty table gives no block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for b in batches:
            at = 0
            for texts in chunks(b.column(1)):
                ids = b.column(0).slice(at, len(texts))
                at += len(texts)
                words, rows, found = [], [], []
                for t in texts:
                    w = features.words(t)
                    r = features.hashed(w, memo)
                    words.append(len(w))
                    rows.append(len(r))
                    found.append(np.unique(r, return_counts=True))
                blocks = _blocks([len(t) for t in texts])
                cells = _edges([len(k) for k, _ in found])
                ids = pa.ListArray.from_arrays(pa.array(blocks, pa.int32()), ids)
                sums = [_lists(blocks, np.array(x), pa.int64()) for x in (words, rows)]
                indptr = [cells[i : j + 1] - cells[i] for i, j in zip(blocks, blocks[1:])]
                indptr = _lists(_edges([len(x) for x in indptr]), np.concatenate(indptr), pa.int32())
                values = [_lists(cells[blocks], np.concatenate([f[k] for f in found]), pa.int32()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([ids, *sums, indptr, *values], names=["ids", "n_words", "n_features", "indptr", "buckets", "counts"])

    return docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("t")).mapInArrow(run, BLOCK)


def _passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, PASS) for b in batches for at in range(0, b.num_rows, PASS))


def column_sums(blocks: DataFrame, features: Features) -> np.ndarray:
    """How often each bucket occurs; every task adds up its blocks, and the driver gets one number for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(features.buckets, np.int64)
        for b in _passes(batches):
            keys, counts = (c.flatten().to_numpy() for c in b.columns)
            np.add.at(sums, keys, counts)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(sums[some], pa.int64())], names=["bucket", "n"])

    parts = blocks.select("buckets", "counts").mapInArrow(run, "bucket long, n long")
    out = np.zeros(features.buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most a row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: 1000 times the log ratio of its smoothed shares of the target and the source, rounded down."""
    s, t, n = source.astype(float), target.astype(float), float(len(source))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weights(blocks: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the matrix times the gains, a row of ``docs`` each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _passes(batches):
            ids, n_words, n_features, indptr, keys, counts = (c.flatten() for c in b.columns)
            first = _edges(b.column(0).value_lengths().to_numpy())[:-1] + np.arange(b.num_rows)  # of each block in indptr
            cells = _edges(np.delete(np.diff(indptr.to_numpy().astype(np.int64), prepend=0), first))
            sums = _edges(gain[keys.to_numpy()] * counts.to_numpy())
            yield pa.RecordBatch.from_arrays([ids, n_words, n_features, pa.array(sums[cells[1:]] - sums[cells[:-1]], pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return blocks.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise of a row, 1000 times and rounded down, from the first 8 hex digits of the SHA-256 of ``seed:id``; a null id is no characters."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(ws: Workspace, rows: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``rows`` with their place from 1 in ``order``: dealt by ranges, numbered in each, on top of the sizes of the lower ranges."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The number of a row is its partition's, then its place there; it is written before anything reads it.
    at = ws.save(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["part"]: r["n"] for r in at.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one number for each range
    base, below = [], 0
    for k in sorted(sizes):
        base.append((k, below))
        below += sizes[k]
    if not base:
        return at.withColumn(out, F.lit(None).cast("long")).drop("__at")
    bases = F.broadcast(spark.createDataFrame(base, "__part long, __base long"))  # as many rows as shuffle partitions
    return at.withColumn("__part", part).join(bases, "__part").withColumn(out, F.col("__base") + place + 1).drop("__at", "__part", "__base")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024, features: Features = Features(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of ``docs``, drawn towards the texts of ``target``.

    Of the N rows of at least ``least_words`` words, ``percent`` hundredths, rounded down, are drawn: those of the
    highest scores, of equal ones those of the smaller id, a null id last; rank is their place from 1, null for the rest.
    A null or empty text has no feature and weight 0. Repeated rows are drawn one by one; other columns are not read;
    an empty table gives none, and an empty target is taken as it is, every bucket equally likely.
    """
    ws = Workspace(docs.sparkSession, "resample")
    blocks = ws.save(matrix(docs, features, id_col, text_col), "csr")
    wanted = column_sums(matrix(target.select(F.lit(0).alias("id"), F.col(text_col).alias("t")), features, "id", "t"), features)
    gain = gains(column_sums(blocks, features), wanted)
    scored = ws.save(weights(blocks, gain).withColumn("score", F.col("weight") + noise("doc_id", seed)), "scores")
    ws.drop(blocks)
    some = scored.where(F.col("n_words") >= least_words)
    draw = percent * some.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    places = ranked(ws, some, order, "rank").withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return places.unionByName(rest)
