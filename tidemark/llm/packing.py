"""Best-fit packing into sequences after a dominance reduction, on the histogram of piece lengths."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, running, utf8
from tidemark.llm.tokens import encoder

#: Largest capacity that is planned exactly on the driver: the histogram has at most so many rows, whatever the corpus.
MOST = 1 << 16
#: Pieces of a rank block, on average: ranks within a length are counted by block, so that no task orders a whole length.
BLOCK_ROWS = 5_000

Bin = tuple[int, ...]  # lengths in their order within the sequence


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Bin, int]], dict[int, int]]:
    """Martello-Toth reduction: sequences that some optimal packing has, with how often, and what is left to pack.

    A set of at most three pieces with the largest open piece ``a`` is fixed if it dominates all feasible sets with
    ``a``: what else ``a`` could have beside it fits in the places of the set's pieces. That holds if nothing fits
    beside ``a``; if a piece fills the sequence exactly, or is the longest that fits and no two do; and if at most two
    fit, when the longest single one is no shorter than the best two together, or the best two hold it and more.
    """
    left = {k: n for k, n in counts.items() if n > 0}
    sizes = sorted(left)
    fixed: list[tuple[Bin, int]] = []

    def take(found: Bin) -> None:
        need = Counter(found)
        n = min(left[k] // c for k, c in need.items())
        for k, c in need.items():
            left[k] -= n * c
            if not left[k]:
                del left[k]
                sizes.pop(bisect_left(sizes, k))
        fixed.append((found, n))

    kept: set[int] = set()
    while True:
        a = next((x for x in reversed(sizes) if x not in kept), None)
        if a is None:
            return fixed, left
        room = capacity - a
        left[a] -= 1  # what may stand beside one such piece
        beside = [x for x in sizes if x <= room and left[x]]
        left[a] += 1
        if not beside:
            take((a,))
            continue
        b = beside[-1]
        smallest = sorted(Counter({x: min(3, left[x] - (x == a)) for x in beside[:3]}).elements())[:3]
        if b == room or len(smallest) < 2 or smallest[0] + smallest[1] > room:
            take((a, b) if a != b or left[a] > 1 else (a,))
            continue
        if len(smallest) < 3 or sum(smallest) > room:  # at most two beside it
            best, pair = 0, None
            for y in beside:
                at = bisect_left(beside, room - y + 1) - 1
                if at >= 0 and y >= beside[at]:
                    x = beside[at]
                    if x == y and left[x] - (x == a) < 2:
                        at -= 1
                        if at < 0:
                            continue
                        x = beside[at]
                    if x + y > best:
                        best, pair = x + y, (y, x)
            if pair is None or b >= best:
                take((a, b))
                continue
            if pair[0] == b and (len(beside) < 2 or pair[1] >= max((x for x in beside if x + beside[0] <= room and x <= room - beside[0] and x != b), default=0)):
                take((a, *pair))
                continue
        kept.add(a)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Bin, int]]:
    """Best fit, longest first, on counts: sequences with equal content are one entry with its multiplicity."""
    open_: dict[int, list[list]] = defaultdict(list)  # room -> [content, how many]
    rooms: list[int] = []
    full: list[tuple[Bin, int]] = []

    def put(content: Bin, n: int, room: int) -> None:
        if not room:
            full.append((content, n))
            return
        if room not in open_:
            insort(rooms, room)
        open_[room].append([content, n])

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(rooms, size)
            if at == len(rooms):  # as many new sequences as full ones need, and one for the rest
                each = capacity // size
                if n >= each:
                    put((size,) * each, n // each, capacity - each * size)
                if n % each:
                    put((size,) * (n % each), 1, capacity - (n % each) * size)
                break
            room = rooms[at]
            content, m = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            each = min(room // size, n)
            used = min(m, n // each)
            if m > used:
                put(content, m - used, room)
            put(content + (size,) * each, used, room - each * size)
            n -= used * each
    return full + [(c, n) for held in open_.values() for c, n in held]


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Bin, int]], dict[str, int]]:
    """All sequences as (lengths, how often), and how many the reduction fixed against the lower bound by volume."""
    fixed, rest = reduce(counts, capacity)
    packed = best_fit(rest, capacity)
    volume = sum(k * n for k, n in counts.items())
    return fixed + packed, {"fixed": sum(n for _, n in fixed), "sequences": sum(n for _, n in fixed + packed), "lower_bound": -(-volume // capacity)}


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each row's ids with the end id, cut only if longer than the capacity.

    The first piece of a cut document takes the remainder, the others are full. A null or empty text is the end id alone.
    Texts of any length are encoded whole; repeated rows give repeated pieces; null ids are carried; an empty table
    gives none; other columns are not read.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in batches:
            out: list[list] = [[] for _ in names]
            for doc, text in zip(b.column(0), b.column(1)):
                ids = encode(text.as_py().decode("utf-8", "replace")) + end
                n = len(ids) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (i, j) in enumerate(zip(edges, edges[1:])):
                    part = ids[4 * i : 4 * j]
                    row = (doc.as_py(), k, i, j - i, zlib.crc32(part), *([np.frombuffer(part, "<u4").astype(np.int64).tolist()] if with_ids else []))
                    for held, v in zip(out, row):
                        held.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t")).mapInArrow(run, schema)


def slots(packed: list[tuple[Bin, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, rank from, rank to, pieces a sequence, first sequence, first offset): where the pieces of each length go.

    There are at most some three entries a distinct length in the plan, each of at most capacity / length pieces, so the
    table's size depends on the capacity alone.
    """
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for content, n in packed:
        at = 0
        for size, each in sorted(Counter(content).items(), reverse=True):
            out.append((size, used[size], used[size] + n * each, each, sequence, at))
            used[size] += n * each
            at += each * size
        sequence += n
    return out


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence_id and gapless offset; ``with_ids`` adds the token ids themselves.

    Nulls, empty texts and repeated rows each take their place; an empty table packs into nothing; other columns are
    not read. The driver gets the histogram of piece lengths, of at most ``capacity`` rows.
    """
    if not 1 < capacity <= MOST:
        raise ValueError(f"capacity must be 2 to {MOST}")
    spark = docs.sparkSession
    ws = Workspace(spark, "packing")
    cut = ws.save(pieces(docs, path, capacity, end_id, id_col, text_col, with_ids).withColumn("__salt", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    blocks = max(64, -(-cut.count() // BLOCK_ROWS))
    keyed = cut.withColumn("block", F.pmod("__salt", F.lit(blocks)).cast("int"))  # by place, as rows may repeat without end
    by_block = ws.save(keyed.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n")), "blocks")
    counts = {r["length"]: r["n"] for r in by_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    packed, _ = plan(counts, capacity)
    table = slots(packed)
    offsets = running(by_block, ["length"], "block", "n", "before").select("length", "block", "before")
    order = Window.partitionBy("length", "block").orderBy("__salt", "doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("at", F.row_number().over(order) - 1).join(offsets, ["length", "block"]).withColumn("rank", F.col("before") + F.col("at"))

    rows: dict[int, list] = defaultdict(list)
    for size, *where in table:
        rows[size].append(where)
    by_size = {s: [np.array(c, np.int64) for c in zip(*sorted(x))] for s, x in rows.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = b.column(b.schema.get_field_index("length")).to_numpy(), b.column(b.schema.get_field_index("rank")).to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                here = size == s
                low, _, each, first, at = by_size[int(s)]
                k = np.searchsorted(low, rank[here], "right") - 1
                r = rank[here] - low[k]
                sequence[here], offset[here] = first[k] + r // each[k], at[k] + r % each[k] * s
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*b.schema.names[:-1], "sequence_id", "offset"])

    out = [c for c in cut.columns if c != "__salt"]
    schema = ", ".join(f"{c} {t}" for c, t in cut.dtypes if c != "__salt") + ", sequence_id long, offset long"
    return ranked.select(*out, "rank").mapInArrow(place, schema)
