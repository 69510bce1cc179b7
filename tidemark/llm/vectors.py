"""Embedding near-duplicates: a robust-pruned flat graph on overlapping shards, and range-expanding greedy search."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Workspace, components, sized

log = logging.getLogger(__name__)

#: Vectors that cluster centres are fitted on: at least and at most, and their bytes in double precision at most; centres at
#: most, and how many are fitted in one go: more are fitted in two levels.
FIT_ROWS, MOST_FIT_ROWS, MOST_FIT_BYTES, MOST_CENTRES, ONE_LEVEL = 20_000, 200_000, 512 << 20, 50_000, 1_024
#: Vectors with a link that recall is measured on; vectors drawn for that in one step, and most steps; queries planted beside
#: drawn vectors, so that there are links to miss whatever the table holds.
AUDIT_ROWS, AUDIT_STEP, AUDIT_STEPS, PLANTED = 200, 4_096, 2, 256
#: Queries that a task searches for at once, and rows of one product of matrices.
BLOCK, PRODUCT = 256, 2_048
#: Neighbours that a range search looks at in one step.
SPREAD = 1 << 19
#: How far under the threshold rows still lead a search on, and from which cosine two centres count as one.
SLACK = 0.05


def _normed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(directions in double precision, which rows have one): scaled first, so that components near the ends of the range don't overflow or vanish."""
    x = x.astype(np.float64)
    big = np.abs(x).max(axis=1, initial=0)
    ok = np.isfinite(big) & (big > 0)
    x = x[ok] / big[ok][:, None]
    return x / np.linalg.norm(x, axis=1, keepdims=True) + 0.0, ok


def units(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, key, vec): a digest of the direction and the components' bytes, as 4-byte numbers if the column has these, else as 8-byte ones.

    Null both for vectors that are null, empty, zero or hold null or non-finite components. Equal directions have equal
    keys. Repeated rows give repeated results; null ids are carried; other columns are not read; an empty table gives none.
    """
    kind = width(vectors, vec_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(1)
            size = pc.fill_null(pc.list_value_length(col), 0).to_numpy()
            first = np.cumsum(size) - size
            values = pc.fill_null(pc.list_flatten(col), np.nan).to_numpy()
            key, vec = [None] * b.num_rows, [None] * b.num_rows
            for d in np.unique(size[size > 0]).tolist():
                rows = np.flatnonzero(size == d)
                x = values[first[rows][:, None] + np.arange(d)]
                u, ok = _normed(x)
                for k, r, v in zip(rows[ok].tolist(), u, x[ok].astype(kind)):
                    key[k], vec[k] = xxhash.xxh128_digest(r.tobytes()), v.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key, pa.binary()), pa.array(vec, pa.binary())], names=["vec_id", "key", "vec"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{'float' if kind == 'f4' else 'double'}>").alias("v"))
    return rows.mapInArrow(run, "vec_id long, key binary, vec binary")


def width(vectors: DataFrame, vec_col: str) -> str:
    """The numpy type that holds the column's components exactly."""
    t = vectors.schema[vec_col].dataType
    return "f4" if isinstance(t, T.ArrayType) and isinstance(t.elementType, T.FloatType) else "f8"


def _nearest(x: np.ndarray, c: np.ndarray, most: int = 1) -> np.ndarray:
    """For each row the ``most`` centres of the largest cosine, nearest first, a block of rows at a time."""
    out = [np.zeros((0, min(most, len(c))), np.int32)]
    for at in range(0, len(x), PRODUCT):
        sim = x[at : at + PRODUCT] @ c.T
        if most < len(c):
            top = np.argpartition(-sim, most - 1, axis=1)[:, :most]
            order = np.argsort(-np.take_along_axis(sim, top, 1), axis=1, kind="stable")
            out.append(np.take_along_axis(top, order, 1).astype(np.int32))
        else:
            out.append(np.argsort(-sim, axis=1, kind="stable").astype(np.int32))
    return np.concatenate(out)


def centres(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        at = _nearest(x, c)[:, 0]
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.where(norm > 0, norm, 1), c)
    return c


def fitted(x: np.ndarray, k: int) -> np.ndarray:
    """About ``k`` centres; many in two levels, so that the work grows with the root of their number."""
    if k <= ONE_LEVEL:
        return centres(x, k)
    coarse = centres(x, int(np.sqrt(k)))
    at = _nearest(x, coarse)[:, 0]
    groups = [x[at == g] for g in range(len(coarse))]
    return np.concatenate([centres(g, max(1, round(k * len(g) / len(x)))) for g in groups if len(g)])


def apart(c: np.ndarray, most: float) -> np.ndarray:
    """Centres without those that lie at cosine ``most`` or more to an earlier one, which would part a dense group."""
    kept = np.zeros((0, c.shape[1]))
    for at in range(0, len(c), BLOCK):
        some = c[at : at + BLOCK]
        some = some[~(some @ kept.T >= most).any(axis=1)]
        near, ok = some @ some.T >= most, np.zeros(len(some), bool)
        for k in range(len(some)):
            ok[k] = not (near[k] & ok).any()
        kept = np.concatenate([kept, some[ok]])
    return kept


def _matrix(column: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    """Directions of the rows, all of one length."""
    rows = column.to_pylist()
    return _normed(np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1))[0]


def deal(rows: DataFrame, centre: np.ndarray, most: int, kind: str) -> DataFrame:
    """``rows`` once for each of the ``most`` nearest centres: with shard (the centre), rank (0 is the nearest) and near (all of them, as bytes)."""
    names, at = rows.columns, rows.columns.index("vec")
    shared = rows.sparkSession.sparkContext.broadcast(centre)  # once per executor, not with every task; at most MOST_CENTRES rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            near = _nearest(_matrix(b.column(at), kind), shared.value, most)
            n, k = near.shape
            lists = pa.array([r.tobytes() for r in near], pa.binary())
            take = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.ravel()), pa.array(np.tile(np.arange(k, dtype=np.int32), n)), lists.take(take), *(c.take(take) for c in b.columns)], names=["shard", "rank", "near", *names]
            )

    return rows.mapInArrow(run, "shard int, rank int, near binary, " + ", ".join(f"{c} {t}" for c, t in rows.dtypes))


def prune(x: np.ndarray, degree: int, near: int = 64, far: int = 32, alpha: float = 1.2, seed: int = 3) -> np.ndarray:
    """Neighbours of each row (-1: none): robust pruning of its nearest and of random rows.

    The nearest open candidate becomes a neighbour and closes all that lie closer to it, by the factor alpha, than to
    the row itself; so a dense group keeps few links inside and some far ones stay, which keeps the graph navigable.
    """
    n = len(x)
    rng = np.random.default_rng(seed)
    out = np.full((n, degree), -1, np.int32)
    if n < 2:
        return out
    y = x.astype(np.float32)
    k = min(near, n - 1)
    for at in range(0, n, BLOCK):
        own = np.arange(at, min(at + BLOCK, n))
        row = np.arange(len(own))
        sim = y[own] @ y.T
        sim[row, own] = -2
        cand = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        if n > k + 1:
            cand = np.concatenate([cand, rng.integers(0, n, (len(own), far))], axis=1)
        dist = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(sim, cand, 1)))
        dist[cand == own[:, None]] = np.inf
        z = y[cand]
        inner = z @ z.transpose(0, 2, 1)
        for d in range(degree):
            best = np.argmin(dist, axis=1)
            ok = np.isfinite(dist[row, best])
            if not ok.any():
                break
            pick = cand[row, best]
            out[own[ok], d] = pick[ok]
            between = np.sqrt(np.maximum(0, 2 - 2 * inner[row, best]))
            between[cand == pick[:, None]] = 0
            dist[alpha * between <= dist] = np.inf
    return out


class Graph:
    """Adjacency lists end to end: a hub's long list costs its own length, not a column for every row."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n: int):
        """Links (a, b) among ``n`` rows, taken in both directions, repeats once."""
        pair = np.unique(np.concatenate([a, b]).astype(np.int64) * n + np.concatenate([b, a]))
        self.to = pair % n
        self.width = np.bincount(pair // n, minlength=n)
        self.first = np.cumsum(self.width) - self.width

    def padded(self, rows: np.ndarray) -> np.ndarray:
        """One line of neighbours per row, filled up with -1."""
        width = self.width[rows]
        place = np.arange(width.max(initial=0))
        inside = place < width[:, None]
        out = np.full(inside.shape, -1, np.int64)
        out[inside] = self.to[(self.first[rows][:, None] + place)[inside]]
        return out

    def spread(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``rows``, its neighbour) for all neighbours of all rows."""
        width = self.width[rows]
        of = np.repeat(np.arange(len(rows)), width)
        return of, self.to[np.arange(len(of)) + np.repeat(self.first[rows] - (np.cumsum(width) - width), width)]

    def portions(self, rows: np.ndarray, most: int) -> Iterator[slice]:
        """Runs of ``rows`` with about ``most`` neighbours each."""
        part = np.cumsum(self.width[rows]) // most
        edge = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(rows)]])
        for a, b in zip(edge[:-1], edge[1:]):
            yield slice(int(a), int(b))


def search(x: np.ndarray, graph: Graph, queries: np.ndarray, own: np.ndarray, threshold: float, beam: int, slack: float = SLACK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, row) pairs of cosine ``threshold`` or more, a block of queries at a time.

    Greedy from the medoid, then outwards while rows are in range. ``own`` is the row that a query is itself, or -1.
    """
    n = len(x)
    if not n:
        return
    start = int(np.argmax(x @ x.sum(axis=0)))
    for at in range(0, len(queries), BLOCK):
        xq = queries[at : at + BLOCK]
        m = len(xq)
        row = np.arange(m)
        seen = np.zeros((m, n), bool)
        seen[:, start] = True
        ids = np.full((m, beam), -1, np.int64)
        sims = np.full((m, beam), -np.inf)
        done = np.ones((m, beam), bool)
        ids[:, 0], sims[:, 0], done[:, 0] = start, xq @ x[start], False
        hit_q, hit_v, hit_s = [row], [np.full(m, start)], [sims[:, 0].copy()]
        while True:
            k = np.argmax(np.where(done, -np.inf, sims), axis=1)
            live = np.flatnonzero(~done[row, k])
            if not len(live):
                break
            done[live, k[live]] = True
            nb = graph.padded(ids[live, k[live]])
            new = (nb >= 0) & ~seen[live[:, None], nb]
            i, j = np.nonzero(new)
            v = nb[i, j]
            seen[live[i], v] = True
            s = np.einsum("ij,ij->i", xq[live[i]], x[v])
            close = s >= threshold - slack
            hit_q.append(live[i[close]]), hit_v.append(v[close]), hit_s.append(s[close])
            more = np.full(nb.shape, -np.inf)
            more[i, j] = s
            all_s = np.concatenate([sims[live], more], axis=1)
            top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            sims[live] = np.take_along_axis(all_s, top, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], nb], axis=1), top, 1)
            done[live] = np.take_along_axis(np.concatenate([done[live], ~new], axis=1), top, 1)
        fq, fv, fs = np.concatenate(hit_q), np.concatenate(hit_v), np.concatenate(hit_s)
        while len(fq):
            ok = (fs >= threshold) & (own[at + fq] != fv)
            yield at + fq[ok], fv[ok]
            grow = fs >= threshold - slack
            fq, fv = fq[grow], fv[grow]
            grown = []
            for part in graph.portions(fv, SPREAD):
                of, nb = graph.spread(fv[part])
                pair = fq[part][of] * n + nb
                pair = np.unique(pair[~seen.ravel()[pair]])
                q, v = pair // n, pair % n
                seen[q, v] = True
                s = np.concatenate([np.einsum("ij,ij->i", xq[q[p : p + SPREAD // 8]], x[v[p : p + SPREAD // 8]]) for p in range(0, len(q), SPREAD // 8)] or [np.zeros(0)])
                keep = s >= threshold - slack
                grown.append((q[keep], v[keep], s[keep]))
            fq, fv, fs = (np.concatenate(c) for c in zip(*grown))


def compared(x: np.ndarray, queries: np.ndarray, own: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs as a search that misses nothing, by comparing each query with each row."""
    for at in range(0, len(queries) if len(x) else 0, BLOCK):
        for p in range(0, len(x), PRODUCT):
            q, v = np.nonzero(queries[at : at + BLOCK] @ x[p : p + PRODUCT].T >= threshold)
            other = own[at + q] != p + v
            yield at + q[other], p + v[other]


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of each pair (a, b) in place; ``parent`` names each row's smallest joined row before and after."""
    while True:
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return
        pair = np.unique(np.maximum(a[apart], b[apart]) * len(parent) + np.minimum(a[apart], b[apart]))
        a, b = pair // len(parent), pair % len(parent)
        np.minimum.at(parent, a, b)
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = 2_000, overlap: int = 3, probes: int = 4, degree: int = 24, beam: int = 24, least_recall: float = 0.98, report: dict[int, tuple[float, int]] | None = None) -> DataFrame:
    """One row per input row: vec_id, n_links (other rows linked directly) and component_id (smallest id reachable).

    Equal directions form a class that links within itself and is searched for once. Classes are held in the shards of
    their ``overlap`` nearest centres, centres close to each other taken as one so that a dense group stays together,
    and a large shard is built and searched in pieces. Each graph is built alone, a class's neighbours from all its
    shards are united, and each class is searched for in the shards of its ``probes`` nearest centres over the united
    lists. A link that several shards show counts in the first of them. Every found link is verified by its cosine in
    double precision. Recall is measured by exact counts: on classes drawn whatever was found, and on queries planted
    beside drawn classes at cosines from the threshold up, which are searched for and never held. While it is below
    ``least_recall`` the run is repeated with twice the probes and beam; once all shards are probed, every class is
    compared with all rows of every shard, which is exact. ``report`` gets, by vector width, the recall and the number
    of true links that it rests on.

    Vectors that are null, empty, zero or hold null or non-finite components have no link and are their own component.
    Vectors of different lengths never link. Rows with one id are rows of their own; a null id is carried and names a
    component only if no other id is in it. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    ws, kind = Workspace(spark, "vectors"), width(vectors, vec_col)
    rows = ws.save(units(vectors, id_col, vec_col), "units")
    groups = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"), F.min("vec").alias("vec"))
    classes = ws.save(groups.withColumn("node", F.xxhash64("key", "low")), "classes")
    dims = [r["d"] for r in classes.select(F.length("vec").alias("d")).distinct().collect()]
    found = None
    for d in dims:
        one = _linked(ws, classes.where(F.length("vec") == d), kind, threshold, shard_rows, overlap, probes, degree, beam, least_recall, {} if report is None else report)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    edges = ws.save(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), "edges")
    comp = components(ws, edges)
    n = comp.count()
    low = comp.join(classes.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("component_id"))
    named = comp.join(sized(low, n), "root").select("node", "component_id")
    full = classes.select("key", "low", "n", "node").join(found.where("links >= 0").select("node", "links"), "node").join(sized(named, n), "node", "left")
    full = ws.save(full.select("key", (F.col("links") + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "low").alias("component_id")), "full")
    out = rows.where("key is not null").select("vec_id", "key").join(full, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone)


def _linked(ws: Workspace, classes: DataFrame, kind: str, threshold: float, shard_rows: int, overlap: int, probes: int, degree: int, beam: int, least_recall: float, report: dict[int, tuple[float, int]]) -> DataFrame:
    """(node, links, others, root): what each class of one vector length links to, counted in rows, and edges towards components."""
    n, dim = classes.count(), len(classes.first()["vec"]) // int(kind[1])
    wanted = min(-(-n * overlap // shard_rows), MOST_CENTRES)
    fit_rows = min(max(FIT_ROWS, 4 * wanted), MOST_FIT_ROWS, max(1, MOST_FIT_BYTES // (8 * dim)))
    share = min(1.0, fit_rows / n)
    sample = classes.where(F.pmod(F.xxhash64("node", F.lit(9)), F.lit(1_000_000)) < int(1_000_000 * share)).select("vec").limit(2 * fit_rows).collect()
    k = max(1, min(wanted, len(sample) // 4))
    centre = np.zeros((1, dim))
    if k > 1:
        centre = apart(fitted(_matrix(pa.array([r["vec"] for r in sample], pa.binary()), kind), k), threshold - SLACK)
    nodes = classes.select("node", "vec", "n")
    planted = _planted(nodes, kind, threshold, dim)
    asking = nodes.unionByName(classes.sparkSession.createDataFrame([(r["node"], r["vec"], 0) for r in planted], nodes.schema)) if planted else nodes
    overlap = min(overlap, len(centre))
    united = _graphs(ws, nodes, centre, kind, overlap, degree, 2 * shard_rows)
    exact = False
    while True:
        probes = min(max(probes, overlap), len(centre))
        found = _searched(ws, asking, united, centre, kind, overlap, probes, threshold, beam, 2 * shard_rows, exact)
        if exact:
            report[dim] = (1.0, 0)
        else:
            report[dim] = _recall(nodes, kind, found, threshold, n, planted)
            log.info("recall %.4f on %d links with %d shards, each vector in %d and sought in %d", *report[dim], len(centre), overlap, probes)
        if exact or report[dim][0] >= least_recall:
            ws.drop(united)
            return found
        ws.drop(found)
        exact = probes == len(centre) and beam > 2 * shard_rows
        probes, beam = 2 * probes, 2 * beam


def _planted(nodes: DataFrame, kind: str, threshold: float, dim: int) -> list[dict]:
    """Queries beside PLANTED drawn classes, at cosines spread from the threshold to 1, in random directions; none in one dimension."""
    if dim < 2:
        return []
    drawn = nodes.orderBy(F.xxhash64("node", F.lit(13)), "node").limit(PLANTED).select("vec").collect()
    rng, x = np.random.default_rng(17), _matrix(pa.array([r["vec"] for r in drawn], pa.binary()), kind)
    w = rng.normal(size=x.shape)
    w -= (w * x).sum(axis=1, keepdims=True) * x
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    c = rng.uniform(threshold + 0.001, 1, (len(x), 1))
    y = (c * x + np.sqrt(1 - c * c) * w).astype(kind)
    return [{"node": int(np.uint64(xxhash.xxh64_intdigest(f"planted {k}")).astype(np.int64)), "vec": bytes(v.tobytes())} for k, v in enumerate(y)]


def _pieces(shard_rows: str, most: int) -> F.Column:
    return F.greatest(F.lit(1), F.ceil(F.col(shard_rows) / most)).cast("int")


def _piece(pieces: str) -> F.Column:
    return F.pmod(F.xxhash64("node", F.lit(7)), F.col(pieces).cast("long")).cast("int")


def _shards(nodes: DataFrame, centre: np.ndarray, kind: str, overlap: int, probes: int, most: int) -> DataFrame:
    """(s, graphs, queries): into how many pieces each shard's rows and the queries for it are cut, so that a task's rows are bounded whatever the size of a group."""
    held = deal(nodes.select("vec", "n"), centre, probes, kind).groupBy(F.col("shard").alias("s")).agg(F.sum(((F.col("rank") < overlap) & (F.col("n") > 0)).cast("long")).alias("rows"), F.count(F.lit(1)).alias("asked"))
    return F.broadcast(held.select("s", _pieces("rows", most).alias("graphs"), _pieces("asked", 2 * most).alias("queries")))  # at most MOST_CENTRES rows


def _graphs(ws: Workspace, nodes: DataFrame, centre: np.ndarray, kind: str, overlap: int, degree: int, most: int) -> DataFrame:
    """(node, next): each node's neighbours, united from the graphs of all shards that hold it."""

    def build(t: pa.Table) -> pa.Table:
        node = t["node"].to_numpy()
        order = np.argsort(node)
        node, x = node[order], _matrix(t["vec"], kind)[order]
        lists = [node[r[r >= 0]].tolist() for r in prune(x, degree)]
        return pa.table([pa.array(node), pa.array(lists, pa.list_(pa.int64()))], names=["node", "next"])

    shards = _shards(nodes, centre, kind, overlap, overlap, most)
    placed = deal(nodes.select("node", "vec"), centre, overlap, kind).join(shards, F.col("shard") == F.col("s")).select("shard", _piece("graphs").alias("piece"), "node", "vec")
    lists = placed.groupBy("shard", "piece").applyInArrow(build, "node long, next array<long>")
    return ws.save(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("next")), "graph")  # at most overlap x degree


def _met_before(near_q: np.ndarray, rank: np.ndarray, near_v: np.ndarray) -> np.ndarray:
    """Whether the query of each pair was sought in a nearer shard that holds the row too."""
    out = np.zeros(len(rank), bool)
    for r in range(int(rank.max(initial=0))):
        out |= (rank > r) & (near_q[:, r, None] == near_v).any(axis=1)
    return out


def _searched(ws: Workspace, nodes: DataFrame, united: DataFrame, centre: np.ndarray, kind: str, overlap: int, probes: int, threshold: float, beam: int, most: int, exact: bool = False) -> DataFrame:
    """(node, links, others, root): each node's links within the shards it is sought in, counted in rows and in nodes, and rows with links -1 that are edges towards components.

    Each piece of a shard has a graph of its own and the shard's queries are searched for in each, a cell of query piece
    and graph piece a task; ``exact`` compares a cell's queries with all its rows. Nodes that stand for no row (n is 0)
    are searched for only: no graph holds them and no edge is theirs.
    """

    def look(t: pa.Table) -> pa.Table:
        order = np.argsort(t["node"].to_numpy(), kind="stable")
        t = t.take(pa.array(order))
        node, x, weight, rank = t["node"].to_numpy(), _matrix(t["vec"], kind), t["n"].to_numpy(), t["rank"].to_numpy()
        near = np.frombuffer(b"".join(t["near"].to_pylist()), np.int32).reshape(len(node), -1)
        ask, data = (np.flatnonzero(t[c].to_numpy()) for c in ("ask", "data"))
        inner = node[data]
        lists = t["next"].take(pa.array(data)).combine_chunks()
        to, of = lists.flatten().to_numpy(), np.repeat(np.arange(len(data)), np.diff(lists.offsets.to_numpy()))
        at = np.minimum(np.searchsorted(inner, to), len(data) - 1)
        inside = inner[at] == to if len(data) else np.zeros(0, bool)
        graph = Graph(of[inside], at[inside], max(1, len(data)))
        own = np.full(len(node), -1)
        own[data] = np.arange(len(data))
        links, others, parent = np.zeros(len(ask), np.int64), np.zeros(len(ask), np.int64), np.arange(len(node))
        hits = compared(x[data], x[ask], own[ask], threshold) if exact else search(x[data], graph, x[ask], own[ask], threshold, beam)
        for q, v in hits:
            for p in range(0, len(q), SPREAD // 8):
                i, j = q[p : p + SPREAD // 8], data[v[p : p + SPREAD // 8]]
                new = ~_met_before(near[ask[i]], rank[ask[i]], near[j, :overlap])
                np.add.at(links, i[new], weight[j[new]])
                others += np.bincount(i[new], minlength=len(ask))
                new &= weight[ask[i]] > 0
                unite(parent, ask[i[new]], j[new])
        joined = np.flatnonzero(parent != np.arange(len(node)))
        mark = np.full(len(joined), -1)
        return pa.table(
            [pa.array(node[np.concatenate([ask, joined])]), pa.array(np.concatenate([links, mark])), pa.array(np.concatenate([others, mark])), pa.array(node[np.concatenate([ask, parent[joined]])])],
            names=["node", "links", "others", "root"],
        )

    shards = _shards(nodes, centre, kind, overlap, probes, most)
    ready = deal(nodes.join(united, "node", "left").withColumn("next", F.coalesce("next", F.array().cast("array<long>"))), centre, probes, kind).join(shards, F.col("shard") == F.col("s"))
    ready = ready.withColumns({"g": _piece("graphs"), "q": _piece("queries"), "held": (F.col("rank") < overlap) & (F.col("n") > 0)})
    cell = lambda q, g, ask, data: F.struct(q.alias("query_piece"), g.alias("graph_piece"), ask.alias("ask"), data.alias("data"))
    asks = F.transform(F.sequence(F.lit(0), F.col("graphs") - 1), lambda g: cell(F.col("q"), g, F.lit(True), F.col("held") & (g == F.col("g"))))
    other = F.filter(F.sequence(F.lit(0), F.col("queries") - 1), lambda q: F.col("held") & (q != F.col("q")))
    cells = ready.withColumn("c", F.explode(F.concat(asks, F.transform(other, lambda q: cell(q, F.col("g"), F.lit(False), F.lit(True))))))
    cells = cells.select("shard", "c.*", "rank", "near", "node", "vec", "n", F.when(F.col("c.data"), F.col("next")).alias("next"))
    raw = ws.save(cells.groupBy("shard", "query_piece", "graph_piece").applyInArrow(look, "node long, links long, others long, root long"), "raw")
    total = raw.where("links >= 0").groupBy("node").agg(F.sum("links").alias("links"), F.sum("others").alias("others"))
    found = ws.save(total.select("node", "links", "others", F.col("node").alias("root")).unionByName(raw.where("links < 0")), "found")
    ws.drop(raw)
    return found


def _recall(nodes: DataFrame, kind: str, found: DataFrame, threshold: float, n: int, planted: list[dict] = ()) -> tuple[float, int]:
    """(share of true links found, on how many it rests), by a seeded sample of classes that were compared with all: the lower of the mean over linked classes and the share of all their links.

    Classes are drawn whatever was found for them, step by step until AUDIT_ROWS of them have a true link, and links
    count once whatever copies they stand for. Planted queries are counted apart; the lower share of both counts.
    """
    sides = []
    order = F.pmod(F.xxhash64("node", F.lit(4)), F.lit(1_000_000_000))
    step = max(1, int(1_000_000_000 * min(1.0, AUDIT_STEP / n)))
    got, true = [], []

    def count(asked: list) -> None:
        pairs = _exact(nodes, kind, asked, threshold).join(found.where("links >= 0").select("node", "others"), "node", "left").select(F.col("true"), F.coalesce("others", F.lit(0))).collect()
        true.extend(t for t, _ in pairs)
        got.extend(g for _, g in pairs)

    def side() -> None:
        if true:
            sides.append((min(sum(got) / sum(true), sum(g / t for g, t in zip(got, true)) / len(true)), sum(true)))

    for at in range(0, min(1_000_000_000, step * AUDIT_STEPS), step):
        if asked := nodes.where((order >= at) & (order < at + step)).select("node", "vec").collect():
            count(asked)
        if len(true) >= AUDIT_ROWS:
            break
    side()
    if planted:
        got, true = [], []
        count(planted)
        side()
    return (min(r for r, _ in sides), sum(t for _, t in sides)) if sides else (1.0, 0)


def _exact(nodes: DataFrame, kind: str, asked: list, threshold: float) -> DataFrame:
    """(node, true): other classes that each of ``asked`` links to, of those that have any."""
    ids = np.array([r["node"] for r in asked])
    x = _matrix(pa.array([r["vec"] for r in asked], pa.binary()), kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                s = _matrix(part.column(1), kind) @ x.T >= threshold
                s &= part.column(0).to_numpy()[:, None] != ids
                total += s.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["node", "true"])

    return F.broadcast(nodes.select("node", "vec").mapInArrow(count, "node long, true long").groupBy("node").agg(F.sum("true").alias("true")).where(F.col("true") > 0))
