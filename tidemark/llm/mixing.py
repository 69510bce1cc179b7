"""Mixing overlapping sources to target weights: a min-cost flow over membership patterns, then seeded documents."""

from __future__ import annotations

from collections import defaultdict, deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, Workspace, running, sized

#: Membership patterns that the driver plans with. A pattern is a set of source names, so their number follows the
#: sources, not the documents.
MOST_PATTERNS = 50_000
#: A pattern's seeded order is cut into parts of about so many rows of the corpus, and 1,024 at least; the order within
#: one part is settled document by document.
PART_ROWS, LEAST_PARTS = 5_000, 1024
#: Rounds that fill what is left before the first document too large for it.
FILLS = 3

Pattern = tuple[str | None, ...]


def words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(source: str | None) -> tuple:
    return (source is None, source or "")


def targets(sizes: dict[str | None, int], total: float, weights: tuple[float, ...] = (5, 2, 1), most: float = 3) -> dict[str | None, float]:
    """What each source shall give: ``total`` shared by weight, repeating over the sources in code point order, null last.

    A share over ``most`` times its source's size stops there, and the excess goes to the others by weight, again and
    again until none is above.
    """
    names = sorted(sizes, key=order_key)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out: dict[str | None, float] = {}
    open_, rest = list(names), float(total)
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not over:
            return out | {s: unit * weight[s] for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
            rest -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def route(capacity: dict[Pattern, int], quota: dict[str | None, int], costs: tuple[int, ...] = (0, 1, 3)) -> dict[tuple[Pattern, str | None], int]:
    """Min-cost flow from patterns to the quotas of their sources, by successive shortest augmenting paths.

    Level k of a pattern holds its size once more at cost ``costs[k]``; rising costs make the flow repeat all that it
    may take once before anything a second time. Patterns and sources that share nothing are solved apart.
    """
    group: dict = {}

    def find(x):
        while group.setdefault(x, x) != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    for p in capacity:
        for s in p:
            group[find(("s", s))] = find(("p", p))
    parts = defaultdict(list)
    for p in sorted(capacity, key=lambda p: [order_key(s) for s in p]):
        parts[find(("p", p))].append(p)
    flow: dict[tuple[Pattern, str | None], int] = {}
    for held in parts.values():
        flow |= _route(held, capacity, quota, costs)
    return flow


def _route(patterns: list[Pattern], capacity, quota, costs) -> dict[tuple[Pattern, str | None], int]:
    sources = sorted({s for p in patterns for s in p}, key=order_key)
    if len(patterns) == len(sources) == 1:
        return {(patterns[0], sources[0]): min(quota[sources[0]], len(costs) * capacity[patterns[0]])}
    node = {("in",): 0, ("out",): 1} | {("p", p): 2 + k for k, p in enumerate(patterns)} | {("s", s): 2 + len(patterns) + k for k, s in enumerate(sources)}
    to, room, cost, arcs = [], [], [], defaultdict(list)

    def arc(a: int, b: int, c: int, w: int) -> int:
        for x, y, r, v in ((a, b, c, w), (b, a, 0, -w)):
            arcs[x].append(len(to))
            to.append(y), room.append(r), cost.append(v)
        return len(to) - 2

    for p in patterns:
        for w in costs:
            arc(0, node["p", p], capacity[p], w)
    carried = {(p, s): arc(node["p", p], node["s", s], len(costs) * capacity[p], 0) for p in patterns for s in p}
    for s in sources:
        arc(node["s", s], 1, quota[s], 0)
    while True:
        far, via, queue, queued = {0: 0}, {}, deque([0]), {0}
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for k in arcs[x]:
                if room[k] and far[x] + cost[k] < far.get(to[k], 1 << 60):
                    far[to[k]], via[to[k]] = far[x] + cost[k], k
                    if to[k] not in queued:
                        queue.append(to[k])
                        queued.add(to[k])
        if 1 not in far:
            return {x: room[k ^ 1] for x, k in carried.items()}
        path, x = [], 1
        while x:
            path.append(via[x])
            x = to[via[x] ^ 1]
        most = min(room[k] for k in path)
        for k in path:
            room[k] -= most
            room[k ^ 1] += most


@dataclass
class Mix:
    """``report``: by source, its size, target and routed words. ``attach`` gives each row its number of copies."""

    report: dict[str | None, tuple[int, float, int]]
    plan: DataFrame  # pattern, whole copies, part up to which one more is taken
    chosen: DataFrame  # rows of the part that the cut falls in, and fills
    n_chosen: int
    seed: int
    parts: int

    def attach(self, docs: DataFrame, size: Column, members: Column, id_col: str = "doc_id", out_col: str = "copies") -> DataFrame:
        """``docs`` with ``out_col``, how often the mix takes each row, in place of a column of that name.

        No shuffle of the documents unless very many rows are settled one by one. ``size`` and ``members`` are what the
        mix was planned with: a null or empty membership is the source null, null ids are one id, rows that repeat in
        id, size and membership are taken alike, and a row that the plan doesn't know is taken 0 times.
        """
        named = docs.withColumns({"__size": size, "__pattern": _pattern(members), "__id": _id(id_col)})
        named = named.withColumn("__hash", _hash("__id", self.seed))
        named = named.join(F.broadcast(self.plan), named["__pattern"] == self.plan["__plan"], "left")
        more = self.chosen.select(F.col("id").alias("__cid"), F.col("size").alias("__csize"), F.col("pattern").alias("__cpattern"), F.lit(1).alias("__more"))
        on = (named["__id"] == more["__cid"]) & (named["__size"] == more["__csize"]) & (named["__pattern"] == more["__cpattern"])
        named = named.join(sized(more, self.n_chosen), on, "left")
        copies = F.col("__base") + F.when(F.col("__more").isNotNull() | (_part("__hash", self.parts) < F.col("__cut")), 1).otherwise(0)
        taken = F.coalesce(copies, F.lit(0)).cast("long").alias("__taken")
        return named.select(*[named[c] for c in docs.columns if c != out_col], taken).withColumnRenamed("__taken", out_col)


def _pattern(members: Column) -> Column:
    """A set of sources as one string: sorted, each marked as a name or as null, with its length before it; no or an empty set is that of null."""
    some = F.when(F.size(members) > 0, members)
    names = F.array_sort(F.array_distinct(F.coalesce(some, F.array(F.lit(None).cast("string")))))
    return F.array_join(F.transform(names, lambda s: F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.char_length(s), F.lit(":"), s))), ",")


def _hash(c: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(c))


def _id(c: str) -> Column:
    return F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 63)))


def _part(c: str, parts: int) -> Column:
    return F.pmod(F.col(c), F.lit(parts)).cast("int")


def mix(docs: DataFrame, size: Column, members: Column, id_col: str = "doc_id", weights: tuple[float, ...] = (5, 2, 1), most: int = 3, share: float = 1.0, seed: int = 7) -> Mix:
    """Plan a mix of ``share`` times all words of ``docs``; ``members`` is each row's array of source names.

    Every document of a pattern is taken equally often, as often as the pattern's routed words allow whole; the rest
    goes to documents in a seeded order until the next one is too large, and then to the largest that still fit. Rows
    with the same id, size and sources are taken together. A null or empty membership is the source null; a null text
    has size 0; an empty table mixes to nothing. Which documents are taken depends on the seed and the ids alone.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "mixing")
    row = docs.select(_id(id_col).alias("id"), size.alias("size"), members.alias("members"))
    row = row.withColumn("pattern", _pattern(F.col("members")))
    rows = ws.save(row.groupBy("pattern", "id", "size").agg((F.col("size") * F.count(F.lit(1))).alias("words"), F.any_value("members").alias("members")), "rows")
    found = rows.groupBy("pattern").agg(F.sum("words").alias("words"), F.any_value("members").alias("members")).limit(MOST_PATTERNS + 1).collect()
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns: give fewer sources")
    capacity: dict[Pattern, int] = {}
    name: dict[Pattern, str] = {}
    for r in found:
        p = tuple(sorted(set(r["members"] or [None]), key=order_key))
        capacity[p], name[p] = r["words"], r["pattern"]
    sizes: dict[str | None, int] = defaultdict(int)
    for p, n in capacity.items():
        for s in p:
            sizes[s] += n
    goal = targets(sizes, share * sum(capacity.values()), weights, most)
    flow = route(capacity, {s: round(t) for s, t in goal.items()}, tuple(k * (k + 1) // 2 for k in range(most)))
    routed: dict[Pattern, int] = defaultdict(int)
    by_source: dict[str | None, int] = defaultdict(int)
    for (p, s), n in flow.items():
        routed[p] += n
        by_source[s] += n

    base = {p: (routed[p] // n if n else 0) for p, n in capacity.items()}
    left = [(name[p], base[p], routed[p] - base[p] * n) for p, n in capacity.items()]
    wanted = spark.createDataFrame(left, "pattern string, base int, rest long")
    parts = max(LEAST_PARTS, -(-rows.count() // PART_ROWS))
    h = rows.withColumn("hash", _hash("id", seed)).withColumn("part", _part("hash", parts))
    sums = h.groupBy("pattern", "part").agg(F.sum("words").alias("words"))
    cut = running(sums, ["pattern"], "part", "words", "before").withColumn("total", F.col("before") + F.col("words")).join(F.broadcast(wanted), "pattern")
    cut = cut.where(F.col("total") > F.col("rest")).groupBy("pattern").agg(F.min("part").alias("cut"), F.min_by(F.col("total") - F.col("words"), "part").alias("before"))
    cuts = {r["pattern"]: (r["cut"], r["before"]) for r in cut.collect()}
    state = [(q, b, *cuts.get(q, (parts, 0)), r) for q, b, r in left]
    cut_at = spark.createDataFrame([(q, c, r - x) for q, _, c, x, r in state if c < parts], "pattern string, cut int, gap long")
    edge = h.join(F.broadcast(cut_at), "pattern").where("part = cut")
    so_far = Window.partitionBy("pattern").orderBy("hash", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    chosen = ws.save(edge.withColumn("run", F.sum("words").over(so_far)).where("run <= gap").select("pattern", "id", "size", "words"), "chosen")
    gaps = {q: r - x for q, _, c, x, r in state if c < parts}
    for r in chosen.groupBy("pattern").agg(F.sum("words").alias("n")).collect():
        gaps[r["pattern"]] -= r["n"]
    fills: list[tuple] = []
    for _ in range(FILLS):
        gaps = {q: g for q, g in gaps.items() if g > 0}
        if not gaps:
            break
        open_ = spark.createDataFrame([(q, g, cuts[q][0]) for q, g in gaps.items()], "pattern string, gap long, cut int")
        free = h.join(F.broadcast(open_), "pattern").where("part >= cut and words > 0 and words < 2 * gap")
        free = free.join(sized(chosen.drop("words"), chosen.count()), ["pattern", "id", "size"], "left_anti")
        if fills:
            free = free.join(F.broadcast(spark.createDataFrame([f[:3] for f in fills], "pattern string, id long, size long")), ["pattern", "id", "size"], "left_anti")
        best = free.groupBy("pattern").agg(F.min_by(F.struct("id", "size", "words"), F.struct(F.abs(F.col("gap") - F.col("words")), "hash", "id", "size")).alias("x")).select("pattern", "x.*").collect()
        if not best:
            break
        fills += [(r["pattern"], r["id"], r["size"], r["words"]) for r in best]
        for r in best:
            gaps[r["pattern"]] -= r["words"]
        gaps = {r["pattern"]: gaps[r["pattern"]] for r in best}
    if fills:
        chosen = chosen.union(spark.createDataFrame(fills, "pattern string, id long, size long, words long"))
    plan = spark.createDataFrame([(q, b, c if r else 0) for q, b, c, _, r in state], "__plan string, __base int, __cut int")
    report = {s: (sizes[s], goal[s], by_source[s]) for s in sorted(sizes, key=order_key)}
    return Mix(report, plan, chosen, chosen.count(), seed, parts)
