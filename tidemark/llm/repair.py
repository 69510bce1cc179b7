"""Conversation repair: an input acceptor, an edit transducer and a role grammar, composed lazily; the shortest path is the repair.

Weights are (cost, string of edit labels), the lesser cost first and of equal costs the string that is less in ASCII.
A state of the composition is (rows read, grammar state). Inserts read no row; a filter lets them go right before a row
that stays or the end alone, since deleting first costs the same and is less in ASCII. So the composition has no cycle,
rows in order are a topological order, and only the states after the present row are held, each with its best weight.
What all their strings begin with is settled and goes out: a task holds a conversation's undecided rows only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Acceptor of role initials, ``(s?(ua)+)?``: state to the initials that it takes and the states after them.
GRAMMAR: dict[str, dict[str, str]] = {"begin": {"s": "system", "u": "user"}, "system": {"u": "user"}, "user": {"a": "turn"}, "turn": {"u": "user"}}
FINAL = ("begin", "turn")
ROLE = {"u": "user", "a": "assistant"}
#: Adjacent role initials that need no remark.
LEGAL = ("su", "ua", "au")

DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
TRUNCATED = 3
#: Whatever is cheapest after one grammar state costs at most so much more after another: one insert to get in step, and the deletion of a system row.
SLACK = COST[INSERT] + COST[DELETE]

_SPACE = " \t\n\v\f\r"

Weight = tuple[int, str]


@dataclass(frozen=True)
class Row:
    turn: int | None
    role: str
    text: str
    fault: str | None


@dataclass(frozen=True)
class Edit:
    """One label of the path: ``role`` and ``text`` as repaired, null where deleted; the row's own turn, role and fault, null where inserted."""

    label: str
    cost: int
    role: str | None
    text: str | None
    row: Row | None


def fault(role: str, text: str, seen: set[bytes]) -> str | None:
    """A row's first fault: blank, duplicate of a role and text in ``seen``, or truncated; its digest joins ``seen``."""
    digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
    again = digest in seen
    seen.add(digest)
    words = text.rstrip(_SPACE)
    return "blank" if not words else "duplicate" if again else None if words[-1] in ".!?" else "truncated"


def written(grammar: str) -> tuple[str, str]:
    """The one initial that an edit can write in a grammar state, and the state after it."""
    return next((i, after) for i, after in GRAMMAR[grammar].items() if i in ROLE)


def inserts(grammar: str) -> Iterator[tuple[int, str]]:
    """Numbers of inserts and the grammar states that they lead to, each new state once, with no insert first."""
    met: list[str] = []
    while grammar not in met:
        yield len(met), grammar
        met.append(grammar)
        _, grammar = written(grammar)


def arcs(grammar: str, row: Row) -> Iterator[tuple[str, int, str]]:
    """The composition's paths over one row that may stay, made when a path gets there: labels, cost and the next grammar state.

    From a state, labels lead to one state only, as the grammar takes no two of the roles that an edit can write.
    """
    yield DELETE, COST[DELETE], grammar
    more = TRUNCATED if row.fault else 0
    for n, state in inserts(grammar):
        if row.role[:1] in GRAMMAR[state]:
            yield INSERT * n + KEEP, n * COST[INSERT] + COST[KEEP] + more, GRAMMAR[state][row.role[:1]]
        yield INSERT * n + REROLE, n * COST[INSERT] + COST[REROLE] + more, written(state)[1]


def _relax(best: dict[str, Weight], state: str, weight: Weight) -> None:
    if state not in best or weight < best[state]:
        best[state] = weight


@dataclass
class Path:
    """The shortest paths over the rows so far, up to the edits that all of them share."""

    best: dict[str, Weight] = field(default_factory=lambda: {"begin": (0, "")})
    settled: str = "begin"
    waiting: list[Row] = field(default_factory=list)
    gone: int = 0  # the last rows, which every path deletes

    def read(self, row: Row) -> list[Edit]:
        """Go over one row; what is settled by it."""
        if row.fault in ("blank", "duplicate"):
            self.waiting.append(replace(row, text=""))
            self.gone += 1
        else:
            self._catch_up()
            self.waiting.append(row)
            best: dict[str, Weight] = {}
            for grammar, (cost, labels) in self.best.items():
                for more, price, after in arcs(grammar, row):
                    _relax(best, after, (cost + price, labels + more))  # all end in a row's label: none begins another
            least = min(cost for cost, _ in best.values())
            self.best = {g: w for g, w in best.items() if w[0] <= least + SLACK}
        if self.gone and len(self.best) > 1:
            return []
        self._catch_up()
        low, high = min(w[1] for w in self.best.values()), max(w[1] for w in self.best.values())
        n = next((k for k, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        return self._settle(low[:n]) if n else []

    def finish(self) -> list[Edit]:
        """The rest of the path with the least weight that ends in a final state."""
        self._catch_up()
        ends = [(cost + n * COST[INSERT], labels + INSERT * n) for g, (cost, labels) in self.best.items() for n, state in inserts(g) if state in FINAL]
        return self._settle(min(ends)[1])

    def _catch_up(self) -> None:
        if self.gone:
            self.best = {g: (cost + self.gone * COST[DELETE], labels + DELETE * self.gone) for g, (cost, labels) in self.best.items()}
            self.gone = 0

    def _settle(self, labels: str) -> list[Edit]:
        out, at = [], 0
        for label in labels:
            row, more = None, 0
            if label != INSERT:
                row = self.waiting[at]
                at += 1
                more = TRUNCATED if row.fault == "truncated" and label != DELETE else 0
            if label == DELETE:
                out.append(Edit(label, COST[label], None, None, row))
                continue
            initial = row.role[:1] if label == KEEP else written(self.settled)[0]
            out.append(Edit(label, COST[label] + more, row.role if label == KEEP else ROLE[initial], row.text if row else "", row))
            self.settled = GRAMMAR[self.settled][initial]
        del self.waiting[:at]
        self.best = {g: (cost, w[len(labels) :]) for g, (cost, w) in self.best.items()}
        return out


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) as the damage leaves the rows, by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties the text, 2 removes ``.``, ``!`` and ``?``, 3 repeats the row, 4 makes it a user's. A null
    role or text, and a null id or turn inside the hashed string, is one space. Other columns are not read; an empty
    table gives none.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    rows = rows.withColumn("d", F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(20)))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(F.col("d") == 4, "user").otherwise(F.col("role"))})
    rows = rows.where("d <> 0").withColumn("copy", F.explode(F.when(F.col("d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select("conv_id", "turn", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Conversations in order, each with an iterator over its rows that has to be used up before the next."""

    def rows() -> Iterator[tuple]:
        for b in batches:
            for k in range(0, b.num_rows, 1024):  # rows become Python values a few at a time
                yield from zip(*(c.to_pylist() for c in b.slice(k, 1024).columns))

    stream = rows()
    held = next(stream, None)

    def one(conv: int | None) -> Iterator[tuple]:
        nonlocal held
        while held is not None and held[0] == conv:
            now, held = held, next(stream, None)
            yield now

    while held is not None:
        conv = held[0]
        yield conv, one(conv)


def _edits(rows: Iterator[tuple]) -> Iterator[Edit]:
    """The edits of one conversation from its rows (conv_id, turn, role, text) in order."""
    seen: set[bytes] = set()
    path = Path()
    for _, turn, role, text in rows:
        yield from path.read(Row(turn, role, text, fault(role, text, seen)))
    yield from path.finish()


def _ordered(rows: DataFrame) -> DataFrame:
    """One conversation's rows after another, by turn (nulls first), then role and text."""
    by = ["conv_id", "turn", "role", "text"]
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    return rows.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in by])


LOG = "conv_id long, place long, edit string, cost int, fault string, turn long, was string, role string, text string"


def edit_log(conversations: DataFrame) -> DataFrame:
    """Every edit of every conversation in order: conv_id, place from 0, edit (K, R, D or I), cost, the row's fault, turn and role before, role and text after.

    Rows without a deleted ``role`` are the repaired conversation. ``conversations`` has conv_id, turn, role and text,
    other columns are not read. Rows come by turn (nulls first, ties by role and text). A null role or text is one space;
    rows of a null id are one conversation; a repeated row is a duplicate; a role whose initial the grammar doesn't know,
    or an empty one, can't be kept; an empty table gives none. One task reads a conversation from
    first to last and holds a 16-byte digest of each of its rows, the undecided rows and one batch.
    """
    names = [c.split()[0] for c in LOG.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for conv, rows in _conversations(batches):
            for place, e in enumerate(_edits(rows)):
                r = e.row
                out.append((conv, place, e.label, e.cost, r and r.fault, r and r.turn, r and r.role, e.role, e.text))
                size += 100 + len(e.text or "")
                if size > 4_000_000:
                    yield batch(out)
                    out, size = [], 0
        if out:
            yield batch(out)

    return _ordered(conversations).mapInArrow(run, LOG)


SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def summaries(log: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per conversation of ``ids`` (conv_id), from its edit log: gaps in turns, faults, illegal neighbours, cost, audit and digest of the repaired lines.

    ``log`` is what ``edit_log`` gives, in its order and dealing: the digest goes over it as it comes, so no task holds a
    conversation. A conversation without rows has zeros, an empty audit and the digest of nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, edits in _conversations(batches):
            faults = {"blank": 0, "duplicate": 0, "truncated": 0}
            total = illegal = distinct = 0
            low = high = before = None
            audit, digest, first = [], hashlib.sha256(), True
            for _, _, label, cost, found, turn, was, role, text in edits:
                audit.append(label)
                total += cost
                if found:
                    faults[found] += 1
                if label != INSERT:
                    if before is not None and before[:1] + was[:1] not in LEGAL:
                        illegal += 1
                    before = was
                    if turn is not None and turn != high:  # in order of turns
                        low, high, distinct = turn if low is None else low, turn, distinct + 1
                if label != DELETE:
                    digest.update(b"" if first else b"\n")
                    digest.update(f"{role}:{text}".encode("utf-8", "replace"))
                    first = False
            out.append((conv, high - low + 1 - distinct if distinct else 0, *faults.values(), illegal, total, "".join(audit), digest.hexdigest()))
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)

    names = [c.split()[0] for c in SUMMARY.split(", ")]
    schema = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names])
    # A conversation of which nothing is left has no edits: it comes from the ids.
    found = log.mapInArrow(run, SUMMARY)
    nothing = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    both = found.unionByName(ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select("conv_id", *[v.alias(c) for c, v in nothing.items()]))
    # With edits, the audit isn't empty, so the greater of both rows is the one of the log.
    names_only = [c for c in names if c not in ("conv_id", "audit")]
    best = F.max(F.struct("audit", *names_only))
    return both.groupBy("conv_id").agg(best.alias("x")).select("conv_id", *[F.col(f"x.{c}") for c in names[1:]])
