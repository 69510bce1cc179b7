"""Toxicity: a weighted finite-state grammar over clauses, with terminals and path weights learned from labels."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, keep_rows, sized, utf8

#: Labelled rows that a fit looks at, at most, by hash of their id; the parameter ``sample`` overrides it.
SAMPLE = 20_000
#: Words longer than this keep their first so many letters as a form of their own.
STEMS = (5, 7)
#: Characters on either side of a word that tell its place from others.
BESIDE = 12

# Closed word classes of the grammar, in English, German, French and Spanish.
ADDRESSED = set("you your yours u du dich dir dein deine ihr euch tu te toi ton vous votre tú ti usted ustedes".split())
PERSONS = set("he him his she her they them their sie er il elle ils elles ellos él ella".split())
JOINING = set("the a an this that these those is are was were der die das den dem des ein eine einen einer einem ist sind le la les un une ce cette des est sont el los las una esta este es son such so nothing but".split())
NEGATION = set("not no never nor without isn aren wasn weren don doesn didn nicht kein keine keinen nie ne pas jamais sin nunca".split())
REPORT = set("said says say saying called calls wrote quoted quote quotes claims claimed alleged reported sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó".split()) | set('"“”«»„')
INTENT = set("will gonna going shall ll must should werde werden wirst vais va allons voy vamos".split())
VIOLENCE = set("kill hurt destroy beat stab shoot burn punch hang strangle murder töten schlagen verprügeln umbringen tuer frapper matar golpear".split())
CLASSES = {"y": ADDRESSED, "q": PERSONS, "p": JOINING, "n": NEGATION, "r": REPORT, "w": INTENT, "v": VIOLENCE}

TOKEN = re.compile(r"[^\W\d_]+|[\"“”«»„]")
WORDS = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n|]+")
#: What a path through the composed transducers makes of an insult in its clause; an insult on no such path counts nothing.
KINDS = ("targeted", "addressed", "heaped", "spread", "negated", "reported", "threat")
#: What each kind's matched clauses weigh before labels say more.
PRIOR = (1.2, 1.0, 1.0, 0.8, 0.5, 0.4, 3.2)


#: By how much, in log odds, one insult of middling weight at a person passes the limit, and a single threat where labels show none.
MARGIN = 1.0


class Lexicon:
    """A letter transducer with weighted arcs: reads a word and gives its symbol and weight.

    Words of the closed classes give their class. A learned form gives ``i`` with the weight on its last arc; a stem's
    last arc leads to a state that takes any further letters. Of several paths the whole word's wins, then the longest stem's.
    """

    def __init__(self, terminals: dict[str, float]):
        self.root: dict = {}
        for c, words in CLASSES.items():
            for w in words:
                self._state(w)["word"] = (c, 0.0)
        for form, weight in terminals.items():
            stem = form.endswith("*")
            self._state(form.removesuffix("*")).setdefault("stem" if stem else "word", ("i", weight))
        self.known: dict[str, tuple[str, float]] = {}

    def _state(self, word: str) -> dict:
        at = self.root
        for letter in word:
            at = at.setdefault(letter, {})
        return at

    def __getstate__(self):
        return {"root": self.root, "known": {}}

    def read(self, word: str) -> tuple[str, float]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 200_000:
                self.known.clear()
            found = self.known[word] = self._read(word)
        return found

    def _read(self, word: str) -> tuple[str, float]:
        at, best = self.root, ("o", 0.0)
        for letter in word:
            best = at.get("stem", best)
            at = at.get(letter)
            if at is None:
                return best
        return at.get("word", best)


@dataclass(frozen=True)
class Transducer:
    """Deterministic: ``arcs[state][symbol] = (output, next state)``; a missing symbol passes through by ``others``."""

    arcs: tuple[dict[str, tuple[str, int]], ...]
    others: tuple[int, ...]

    def step(self, state: int, symbol: str) -> tuple[str, int]:
        return self.arcs[state].get(symbol) or (symbol, self.others[state])


def _scope(opener: str, marks: dict[str, str], reach: int | None) -> Transducer:
    """After ``opener`` and for ``reach`` tokens (None: to the clause's end), symbols turn into their marked form."""
    n = reach or 1
    inside = {a: (b, n if reach is None else 0) for a, b in marks.items()}
    arcs: list[dict] = [{opener: (opener, n)}]
    for left in range(1, n + 1):
        back = n if reach is None else left - 1
        arcs.append({a: (b, back) for a, (b, _) in inside.items()} | {opener: (opener, n)})
    return Transducer(tuple(arcs), tuple(0 if k == 0 else (n if reach is None else k - 1) for k in range(n + 1)))


#: i: insult; y: who is addressed, q: another person, p: an article, pronoun or copula; n: negation, r: report, w: intent,
#: v: violence, o: other. Marked insults: j targeted, d addressed, h heaped, k negated, l reported; x: threat.
NEGATED = _scope("n", {"i": "k", "v": "o"}, 3)
REPORTED = _scope("r", {"i": "l", "k": "l", "v": "o"}, None)
#: Whoever is addressed takes insults within so many tokens; another person those that articles and copulas alone join to it.
_REACH = 4
#: An insult that no path has taken yet; i0 is one with nothing but insults before it in its clause.
_OPEN = ("i", "i0")
_JOINED = 2 * _REACH
TARGETED = Transducer(
    (
        {"y": ("y", _REACH), "x": ("x", _REACH), "q": ("q", _JOINED)},
        *({"y": ("y", _REACH), "x": ("x", _REACH)} | {i: ("j", k) for i in _OPEN} for k in range(1, _REACH + 1)),
        *({"y": ("y", _REACH), "x": ("x", _REACH), "q": ("q", _JOINED), "p": ("p", k - 1 if k > _REACH + 1 else 0)} | {i: ("j", _JOINED) for i in _OPEN} for k in range(_REACH + 1, _JOINED + 1)),
    ),
    (0, *range(_REACH), *[0] * _REACH),
)
HEAPED = Transducer(({i: (i, 1) for i in (*_OPEN, "h")}, {i: ("h", 1) for i in _OPEN}), (0, 1))
#: An insult is an address of its own where its clause has nothing else: the first pass tells that nothing comes before,
#: the second, from the clause's end, that nothing follows.
BEFORE = Transducer(({"i": ("i0", 0), "h": ("h", 0), "p": ("p", 0)}, {}), (1, 1))
AFTER = Transducer(({"i0": ("d", 0), "i": ("i", 0), "h": ("h", 0), "d": ("d", 0)}, {}), (1, 1))
#: Intent, then violence, then a person, each within four tokens of the one before.
_WAIT = 4
THREAT = Transducer(
    (
        {"w": ("w", 1)},
        *({"w": ("w", 1), "v": ("v", _WAIT + 1)} for _ in range(_WAIT)),
        *({"y": ("x", 0), "q": ("x", 0), "v": ("v", _WAIT + 1)} for _ in range(_WAIT)),
    ),
    (0, *(k + 1 if k < _WAIT else 0 for k in range(1, _WAIT + 1)), *(k + 1 if k < 2 * _WAIT else 0 for k in range(_WAIT + 1, 2 * _WAIT + 1))),
)


class Composition:
    """Transducers run one into the next; product states are made when first reached and kept."""

    def __init__(self, *parts: Transducer):
        self.parts, self.start, self.known = parts, (0,) * len(parts), {}

    def __getstate__(self):
        return {"parts": self.parts, "start": self.start, "known": {}}

    def step(self, state: tuple[int, ...], symbol: str) -> tuple[str, tuple[int, ...]]:
        found = self.known.get((state, symbol))
        if found is None:
            out, to = symbol, []
            for t, s in zip(self.parts, state):
                out, s = t.step(s, out)
                to.append(s)
            found = self.known[state, symbol] = (out, tuple(to))
        return found

    def run(self, symbols: list[str]) -> list[str]:
        state, out = self.start, []
        for s in symbols:
            o, state = self.step(state, s)
            out.append(o)
        return out


#: A clause is read forwards, then what that gives backwards, so that a target may stand on either side of an insult.
FORWARDS = Composition(NEGATED, REPORTED, THREAT, TARGETED, HEAPED, BEFORE)
BACKWARDS = Composition(TARGETED, HEAPED, AFTER)
_KIND = {"j": 0, "d": 1, "h": 2, "k": 4, "l": 5, "x": 6}
_SPREAD = 3


def paths(symbols: list[str]) -> list[str]:
    """The marked form of each symbol of a clause; ``i`` stays where no path takes the insult."""
    out = BACKWARDS.run(FORWARDS.run(symbols)[::-1])[::-1]
    return ["i" if o[0] == "i" else o for o in out]


@dataclass
class Model:
    """Learned terminals with their weights, and the weights of the kinds of path."""

    terminals: dict[str, float] = field(default_factory=dict)
    bias: float = -2.0
    kinds: tuple[float, ...] = PRIOR

    def __post_init__(self):
        self.lexicon = Lexicon(self.terminals)

    def features(self, text: str) -> np.ndarray:
        """By kind of path, the weight of the text's matched clauses, as log(1 + sum).

        A clause counts on each kind of path with its heaviest insult there; clauses that the same form leads count
        once, on the first kind of KINDS that one of them has. A clause with a threat counts 1. Insults are heaped if
        their clause has two different ones. One that no path takes counts nothing, however often it stands; different
        ones over a text are spread, and all but the heaviest of them count.
        """
        out = np.zeros(len(KINDS))
        low = text.casefold()
        read = self.lexicon.read
        if not any(read(w)[0] in "iv" for w in set(WORDS.findall(low))):
            return out
        leads: dict[str, int] = {}
        spread: dict[str, float] = {}
        for clause in CLAUSE.split(low):
            words = TOKEN.findall(clause)
            told = [read(t) for t in words]
            symbols = [s for s, _ in told]
            if "i" not in symbols and "v" not in symbols:
                continue
            heaviest: dict[int, tuple[float, str]] = {}
            marked = [(o, weight, w) for o, (_, weight), w in zip(paths(symbols), told, words) if o in _KIND or o == "i"]
            alike = len({w for o, _, w in marked if o in "ih"}) < 2
            for o, weight, w in marked:
                if o == "i" or o == "h" and alike:
                    spread[w] = weight
                else:
                    kind = _KIND[o]
                    heaviest[kind] = max(heaviest.get(kind, (0.0, "")), (weight, w))
            if heaviest.pop(_KIND["x"], None):
                out[-1] += 1
            for kind, (_, w) in heaviest.items():
                leads[w] = min(kind, leads.get(w, kind))
        for w, kind in leads.items():
            out[kind] += read(w)[1]
        out[_SPREAD] = sum(sorted(spread.values())[:-1])
        return np.log1p(out)

    def score(self, f: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + f @ np.array(self.kinds))))


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Maximum a posteriori weights (bias first), pulled to ``prior``; Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    pull = np.diag([1e-3, *[strength] * (x.shape[1] - 1)])
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (y - p) - pull @ (w - prior))
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _forms(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Learn from labelled rows that are not held out, at most about ``sample`` of them by hash of their id.

    A form (a word or a stem) counts in toxic rows once for all whose first place of it has the same characters on both
    sides, so that copies and near copies of a text count as one; in other rows it counts in each. It becomes a terminal if the
    2.5-sigma lower bound of its log ratio of frequencies is at least 1; that bound is its weight. Words of the closed
    classes never do. Then path weights are fitted by logistic regression on the clauses' paths, pulled to the grammar's
    own weights, so kinds that the labels don't show keep theirs. Without rows of both labels, the grammar's own weights
    stay. How many terminals there are follows from ``sample`` alone: each stands in three places of the sample at least.

    A null label is no label; a document labelled twice is toxic if one label says so; null and empty texts have no
    forms; a null id is never learned from; an empty table leaves the grammar's own weights. Other columns are not read.
    """
    ws = Workspace(docs.sparkSession, "toxicity")
    own = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    n = own.count()
    if n > sample:
        own = own.where(F.pmod(F.xxhash64(F.lit(11), id_col), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    own = own.groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("y"))
    rows = ws.save(docs.select(F.col(id_col).cast("long").alias("__id"), utf8(text_col).alias("t")).join(sized(own, min(n, sample + sample // 5)), "__id").select("t", "y"), "sample")
    held = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not held.get(0) or not held.get(1):
        return Model()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f for f, _ in seen], pa.string()), pa.array([p for _, p in seen], pa.int64())], names=["form", "place"])

        seen: set[tuple[str, int]] = set()
        for b in batches:
            for t in b.column(0):
                low, own_forms = t.as_py().decode("utf-8", "replace").casefold(), set()
                for m in WORDS.finditer(low):
                    w, (i, j) = m[0], m.span()
                    if w not in own_forms:
                        place = xxhash.xxh64_intdigest(f"{low[max(0, i - BESIDE) : i]}\n{low[j : j + BESIDE]}") >> 1
                        new = [f for f in _forms(w) if f not in own_forms]
                        own_forms.update(new)
                        seen.update((f, place) for f in new)
                if len(seen) > 400_000:
                    yield table()
                    seen = set()
        yield table()

    often = rows.where("y = 1").select("t").mapInArrow(places, "form string, place long").distinct().groupBy("form").count().where("count >= 3").collect()
    closed = set().union(*CLASSES.values())
    p = {r["form"]: r["count"] for r in often if r["form"] not in closed}

    def other(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                seen.update({f for w in set(WORDS.findall(t.as_py().decode("utf-8", "replace").casefold())) for f in _forms(w) if f in p})
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["form", "n"])

    q = dict(rows.where("y = 0").select("t").mapInArrow(other, "form string, n long").groupBy("form").agg(F.sum("n").alias("n")).collect())
    half, terminals = 0.5, {}
    for f, k in p.items():
        ratio = math.log((k + half) / (held[1] + 1)) - math.log((q.get(f, 0) + half) / (held[0] + 1))
        bound = ratio - 2.5 * math.sqrt(1 / (k + half) + 1 / (q.get(f, 0) + half))
        if bound >= 1:
            terminals[f] = bound
    model = Model(terminals)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = _features(model, b.column(0))
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array(f[:, k]) for k in range(f.shape[1]))], names=["y", *names])

    names = [f"f{k}" for k in range(len(KINDS))]
    data = rows.mapInArrow(featured, "y int, " + ", ".join(f"{c} double" for c in names)).groupBy(*[F.round(c, 2).alias(c) for c in names], "y").count().collect()
    ws.drop(rows)
    x = np.array([[r[c] for c in names] for r in data])
    y = np.array([r["y"] for r in data], float)
    times = np.array([r["count"] for r in data], int)
    w = _logistic(np.repeat(x, times, axis=0), np.repeat(y, times), np.array([model.bias, *model.kinds]))
    if not x[:, -1].any():  # labels show no threat, so they can't say that one is harmless: it decides, whatever the bias
        w[-1] = max(w[-1], (MARGIN - w[0]) / math.log(2))
    if terminals:  # labels are of texts, most of which hold several insults: that one at a person suffices is the grammar's to say
        w[1] = max(w[1], (MARGIN - w[0]) / math.log1p(float(np.median(list(terminals.values())))))
    return Model(terminals, float(w[0]), tuple(float(v) for v in np.maximum(w[1:], 0)))


def _features(model: Model, texts: pa.Array) -> np.ndarray:
    return np.array([model.features((t.as_py() or b"").decode("utf-8", "replace")) for t in texts]).reshape(len(texts), len(KINDS))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, and by kind of path the weight of the matched clauses) for each row.

    Null and empty texts get the bias's score. Whole texts are looked at; ids, labels and other columns are not read for
    the score. Repeated rows score alike; null ids are carried; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = _features(model, b.column(1))
            s = model.score(f)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), *(pa.array(f[:, k]) for k in range(len(KINDS)))], names=["doc_id", "score", "predicted", *KINDS]
            )

    schema = "doc_id long, score double, predicted int, " + ", ".join(f"{k} double" for k in KINDS)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t")).mapInArrow(run, schema)


def clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns.

    Null and empty texts stay, as they match no clause; repeated rows stay or go together; ids are not read; an empty
    table gives none; columns of any name pass through unchanged.
    """

    def keep(texts: list[bytes]) -> np.ndarray:
        f = np.array([model.features(t.decode("utf-8", "replace")) for t in texts]).reshape(len(texts), len(KINDS))
        return model.score(f) < 0.5

    return keep_rows(docs, text_col, keep)
