"""Quality rules: how much of a text lies inside its own repeated word n-grams and lines, by rolling hashes in numpy."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, keep_rows, utf8

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_RANDOM = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Rules:
    """What a text may have at most. ``ngrams`` maps a word n-gram length to the allowed share of word characters that
    lie in n-grams found twice or more."""

    min_words: int = 20
    window: int = 8
    repeat_percent: int = 30
    ngrams: tuple[tuple[int, float], ...] = ((4, 0.40), (8, 0.30), (16, 0.20))
    line_share: float = 0.30
    symbols_per_word: float = 0.20


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Polynomial hash mod 2^64 of values[start:end] for each span, from one rolling sum."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(base, len(values)), dtype=np.uint64)])
    return _mix((total[ends] - total[starts]) * _powers(inverse, len(values) + 1)[starts])


def _twice(key: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray], exact: Callable[[int], bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each item, whether an equal one exists, and whether an equal one stands before it.

    Equal hashes only propose: ``same`` compares neighbours of one hash, and a hash that unequal items share is settled
    by their contents, which ``exact`` gives.
    """
    order = np.argsort(key, kind="stable")
    s = key[order]
    near = np.flatnonzero(s[1:] == s[:-1])
    equal = np.zeros(max(len(key) - 1, 0), bool)
    equal[near] = same(order[near], order[near + 1])
    if wrong := set(s[near[~equal[near]]].tolist()):
        label = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])[np.argsort(order, kind="stable")] if len(key) else key
        shared: dict[bytes, int] = {}
        for k in np.flatnonzero(np.isin(key, np.array(sorted(wrong), key.dtype))).tolist():
            label[k] = len(key) + shared.setdefault(exact(k), len(shared))
        order = np.argsort(label, kind="stable")
        equal = label[order][1:] == label[order][:-1]
    twice, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = equal
    twice[order] = np.concatenate([[False], equal]) | np.concatenate([equal, [False]]) if len(key) else False
    return twice, later


def _covered(hits: np.ndarray, width: int, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int32)
    edge[hits] += 1
    np.subtract.at(edge, np.minimum(hits + width, n), 1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[bytes], lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Counts of each text, by name; ``chars_n`` are word characters inside n-grams of n words found twice or more.

    Equal words have one number, so words are told apart exactly; n-grams and lines that share a rolling hash are
    compared before they count as equal.
    """
    docs = len(texts)
    data = b"".join(t + b"\n" for t in texts)
    raw = np.frombuffer(data, np.uint8)
    stop = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, docs))
    space = _SPACE[raw]
    before = np.concatenate([[True], space[:-1]])
    start, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    whole = np.concatenate([[0], np.cumsum(~space & ((raw & 0xC0) != 0x80))])  # code points in words up to a byte
    chars = whole[end] - whole[start]
    doc = np.searchsorted(stop, start, "right")
    per = lambda at, w=None: np.bincount(at, w, minlength=docs).astype(np.int64)
    out = {"n_words": per(doc), "word_chars": per(doc, chars), "n_symbols": per(np.searchsorted(stop, np.flatnonzero(_SYMBOL[raw]), "right"))}
    salt = _mix(np.arange(docs, dtype=np.uint64) + np.uint64(1))
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = np.fromiter(map(number.__getitem__, data.split()), np.int64, len(start))
    word, n = _mix(ids.astype(np.uint64)), len(ids)
    for k in lengths:
        at = np.arange(max(n - k + 1, 0))
        at = at[doc[at] == doc[at + k - 1]]

        def same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            p, q = at[a], at[b]
            ok = doc[p] == doc[q]
            for j in range(k):
                ok &= ids[p + j] == ids[q + j]
            return ok

        twice, _ = _twice(_spans(word, at, at + k, _STEP) + salt[doc[at]], same, lambda i: b"%d " % doc[at[i]] + ids[at[i] : at[i] + k].tobytes())
        inside = _covered(at[twice], k, n)
        out[f"words_{k}"], out[f"chars_{k}"] = per(doc[inside]), per(doc[inside], chars[inside])
    cut = np.flatnonzero(raw == 10)
    first = np.concatenate([[0], cut[:-1] + 1])
    full = np.searchsorted(start, cut) > np.searchsorted(start, first)  # lines with a word
    first, cut = first[full], cut[full]
    at = np.searchsorted(stop, first, "right")

    def line(i: int) -> bytes:
        return data[first[i] : cut[i]]

    def equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (at[a] == at[b]) & np.fromiter((line(i) == line(j) for i, j in zip(a.tolist(), b.tolist())), bool, len(a))

    _, later = _twice(_spans(_RANDOM[raw], first, cut, _BASE) + salt[at], equal, lambda i: b"%d " % at[i] + line(i))
    out["n_dup_lines"] = per(at[later])
    out["line_chars"] = per(at[later], (whole[cut] - whole[first])[later])
    return out


def score(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the base counts, the covered characters, ``base_failed`` and the verdict ``kept``.

    A null or empty text has no words and fails the base rule. Words are the runs of non-ASCII-white-space; an n-gram
    lies within one text; lines compare as whole strings and count from the second equal one on. Repeated rows give
    repeated results; null ids are carried; other columns are not read. A text is looked at whole, however long.
    """
    lengths = tuple(dict.fromkeys((rules.window, *(n for n, _ in rules.ngrams))))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "line_chars", f"words_{rules.window}", *(f"chars_{n}" for n in lengths)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for texts in chunks(b.column(1)):
                found = measure(texts, lengths)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), *(pa.array(found[n]) for n in names)], names=["doc_id", *names]
                )
                at += len(texts)

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names)
    m = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t")).mapInArrow(run, schema)
    m = m.withColumnRenamed(f"words_{rules.window}", "n_repeat_words")
    bad = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    over = F.col("line_chars") > rules.line_share * F.col("word_chars")
    for n, share in rules.ngrams:
        over = over | (F.col(f"chars_{n}") > share * F.col("word_chars"))
    over = over | (F.col("n_symbols") > rules.symbols_per_word * F.col("n_words"))
    head = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rest = [c for c in m.columns if c not in head]
    return m.select(*head, bad.alias("base_failed"), (~bad & ~over).alias("kept"), *rest)


def accepted(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; verdicts travel with the rows, so nothing is joined.

    Null and empty texts have no words, so they go; repeated rows stay or go together; ids may be null or repeat; an
    empty table gives none; columns of any name pass through unchanged. A text is looked at whole, however long.
    """
    lengths = tuple(dict.fromkeys((rules.window, *(n for n, _ in rules.ngrams))))

    def keep(texts: list[bytes]) -> np.ndarray:
        f = measure(texts, lengths)
        ok = (f["n_words"] >= rules.min_words) & (100 * f[f"words_{rules.window}"] <= rules.repeat_percent * f["n_words"])
        ok &= f["line_chars"] <= rules.line_share * f["word_chars"]
        for n, share in rules.ngrams:
            ok &= f[f"chars_{n}"] <= share * f["word_chars"]
        return ok & (f["n_symbols"] <= rules.symbols_per_word * f["n_words"])

    return keep_rows(docs, text_col, keep)
