"""Chat formatting with offset-aligned loss masks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import encoder

# The template's control strings. A turn is <s>[INST]role[/INST]text</s>.
OPEN, ROLE, TEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
_HEAD = re.compile(r"(?=<s>|</s>|\[INST\]|\[/INST\])(.)", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)


def escape(text: str) -> str:
    """A text without any control string: backslashes are doubled, and one is put after a control string's first character."""
    return _HEAD.sub(r"\1" + r"\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The whole conversation as one string, and where each turn's text lies in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{ROLE}{escape(role)}{TEXT}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at = spans[-1][1] + len(CLOSE)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at character {at}")
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return found


def mask(start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]], int]:
    """Which tokens touch the sorted spans, the characters of the spans that those tokens cover, and how many of the tokens reach beyond a span."""
    on = np.zeros(len(start), bool)
    covered, beyond = [], 0
    for a, b in spans:
        i, j = int(np.searchsorted(end, a, "right")), int(np.searchsorted(start, b, "left"))
        if a < b and i < j:
            on[i:j] = True
            covered.append((max(a, int(start[i])), min(b, int(end[j - 1]))))
            first, last = start[i] < a, end[j - 1] > b
            beyond += int(first or last) if j - i == 1 else int(first) + int(last)
    return on, covered, beyond


def format_chats(conversations: DataFrame, path: str, learn: tuple[str, ...] = ("assistant",), id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: conv_id, formatted, ids, loss_mask (by token), loss_spans (characters under the mask) and
    n_beyond (tokens under the mask that reach from a learned text into the template's characters beside it).

    Rows come by turn (ties by role, then text; null turns first). A null text or role is empty; rows with a null id
    are one conversation; repeated rows are repeated turns; other columns are not read; an empty table gives no rows. A
    conversation is rendered and encoded whole, so one conversation has to fit a task's memory; rows are sorted on disk
    if need be, and one conversation is held at a time.
    """

    def finish(conv: int | None, turns: list[tuple[str, str]]) -> tuple:
        text, spans = render(turns)
        ids, start, end = encoder(path).located(text)
        on, covered, beyond = mask(start, end, [s for s, (role, _) in zip(spans, turns) if role in learn])
        return conv, text, ids, on, [{"a": a, "b": b} for a, b in covered], beyond

    def lists(values: tuple[np.ndarray, ...], kind: pa.DataType) -> pa.Array:
        edges = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(values), kind))

    names = ["conv_id", "formatted", "ids", "loss_mask", "loss_spans", "n_beyond"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        conv, text, ids, on, spans, beyond = zip(*rows)
        span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(text, pa.string()), lists(ids, pa.int32()), lists(on, pa.bool_()), pa.array(spans, span), pa.array(beyond, pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, turns, done, size, some = None, [], [], 0, False
        for b in batches:
            for conv, role, text in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if some and conv != now:
                    done.append(finish(now, turns))
                    size += len(done[-1][1])
                    turns = []
                    if size > 4_000_000:
                        yield batch(done)
                        done, size = [], 0
                now, some = conv, True
                turns.append((role.as_py().decode("utf-8", "replace"), text.as_py().decode("utf-8", "replace")))
        if some:
            done.append(finish(now, turns))
        if done:
            yield batch(done)

    rows = conversations.select(F.col(id_col).cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).cast("binary").alias("role"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInArrow(run, "conv_id long, formatted string, ids array<int>, loss_mask array<boolean>, loss_spans array<struct<a:long,b:long>>, n_beyond long")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: turns parsed from the string, text taken from under the mask.

    Null ids are carried, empty texts have the digest of nothing, repeated rows give repeated results, an empty table none;
    a string that is no rendered conversation raises an error. Other columns are not read.
    """

    def sha(s: str) -> str:
        return hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, text, spans, beyond in zip(*(c.to_pylist() for c in b.columns)):
                turns = parse(text)
                loss = "".join(unescape(text[s["a"] : s["b"]]) for s in spans)
                out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text), beyond))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) if k else pa.array(c, pa.int64()) for k, c in enumerate(zip(*out))], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_beyond"])

    return formatted.select("conv_id", "formatted", "loss_spans", "n_beyond").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_beyond long")
