"""Token ids of a public byte-level BPE, and exact statistics from the histogram of encoded lengths."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, running, utf8

#: Lengths that one task sums up at most.
RANGE = 128


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of one vocabulary as little-endian unsigned 32-bit numbers.

    The same ids as the ``tokenizers`` library gives for the JSON file (a test compares them). Where the rank file of
    the same vocabulary lies beside it, the faster library for that form encodes.
    """

    def __init__(self, path: str):
        ranks = Path(path).with_suffix(".tiktoken")
        self.sizes = None
        if not ranks.exists():
            from tokenizers import Tokenizer

            t, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
            plain.encode_special_tokens = True
            self.encode = lambda text: np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            self.plain = lambda text: plain.encode(text, add_special_tokens=False)
            return
        import public_tokenizers
        import tiktoken

        special = {t["content"]: t["id"] for t in json.loads(Path(path).read_text())["added_tokens"]}
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.open("rb"))}
        core = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)._core_bpe
        names = set(special)
        self.encode = lambda text: bytes(core.encode_to_tiktoken_buffer(text, names))
        self.plain = lambda text: bytes(core.encode_to_tiktoken_buffer(text, set()))
        self.sizes = np.zeros(max(table.values()) + 1, np.int64)
        self.sizes[list(table.values())] = list(map(len, table))

    def located(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first character, end) of each token in one encoding; a special token's string in the text is ordinary text.

        Tokens tile the text, and all tokens of one split character have that character.
        """
        if self.sizes is None:
            e = self.plain(text)
            if not e.ids:
                return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
            start, end = np.array(e.offsets, np.int64).T
            end = np.maximum.accumulate(end)
            return np.array(e.ids, np.int32), np.minimum(start, np.concatenate([[0], end[:-1]])), end
        ids = np.frombuffer(self.plain(text), "<u4").astype(np.int32)
        end = np.cumsum(self.sizes[ids])
        start = end - self.sizes[ids]
        raw = text.encode("utf-8", "replace")
        if len(raw) == len(text):
            return ids, start, end
        seen = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # characters begun up to and with a byte
        return ids, seen[start] - 1, seen[end - 1]

    def __call__(self, text: str) -> bytes:
        return self.encode(text)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder a worker process."""
    return Encoder(path)


def _text(v: pa.Scalar) -> str:
    return v.as_py().decode("utf-8", "replace")


def lengths(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens): encoded length of each row's whole text; null and empty texts have 0.

    Repeated rows give repeated results; null ids are carried; an empty table gives none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in batches:
            n = np.fromiter((len(encode(_text(t))) // 4 for t in b.column(1)), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n)], names=["doc_id", "n_tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t")).mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Exact length histogram with prefix and suffix sums: one row per encoded length that occurs.

    length, n_docs and n_tokens of that length; docs_up_to and tokens_up_to count documents no longer; docs_longer
    counts longer ones; truncated_total is what all documents hold when each is cut at ``length`` tokens; quantile is the
    share of documents no longer. A limit between two lengths reads from the next lower row: truncated_total plus
    docs_longer for each token above it. An empty table gives no rows; repeated rows count each time.

    Sums run within ranges of RANGE lengths, offset by the totals of the lower ranges, of which there are as many as the
    longest document has tokens, divided by RANGE.
    """
    ws = Workspace(docs.sparkSession, "lengths")
    counts = ws.save(
        lengths(docs.withColumn("__none", F.lit(None).cast("long")), path, "__none", text_col).groupBy(F.col("n_tokens").alias("length")).agg(F.count(F.lit(1)).alias("n_docs")),
        "counts",
    ).withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    all_docs = counts.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    s = running(running(counts, [], "length", "n_docs", "d0", RANGE), [], "length", "n_tokens", "t0", RANGE).select(
        "length", "n_docs", "n_tokens", (F.col("d0") + F.col("n_docs")).alias("docs_up_to"), (F.col("t0") + F.col("n_tokens")).alias("tokens_up_to"), F.lit(all_docs).cast("long").alias("all_docs")
    )
    longer = F.col("all_docs") - F.col("docs_up_to")
    return s.select(
        "length", "n_docs", "n_tokens", "docs_up_to", "tokens_up_to", longer.alias("docs_longer"),
        (F.col("tokens_up_to") + longer * F.col("length")).alias("truncated_total"),
        (F.col("docs_up_to") / F.col("all_docs")).alias("quantile"),
    )


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context, total_tokens, kept_tokens, cut_docs) for each context limit, from the histogram alone.

    A limit given twice counts once; the histogram of an empty table gives no rows; longer histograms cost no more memory.
    """
    if not limits:
        raise ValueError("give one context limit at least")
    h = histogram.withColumn("context", F.explode(F.array(*[F.lit(x).cast("long") for x in dict.fromkeys(map(int, limits))])))
    return h.groupBy("context").agg(
        F.sum("n_tokens").alias("total_tokens"),
        F.sum(F.col("n_docs") * F.least("length", "context")).alias("kept_tokens"),
        F.sum(F.when(F.col("length") > F.col("context"), F.col("n_docs")).otherwise(0)).alias("cut_docs"),
    )
