"""From raw documents to packed training sequences, in five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, packing, quality, simhash, tokens, toxicity
from tidemark.llm.common import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts have no words and go. Repeated rows stay or go together, ids are not read, further columns of
    any name pass through, an empty table gives none, and texts are looked at whole, however long.
    """
    return quality.accepted(docs)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as not toxic; the model learns from the labelled ones among them.

    Without labels of both kinds only threats, which need no learned words, could score. Null and empty texts stay.
    Repeated rows stay or go together, null ids are never learned from, further columns of any name pass through, an
    empty table gives none, and texts are looked at whole, however long.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id.

    Rows that link with none stay, whether their id is null or repeats; of several texts with a group's smallest id one
    stays, the same in every run. Null and empty texts are one group. Further columns of any name pass through, an empty
    table gives none, and texts are looked at whole, however long.
    """
    return simhash.keep_first(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a document taken twice is two rows, one not taken is none.

    A null source is a source of its own; null and empty texts have size 0 and go; rows that repeat in id, size and
    source are taken alike; further columns of any name pass through; an empty table gives none; words are counted in
    whole texts.
    """
    size, members, times = mixing.words("text"), F.array("source"), "__times"
    while times in docs.columns:
        times += "_"
    taken = mixing.mix(docs, size, members).attach(docs, size, members, out_col=times).where((F.col(times) > 0) & (size > 0))
    return taken.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place there.

    A null or empty text is the end id alone; repeated rows, null ids among them, each take their place; further columns
    are not read; an empty table gives none; texts are encoded whole and cut only where they are longer than a sequence.
    """
    return packing.pack(docs, tokens.vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", without_toxic),
    ("simhash near-dedup", one_of_each),
    ("mixing to target weights", mixed),
    ("best-fit packing", packed),
]

#: Learned scores, XXH64 fingerprints, seeded choices and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table ``documents``; each result is written as Parquet and read again.

    Nulls, empty and very long texts, repeated rows, clashing names and empty tables have the results that the stages state.
    """
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = ws.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
