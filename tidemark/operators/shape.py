"""From parsed entries to flat rows: routing, child rows, record sets, tombstones, zero filling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import convert, filters
from tidemark.spec import DELETED, LINE_NUMBER, MESSAGE_NO, OWNER_KEY, REJECTS, TableSpec, is_number, spark_type


def route(entries: DataFrame, name: Column) -> tuple[DataFrame, DataFrame]:
    """(entries of supported classes with their ``object``, the others): what is not supported is told, not lost silently."""
    named = entries.withColumn("object", convert.object_name(name))
    known = F.coalesce(filters.supported(F.col("object")), F.lit(False))
    return named.where(known), named.where(~known)


def entry_counts(entries: DataFrame) -> DataFrame:
    """(object, entries, supported) of a package."""
    return entries.groupBy("object").agg(F.count(F.lit(1)).alias("entries")).withColumn("supported", filters.supported(F.col("object")))


def typed(values: dict[str, Column], spec: TableSpec, message_no: Column, filled_later: tuple[str, ...] = (), rejects: bool = False) -> list[Column]:
    """Columns of a flat row from its fields' texts.

    Key parts get their type's default for null, but for those that are filled from the entry. A field with a type field
    beside it keeps its text and gets the reference it holds in ``<field>_Guid``. The deletion flag and the package's
    number come last, and with ``rejects`` an array of the texts that were no values: field, text.
    """
    out: dict[str, Column] = {}
    bad: list[Column] = []
    for f, declared in spec.fields.items():
        if f.endswith("_Guid") and f.removesuffix("_Guid") in spec.fields and f"{f.removesuffix('_Guid')}_Type" in spec.fields:
            base = f.removesuffix("_Guid")
            out[f] = convert.reference(convert.scalar(values[base]), values[f"{base}_Type"]) if base in values else F.lit(None).cast("string")
            continue
        text = convert.scalar(values[f]) if f in values else F.lit(None).cast("string")
        value = convert.type_name(text) if f.endswith("_Type") else convert.convert(text, declared)
        out[f] = convert.key(value, declared) if f in spec.pk and f not in filled_later else value
        if not f.endswith("_Type") and declared not in ("String", "Binary", "Boolean"):
            bad.append(F.when(convert.rejected(text, declared), F.struct(F.lit(f).alias("field"), text.alias("text"))))
    mark, active = out.get("DeletionMark"), out.get("Active")
    told = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<struct<field:string,text:string>>")
    return [*(v.alias(f) for f, v in out.items()), convert.deleted(mark, active).alias(DELETED), message_no.cast("long").alias(MESSAGE_NO), *([told.alias(REJECTS)] if rejects else [])]


def zero_empty_numerics(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Absent numbers of a register's live rows are zero; a tombstone's stay null, and so does one whose text was rejected."""
    if not spec.is_register:
        return rows
    broken = F.transform(REJECTS, lambda r: r["field"]) if REJECTS in rows.columns else F.array().cast("array<string>")
    zero = lambda f: F.coalesce(F.col(f), F.when(~F.array_contains(broken, f), F.lit(0).cast(rows.schema[f].dataType)))
    return rows.withColumns({f: zero(f) for f, t in spec.fields.items() if is_number(t)})


def child_rows(owners: DataFrame, part: Column, keep: list[str]) -> DataFrame:
    """One row per element of a table part, with the owner's columns ``keep``."""
    return owners.select(*keep, F.explode(part).alias("element"))


def tombstones(entries: DataFrame, rows: Column, spec: TableSpec, message_no: Column, known: dict[str, Column]) -> DataFrame:
    """One marked row for each entry whose set of rows is empty.

    Its key has the defaults of its types, line number 1 and what the entry knows of it; numeric resources are null; so
    a first real line that comes later has the same key and takes its place.
    """
    values = [v.alias(c) for c, v in _tombstone(spec, message_no, known).items()]
    return entries.where((F.size(rows) <= 0) & _told(known)).select(*values)


def _tombstone(spec: TableSpec, message_no: Column, known: dict[str, Column]) -> dict[str, Column]:
    first = {LINE_NUMBER: F.lit(1)} if LINE_NUMBER in spec.pk else {}
    out = {f: (known.get(f) if f in known else first.get(f, convert.key_default(spec.fields[f]))).cast(spark_type(spec.fields[f])) for f in spec.pk}
    out |= {r: F.lit(None).cast(spark_type(spec.fields[r])) for r in spec.numeric_resources if r not in spec.pk}
    return out | {DELETED: F.lit(True), MESSAGE_NO: message_no.cast("long")}


def emptied(rows: DataFrame, empty: Column, real: Column, spec: TableSpec, message_no: Column, known: dict[str, Column]) -> DataFrame:
    """``rows`` in which those that stand for an empty set are made its tombstones, as ``tombstones`` gives them, or go if its owner isn't known.

    ``real`` is true of no such row; the filter names it, so that it stays behind the rows' making.
    """
    values = _tombstone(spec, message_no, known)
    cols = [c for c in rows.columns if c in spec.fields or c in (DELETED, MESSAGE_NO, REJECTS)]
    kept = rows.where(real | ~empty | _told(known))
    return kept.withColumns({c: F.when(empty, values.get(c, F.lit(None))).otherwise(F.col(c)) for c in cols})


def _told(known: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, (c.isNotNull() for f, c in known.items() if not f.endswith("_Type")), F.lit(True))


def unplaced(entries: DataFrame, rows: Column, known: dict[str, Column]) -> DataFrame:
    """Entries with an empty set whose owner isn't known: no tombstone can stand for them, so they have to be told."""
    return entries.where((F.size(rows) <= 0) & ~_told(known))


def accumulate(*frames: DataFrame) -> DataFrame:
    """All rows; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def part_tombstones(owners: DataFrame, part: Column, spec: TableSpec, message_no: Column) -> DataFrame:
    return tombstones(owners, part, spec, message_no, {OWNER_KEY: F.col(OWNER_KEY)})


def counters(log: DataFrame) -> DataFrame:
    """(table, inserted, updated, deleted, rows_modified): counts added up over journal entries."""
    kinds = ("inserted", "updated", "deleted")
    out = log.groupBy("table").agg(*[F.sum(k).alias(k) for k in kinds])
    return out.withColumn("rows_modified", F.col("inserted") + F.col("updated") + F.col("deleted"))
