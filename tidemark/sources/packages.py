"""Change packages in Atom XML and paged snapshots as frames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import convert
from tidemark.operators import shape
from tidemark.spec import OWNER_KEY, RECORDER_TYPE, RECORDERS, REJECTS, TableSpec

_OPTIONS = {"ignoreNamespace": "false", "ignoreSurroundingSpaces": "true", "mode": "PERMISSIVE"}
_SET = "x.content.`m:properties`.`d:RecordSet`.`d:element`"
CATEGORY = T.StructType([T.StructField("_term", T.StringType())])


def _texts(fields: list[str]) -> list[T.StructField]:
    return [T.StructField(f"d:{f}", T.StringType()) for f in fields]


def _rows_of(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField("_m:type", T.StringType()), T.StructField("d:element", T.ArrayType(T.StructType(_texts(fields))))])


def _entry(fields: list[T.StructField]) -> T.StructType:
    properties = T.StructType(fields)
    content = T.StructType([T.StructField("m:properties", properties)])
    return T.StructType([T.StructField("category", CATEGORY), T.StructField("content", content)])


def entries_of_feed(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """(entry): the raw entries of feeds in files. Files are cut at the entries' ends, so tasks share a large package.

    ``prefix`` is that of the feed's own elements, as ``feed_prefix`` finds it; entries come without it.
    """
    name = f"{prefix}entry"
    pieces = spark.read.option("lineSep", f"</{name}>").text(path)
    found = pieces.where(F.col("value").rlike(rf"<{name}\b")).select(F.concat(F.regexp_extract("value", rf"(?s)(<{name}\b.*)$", 1), F.lit(f"</{name}>")).alias("entry"))
    return found.select(F.regexp_replace("entry", rf"(</?){prefix}", "$1").alias("entry")) if prefix else found


def feed_prefix(head: str) -> str:
    """The prefix, with its colon, of a document's root: none where its namespace is the default one."""
    root = re.search(r"<([A-Za-z_][\w.-]*:)?feed\b", head)
    return root[1] or "" if root else ""


def _field(name: str) -> Column:
    return F.col(f"x.content.`m:properties`.`d:{name}`")


def parsed(entries: DataFrame, fields: list[T.StructField]) -> DataFrame:
    return entries.select("*", F.from_xml("entry", _entry(fields), _OPTIONS).alias("x"))


def unknown_fields(entries: DataFrame, spec: TableSpec, parts: dict[str, TableSpec] | None = None) -> DataFrame:
    """(field, entries) of fields that arrived, in the entry itself or in its rows, and that no specification names."""
    known = {*spec.fields, *(parts or {}), "RecordSet", "element", *(f for p in (parts or {}).values() for f in p.fields)}
    named = entries.select(F.explode(F.array_distinct(F.regexp_extract_all("entry", F.lit(r"<d:(\w+)[\s/>]"), 1))).alias("field"))
    return named.where(~F.col("field").isin(*known)).groupBy("field").agg(F.count(F.lit(1)).alias("entries"))


def _raw(spec: TableSpec) -> list[str]:
    return [f for f in spec.fields if not (f.endswith("_Guid") and f"{f.removesuffix('_Guid')}_Type" in spec.fields)]


def entity_rows(entries: DataFrame, spec: TableSpec, message_no: Column, parts: dict[str, TableSpec] | None = None, rejects: bool = False) -> dict[str, DataFrame]:
    """By name: the rows of a catalog or document, and those of its table parts (field of the owner: the part's spec).

    A part that arrived without rows, in any of its empty forms, gives one tombstone; a part that did not arrive gives
    nothing. Part rows carry the owner's key and its deletion flag. ``rejects``: see ``shape.typed``.
    """
    parts = parts or {}
    own = [f for f in _raw(spec) if f not in parts]
    nested = [T.StructField(f"d:{f}", _rows_of([x for x in _raw(p) if x != OWNER_KEY])) for f, p in parts.items()]
    x = parsed(entries, _texts(own) + nested)
    arrived = {f: F.col("entry").rlike(rf"<d:{f}[\s/>]") for f in parts}
    rows = x.select(*shape.typed({f: _field(f) for f in own}, spec, message_no, rejects=rejects), *[F.col(f"x.content.`m:properties`.`d:{f}`.`d:element`").alias(f"__{f}") for f in parts], *[a.alias(f"__has_{f}") for f, a in arrived.items()])
    out = {spec.name: rows.select(*[c for c in rows.columns if not c.startswith("__") or c == REJECTS])}
    for f, p in parts.items():
        kids = shape.child_rows(rows.where(F.col(f"__has_{f}")), F.col(f"__{f}"), [OWNER_KEY, "is_deleted_or_empty"])
        values = {c: F.col(f"element.`d:{c}`") for c in _raw(p) if c != OWNER_KEY}
        typed = kids.select(F.col(OWNER_KEY).alias("__owner"), F.col("is_deleted_or_empty").alias("__gone"), *shape.typed(values, p, message_no, filled_later=(OWNER_KEY,), rejects=rejects))
        typed = typed.withColumns({OWNER_KEY: F.col("__owner"), "is_deleted_or_empty": F.col("is_deleted_or_empty") | F.col("__gone")}).drop("__owner", "__gone")
        empty = shape.part_tombstones(rows.where(F.col(f"__has_{f}")), F.coalesce(F.col(f"__{f}"), F.array()), p, message_no)
        out[p.name] = shape.accumulate(typed, empty)
    return out


def register_rows(entries: DataFrame, spec: TableSpec, message_no: Column, rejects: bool = False) -> DataFrame:
    """Rows of record sets with their recorder from the entry; an emptied set gives a tombstone; numbers are zero-filled.

    An entry in which no record set arrived, in any form, is a row itself and empties nothing.
    """
    recorder, own = _recorder(spec), _raw(spec)
    # One pass parses each entry once: an outer explode infers no filter that would parse it again, and sets, emptied
    # sets and bare entries are told apart by columns, not by branches over the same entries.
    x = parsed(entries.where("entry IS NOT NULL"), [*_texts(own), T.StructField("d:RecordSet", _rows_of(own))])
    itself = F.array(F.struct(*[_field(f).alias(f"d:{f}") for f in own]))
    found = F.when(has_set(), F.coalesce(F.col(_SET), F.array())).otherwise(itself)
    sets = x.select(*[F.when(has_set(), c).alias(f"__{f}") for f, c in _at_entry(spec).items()], found.alias("set"))
    kids = sets.select(*[f"__{f}" for f in recorder], (F.size("set") <= 0).alias("__empty"), F.explode_outer("set").alias("element"))
    typed = kids.select("element", "__empty", *[f"__{f}" for f in recorder], *shape.typed({f: F.col(f"element.`d:{f}`") for f in own}, spec, message_no, filled_later=tuple(recorder), rejects=rejects))
    known = {f: F.coalesce(F.col(f), F.col(f"__{f}")) for f in recorder}
    typed = typed.withColumns({f: convert.key(c, spec.fields[f]) if f in spec.pk else c for f, c in known.items()})
    all_rows = shape.emptied(shape.zero_empty_numerics(typed, spec), F.col("__empty"), F.col("element").isNotNull(), spec, message_no, {f: F.col(f"__{f}") for f in recorder})
    return all_rows.drop("element", "__empty", *[f"__{f}" for f in recorder])


def has_set() -> Column:
    """Whether a record set arrived in the entry, empty or not."""
    return F.col("entry").rlike(r"<d:RecordSet[\s/>]")


def _recorder(spec: TableSpec) -> list[str]:
    return [f for f in (*RECORDERS, RECORDER_TYPE) if f in spec.fields]


def record_sets(entries: DataFrame, spec: TableSpec) -> DataFrame:
    """(the recorder's fields as ``__<field>``, set) of entries in which a record set arrived."""
    x = parsed(entries.where(has_set()), _texts(_recorder(spec)) + [T.StructField("d:RecordSet", _rows_of(_raw(spec)))])
    return x.select(*[c.alias(f"__{f}") for f, c in _at_entry(spec).items()], F.coalesce(F.col(_SET), F.array()).alias("set"))


def _at_entry(spec: TableSpec) -> dict[str, Column]:
    """The recorder's fields as the entry itself has them."""
    return {f: (convert.type_name(_field(f)) if f == RECORDER_TYPE else convert.convert(convert.scalar(_field(f)), spec.fields[f])) for f in _recorder(spec)}


def unplaced(entries: DataFrame, spec: TableSpec) -> DataFrame:
    """Emptied record sets of an unknown recorder."""
    return shape.unplaced(record_sets(entries, spec), F.col("set"), {f: F.col(f"__{f}") for f in _recorder(spec)})


def flat_register_rows(entries: DataFrame, spec: TableSpec, message_no: Column, rejects: bool = False) -> DataFrame:
    """Rows of a register without a recorder: one entry each."""
    x = parsed(entries, _texts(_raw(spec)))
    return shape.zero_empty_numerics(x.select(*shape.typed({f: _field(f) for f in _raw(spec)}, spec, message_no, rejects=rejects)), spec)


def page(table: DataFrame, key: list[str], top: int, skip: int) -> DataFrame:
    """Entries ``skip`` to ``skip + top`` in the total order of the key."""
    return table.orderBy(*key).offset(skip).limit(top)


def date_bounds(table: DataFrame, field: str) -> DataFrame:
    """(oldest, newest): one pass; a Parquet scan answers it from few columns."""
    return table.agg(F.min(field).alias("oldest"), F.max(field).alias("newest"))


def latest(feed: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``, pre-aggregated before the shuffle."""
    rest = [c for c in feed.columns if c not in key]
    return feed.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x")).select(*key, "x.*")
