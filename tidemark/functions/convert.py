"""Column expressions that turn source text into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.spec import EMPTY_DATE, EMPTY_GUID, spark_type

PROVIDER, PRIMITIVE = "StandardODATA.", "Edm."
_GUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def scalar(c: Column) -> Column:
    """An empty element is a present null."""
    return F.nullif(c, F.lit(""))


def canonical_guid(c: Column) -> Column:
    """Lower case with dashes, from plain, braced, urn or dashless forms; null for anything else."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"^(?:urn:)?(?:uuid:)?", ""), r"[{}-]", "")
    dashed = F.regexp_replace(bare, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(dashed.rlike(_GUID), dashed)


def convert(c: Column, declared: str) -> Column:
    """Text as a value of the declared type; null where it is none. Numbers never pass through floating point."""
    if declared == "Boolean":
        return F.lower(c) == "true"
    if declared == "Guid":
        guid = canonical_guid(c)
        return F.when(guid != EMPTY_GUID, guid)
    if declared == "DateTime":
        return c.try_cast("timestamp_ntz")
    if declared.startswith("Double"):
        kind = spark_type(declared)
        number = F.trim(c).try_cast(kind)
        plain = F.trim(c).rlike(rf"^[+-]?\d*\.?\d{{0,{kind.scale}}}0*$")
        return F.when(plain | (number.cast("double") == F.trim(c).try_cast("double")) & F.lower(c).contains("e"), number)
    if declared in ("Int64", "Int32", "Int16"):
        return F.trim(c).try_cast(spark_type(declared))
    return c


def rejected(c: Column, declared: str) -> Column:
    """True where a text was no value of its type; an empty reference is a value."""
    bad = c.isNotNull() & convert(c, declared).isNull()
    return bad & (canonical_guid(c).isNull() if declared == "Guid" else F.lit(True))


def key_default(declared: str) -> Column:
    """What stands for null in a key."""
    if declared == "Guid":
        return F.lit(EMPTY_GUID)
    if declared == "DateTime":
        return F.lit(EMPTY_DATE).cast("timestamp_ntz")
    if declared == "Boolean":
        return F.lit(False)
    if declared in ("Int64", "Int32", "Int16"):
        return F.lit(0).cast(spark_type(declared))
    if declared.startswith("Double"):
        return F.lit(0).cast(spark_type(declared))
    return F.lit("")


def key(c: Column, declared: str) -> Column:
    return F.coalesce(c, key_default(declared))


def type_name(c: Column) -> Column:
    """A type tag without its provider's prefix, then without that of primitives."""
    return F.regexp_replace(F.regexp_replace(c, r"^StandardODATA\.", ""), r"^Edm\.", "")


def reference(value: Column, tag: Column) -> Column:
    """The reference that a composite field holds: none if its tag is a primitive's."""
    return F.when(~F.coalesce(tag, F.lit("")).startswith(PRIMITIVE) & tag.isNotNull(), convert(value, "Guid"))


def deleted(mark: Column | None, active: Column | None) -> Column:
    """Marked for deletion, or a record known to be inactive."""
    marked = F.coalesce(mark, F.lit(False)) if mark is not None else F.lit(False)
    return marked | (active.eqNullSafe(F.lit(False)) if active is not None else F.lit(False))


def zero_filled(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def object_name(c: Column) -> Column:
    """A type's full name without collection, provider and row-type wrapping; null where no class precedes an underscore."""
    bare = F.regexp_replace(c, r"^Collection\((.*?)\)?$", "$1")
    bare = F.regexp_replace(F.regexp_replace(bare, r"^StandardODATA\.", ""), r"_RowType$", "")
    return F.when(F.instr(bare, "_") > 0, bare)


def object_class(c: Column) -> Column:
    return F.substring_index(object_name(c), "_", 1)
