"""Object specifications: declared field types, keys and register field classes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Names that the data model gives a meaning.
DELETED, MESSAGE_NO, MERGED_ON, INSERTED_ON = "is_deleted_or_empty", "exchange_message_no", "merged_on", "inserted_on"
RESERVED = ("merged_on", "inserted_on", "exchange_message_no", "is_deleted_or_empty")
SUPPORTED = ("Catalog", "Document", "InformationRegister", "AccumulationRegister", "AccountingRegister")
RECORDERS, RECORDER_TYPE, LINE_NUMBER, OWNER_KEY = ("Recorder", "Recorder_Key"), "Recorder_Type", "LineNumber", "Ref_Key"
NOISE = ("exchange_message_no", "DataVersion", "Version")
FULL_LOAD_MESSAGE = 0
NUMERIC = ("Int64", "Int32", "Int16", "Double")
EMPTY_GUID = "00000000-0000-0000-0000-000000000000"
EMPTY_DATE = "0001-01-01 00:00:00"

#: Exact numbers have 38 digits, of which 18 are decimals unless the field is declared with another scale (``Double:4``);
#: one that doesn't fit has its column's scale changed if that can be done without loss, else it is rejected, never rounded.
NUMBER = T.DecimalType(38, 18)
#: Of parsed rows: the texts that were no values of their fields' types.
REJECTS = "__rejects"

SPARK_TYPES: dict[str, T.DataType] = {
    "Guid": T.StringType(),
    "Int64": T.LongType(),
    "Int32": T.IntegerType(),
    "Int16": T.ShortType(),
    "Double": NUMBER,
    "Boolean": T.BooleanType(),
    "DateTime": T.TimestampNTZType(),
    "String": T.StringType(),
    "Binary": T.StringType(),
}


def spark_type(declared: str) -> T.DataType:
    """Stored type of a declared one; an unknown type is kept as text, so that no key field is lost."""
    base, _, scale = declared.partition(":")
    return T.DecimalType(38, int(scale)) if base == "Double" and scale else SPARK_TYPES.get(declared, T.StringType())


def is_number(declared: str | None) -> bool:
    return (declared or "").partition(":")[0] in NUMERIC


@dataclass(frozen=True)
class TableSpec:
    """What a merge has to know of an object: fields by declared type, primary key, group key, register fields."""

    name: str
    fields: dict[str, str]
    pk: tuple[str, ...]
    group_key: tuple[str, ...] = ()
    dimensions: tuple[str, ...] = ()
    resources: tuple[str, ...] = ()
    attributes: tuple[str, ...] = ()
    is_table_part: bool = False
    parts: tuple[str, ...] = field(default=())

    @property
    def kind(self) -> str:
        return self.name.split("_", 1)[0]

    @property
    def is_register(self) -> bool:
        return self.kind.endswith("Register")

    @property
    def numeric_resources(self) -> tuple[str, ...]:
        return tuple(r for r in self.resources if is_number(self.fields.get(r)))

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, spark_type(t)) for f, t in self.fields.items()] + [T.StructField(DELETED, T.BooleanType()), T.StructField(MESSAGE_NO, T.LongType())])

    @property
    def page_key(self) -> str:
        """What a paged snapshot is ordered by first: the owner, the recorder, else the whole key's first field."""
        for k in (OWNER_KEY, *RECORDERS):
            if k in self.pk:
                return k
        if not self.pk:
            raise ValueError(f"{self.name} has no key to page by")
        return self.pk[0]


#: Dates by which an object's history is read in parts, the first that it has.
PARTITION_DATES = ("Date", "Period")


def partition_field(spec: TableSpec) -> str | None:
    """The date that a document or register is read by; none for an object without one."""
    return next((f for f in PARTITION_DATES if spec.fields.get(f) == "DateTime"), None)


def group_key(pk: tuple[str, ...]) -> tuple[str, ...]:
    """Fields whose rows a batch replaces together: the recorder's, or the owner of a table part; none for a plain key."""
    recorder = tuple(k for k in pk if k in RECORDERS or k == RECORDER_TYPE)
    if any(k in RECORDERS for k in recorder):
        return recorder
    return (OWNER_KEY,) if OWNER_KEY in pk and len(pk) > 1 else ()


# Suffixes and service fields by which virtual tables name a register's fields.
TURNOVER_SUFFIXES = ("Turnover", "Receipt", "Expense")
TURNOVER_PERIODS = {"Period", "SecondPeriod", "MinutePeriod", "HourPeriod", "DayPeriod", "WeekPeriod", "TenDaysPeriod", "MonthPeriod", "QuarterPeriod", "HalfYearPeriod", "YearPeriod"}
REGISTER_SERVICE = {"Period", "LineNumber", "Active", "RecordType", *RECORDERS}

#: For each virtual table, the pattern that makes a field a resource (its groups are the name), and which others are no dimension.
_VIRTUAL = (
    ("DrCrTurnover", re.compile(r"(.*?)Turnover(.*)"), TURNOVER_PERIODS | REGISTER_SERVICE),
    ("Balance", re.compile(r"(.*)Balance"), set()),
    ("Turnover", re.compile(rf"(.*?)(?:{'|'.join(TURNOVER_SUFFIXES)})"), TURNOVER_PERIODS | REGISTER_SERVICE),
)


def register_fields(base: str, properties: list[str], tables: dict[str, list[str]]) -> tuple[list[str], list[str], list[str]]:
    """(dimensions, resources, attributes) of a register, from the field lists of its published virtual tables.

    Each field of a virtual table has a role: resource by its table's pattern, else dimension, unless it is a type, a
    period or a service field. Roles of fields that the register itself lacks are dropped; what has no role is an
    attribute. Without any published table the three are empty.
    """
    published = [(tables[f"{base}_{kind}"], pattern, others) for kind, pattern, others in _VIRTUAL if f"{base}_{kind}" in tables]
    if not published:
        return [], [], []
    roles = [
        ("resource", "".join(m.groups())) if (m := pattern.fullmatch(f)) else ("dimension", f)
        for fields, pattern, others in published
        for f in fields
        if pattern.fullmatch(f) or not (f.endswith("_Type") or f in others)
    ]
    pick = lambda role: [f for f in dict.fromkeys(name for r, name in roles if r == role) if f in properties]
    dimensions, resources = pick("dimension"), pick("resource")
    taken = REGISTER_SERVICE.union(dimensions, resources)
    return dimensions, resources, [f for f in properties if f not in taken and not f.endswith("_Type")]


# Classes in the order in which a package's objects are saved.
SAVE_ORDER = ("Catalog_", "Document_", "InformationRegister_", "AccumulationRegister_", "AccountingRegister_")


def save_order(names: list[str]) -> list[str]:
    """Catalogs, documents, then registers; stable within a class, others last."""
    rank = lambda n: next((k for k, p in enumerate(SAVE_ORDER) if n.startswith(p)), len(SAVE_ORDER))
    return sorted(names, key=rank)


def owner_of(part: str, names: set[str]) -> str | None:
    """The longest known name that the part's name continues after an underscore."""
    return max((n for n in names if part.startswith(n + "_")), key=len, default=None)
