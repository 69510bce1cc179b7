"""Mart views and what has to be recomputed of a mart when its sources change.

Sources are frames: a movement register (Recorder, Recorder_Type, LineNumber, Period, RecordType, Item, Qty, the
deletion flag, merged_on), documents (Ref_Key, Number, Date, merged_on) and a catalog (Ref_Key, Code, merged_on).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import DELETED, MERGED_ON

#: The bucket of rows without a period, in row marts and in grouped marts.
NO_MONTH, NO_DATE = "0000-00", "0001-01-01"


def signed(qty: Column, kind: Column, deleted: Column) -> Column:
    """Receipts count up, all else down; a deleted row counts nothing; an absent quantity or an unknown deletion flag makes it absent."""
    return F.when(qty.isNull() | deleted.isNull(), None).when(deleted, F.lit(0)).when(kind == "Receipt", qty).otherwise(-qty)


def month(c: Column) -> Column:
    return F.trunc(c.cast("date"), "month")


def row_view(register: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per movement with its catalog code; the catalog is left-joined, by broadcast where the planner finds it small."""
    c = catalog.select(F.col("Ref_Key").alias("__item"), F.col("Code").alias("Artikul"), F.col(MERGED_ON).alias("catalog_merged_on"))
    return register.join(c, register["Item"] == c["__item"], "left").select(
        "Recorder", "Recorder_Type", "LineNumber", "Period", signed(F.col("Qty"), F.col("RecordType"), F.col(DELETED)).alias("Qty"), "Artikul", MERGED_ON, "catalog_merged_on", DELETED
    )


def group_rows(register: DataFrame, documents: DataFrame, catalog: DataFrame, document_type: str, more: Iterable[str] = ()) -> DataFrame:
    """Movements with the group that each belongs to; only recorders of the document type have a document, the others a group of blanks. ``more``: further columns of the register."""
    d = documents.select(F.col("Ref_Key").alias("__doc"), "Number", "Date", F.col(MERGED_ON).alias("document_merged_on"))
    c = catalog.select(F.col("Ref_Key").alias("__item"), "Code", F.col(MERGED_ON).alias("catalog_merged_on"))
    rows = register.join(d, (register["Recorder"] == d["__doc"]) & (register["Recorder_Type"] == document_type), "left").join(c, F.col("Item") == c["__item"], "left")
    return rows.select(
        F.coalesce("Number", F.lit("")).alias("Number"),
        F.coalesce(F.year("Date"), F.lit(0)).alias("Year"),
        F.coalesce("Code", F.lit("")).alias("Artikul"),
        signed(F.col("Qty"), F.col("RecordType"), F.col(DELETED)).alias("Qty"),
        F.coalesce(month(F.col("Date")), F.lit(NO_DATE).cast("date")).alias("Period"),
        "Recorder", "Item", MERGED_ON, "document_merged_on", "catalog_merged_on", *[register[m] for m in more if m not in ("Recorder", "Item")],
    )


GROUP = ["Number", "Year", "Artikul"]


def grouped(rows: DataFrame, lineage: bool = True) -> DataFrame:
    """Sums by group; period and stamp are the latest; with lineage, the sorted sets of recorders and items behind a group."""
    keys = lambda c: F.array_sort(F.collect_set(c))
    more = [keys("Recorder").alias("Recorder_Keys"), keys("Item").alias("Item_Keys")] if lineage else []
    return rows.groupBy(*GROUP).agg(F.sum("Qty").alias("Qty"), F.max("Period").alias("Period"), F.max(MERGED_ON).alias("rows_merged_on"), *more)


def lineage_table(rows: DataFrame) -> DataFrame:
    """(source, key, group): which keys lie behind which group, one row each, instead of an index over arrays."""
    pairs = F.array(F.struct(F.lit("Recorder").alias("source"), F.col("Recorder").cast("string").alias("key")), F.struct(F.lit("Item").alias("source"), F.col("Item").cast("string").alias("key")))
    return rows.select(*GROUP, F.explode(pairs).alias("x")).where("x.key is not null").select("x.source", "x.key", *GROUP).distinct()


def masked_sum(table: DataFrame, by: str, value: str) -> DataFrame:
    """Sum of live rows with a key."""
    return table.where(~F.coalesce(F.col(DELETED), F.lit(True)) & F.col(by).isNotNull()).groupBy(by).agg(F.sum(value).alias(value))


def changed_rows(view: DataFrame, key: list[str], conditions: Iterable[Column]) -> DataFrame:
    """Keys of rows that any source changed, in one pass over the view: an unknown condition is none."""
    return view.where(_any(conditions)).select(*key).distinct()


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(c, F.lit(False)) for c in conditions), F.lit(False))


def union_of_keys(frames: Iterable[DataFrame]) -> DataFrame:
    """Keys that any of the frames has: for sources that each give their changed keys from few files, as ``Store.changes`` does."""
    return reduce(DataFrame.unionByName, frames).distinct()


def rows_to_refresh(view: DataFrame, key: list[str], conditions: Iterable[Column]) -> DataFrame:
    return view.join(changed_rows(view, key, conditions), key, "left_semi")


def affected_groups(lineage: DataFrame, rows: DataFrame, changed: dict[str, DataFrame], conditions: Iterable[Column], group: list[str]) -> DataFrame:
    """Groups that changed keys belonged to before, and groups that they belong to now.

    Rows are looked at once, whatever the number of conditions. ``changed`` has, by source name, a frame of one column ``key``; a null key belongs to nothing.
    """
    keys = reduce(DataFrame.unionByName, (f.select(F.lit(s).alias("source"), F.col("key").cast("string").alias("key")) for s, f in changed.items())).where("key is not null")
    before = lineage.join(keys.distinct(), ["source", "key"], "left_semi").select(*group)
    conditions = list(conditions)
    now = [rows.where(_any(conditions)).select(*group)] if conditions else []
    return reduce(DataFrame.unionByName, now, before).distinct()


def groups_behind(register: DataFrame, changed: dict[str, DataFrame], view: Callable[[DataFrame], DataFrame], group: list[str]) -> DataFrame:
    """Groups of ``view(register)`` behind changed keys: what its lineage has of these, without a lineage of all other keys.

    ``changed`` as in ``affected_groups``. Movements are picked before the view joins anything to them.
    """

    def behind(source: str, keys: DataFrame) -> DataFrame:
        same = register.schema[source].dataType == keys.schema["key"].dataType
        alike = lambda c: c if same else c.cast("string")
        picked = register.join(keys.select(alike(F.col("key")).alias("__key")), alike(F.col(source)) == F.col("__key"), "left_semi")
        return view(picked).select(*group).distinct()

    return reduce(DataFrame.unionByName, (behind(s, k) for s, k in changed.items())).distinct()


def difference(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """One row: missing (rows of ``right`` that ``left`` lacks or has otherwise), surplus (the other way) and total rows of ``right``; by one join on the key, which is unique in both."""
    values = [c for c in right.columns if c not in key]
    l, r = (f.select(*[F.col(c).alias(f"{s}_{c}") for c in key], F.struct(*values).alias(f"{s}_value"), F.lit(True).alias(s)) for f, s in ((left, "l"), (right, "r")))
    both = l.join(r, reduce(lambda a, b: a & b, (F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in key)), "full_outer")
    same = F.col("l").isNotNull() & F.col("r").isNotNull() & F.col("l_value").eqNullSafe(F.col("r_value"))
    count = lambda c: F.count(F.when(c, 1))
    return both.agg(count(F.col("r").isNotNull() & ~same).alias("missing"), count(F.col("l").isNotNull() & ~same).alias("surplus"), count(F.col("r").isNotNull()).alias("total"))


def row_months(register: DataFrame, period: str = "Period") -> DataFrame:
    """Blocks of a row mart's rebuild: the months that occur, and one bucket if a period is absent."""
    label = F.coalesce(F.date_format(period, "yyyy-MM"), F.lit(NO_MONTH)).alias("label")
    begins = month(F.col(period)).alias("begins")
    return register.select(label, begins).distinct().withColumn("ends", F.add_months("begins", 1)).orderBy("label")


def group_months(rows: DataFrame, mart: DataFrame) -> DataFrame:
    """Blocks of a grouped mart's rebuild: months of the source and of the mart, so that a vanished month is cleared."""
    return rows.select("Period").union(mart.select("Period")).distinct().orderBy("Period")
