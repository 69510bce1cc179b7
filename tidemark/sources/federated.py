"""Tables in another engine: reads that push what they can, restrictions by changed keys, and a sink that keeps versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.packages import latest
from tidemark.spec import DELETED

#: Keys that a list in a pushed predicate may have; beyond it the keys are joined.
MOST_KEYS = 10_000
# Fixed value: the month of rows without a period in a foreign mart.
NO_MONTH = "1900-01-01"


def read(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A foreign table; column choice and plain predicates are run there."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def key_list(keys: DataFrame, most: int = MOST_KEYS) -> list | None:
    """The distinct keys that aren't null, or None if there are more than ``most``."""
    c = keys.columns[0]
    found = [r[0] for r in keys.where(F.col(c).isNotNull()).select(c).distinct().limit(most + 1).collect()]
    return sorted(found) if len(found) <= most else None


def restricted(table: DataFrame, column: str, keys: DataFrame, most: int = MOST_KEYS) -> DataFrame:
    """Rows with one of the keys: by a list that reaches the scan where keys are few, else by a semi join. A null key matches nothing."""
    found = key_list(keys, most)
    if found is not None:
        return table.where(F.col(column).isin(found) if found else F.lit(False))
    return table.join(keys.select(F.col(keys.columns[0]).alias("__key")).distinct(), F.col(column) == F.col("__key"), "left_semi")


def key_array(keys: DataFrame) -> DataFrame:
    """(keys): one row with the sorted distinct keys, for engines that test membership in an array."""
    c = keys.columns[0]
    return keys.agg(F.array_sort(F.collect_set(c)).alias("keys"))


def month(c: Column) -> Column:
    """The month that foreign rows are partitioned by; one sentinel for none."""
    return F.coalesce(F.trunc(c.cast("date"), "month"), F.lit(NO_MONTH).cast("date"))


def append(rows: DataFrame, url: str, table: str, version: Column, **options: str) -> None:
    """Add versions of rows to a foreign table that keeps all of them; nothing there is updated, so repeats do no harm."""
    rows.withColumn("version", version).write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def final(rows: DataFrame, key: list[str], version: str = "version", with_deleted: bool = False) -> DataFrame:
    """The last version of each key, without those that it marks as deleted: what such a table is read as."""
    out = latest(rows, key, [version])
    return out if with_deleted or DELETED not in rows.columns else out.where(~F.coalesce(F.col(DELETED), F.lit(False)))
