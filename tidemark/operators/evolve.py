"""Schema change: new columns, columns and tables whose type or key changed, and retention."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _family(t: T.DataType) -> str:
    """Lengths and precisions don't make a type another one."""
    return "decimal" if isinstance(t, T.DecimalType) else "string" if isinstance(t, (T.StringType, T.VarcharType, T.CharType)) else t.typeName()


def retired_name(name: str, taken: set[str]) -> str:
    """A free name for what is put aside: the old one, ``_Old_`` and four hexadecimal digits."""
    n = 0
    while True:
        out = f"{name}_Old_{hashlib.md5(f'{name}{n or ''}'.encode()).hexdigest()[:4]}"
        if out not in taken:
            return out
        n += 1


def changed_types(table: DataFrame, batch: DataFrame) -> list[str]:
    have = {f.name: f.dataType for f in table.schema}
    return [f.name for f in batch.schema if f.name in have and not isinstance(f.dataType, T.NullType) and _family(f.dataType) != _family(have[f.name])]


def evolve(table: DataFrame, batch: DataFrame, key: list[str]) -> tuple[DataFrame | None, dict[str, str], list[str]]:
    """(the table to merge into, what was retired by its new name, columns that the batch adds).

    A plain column of another type is put aside under a retired name and starts empty; a key column of another type
    retires the whole table (None: start anew). In both cases the object has to be loaded in full again.
    """
    changed = changed_types(table, batch)
    if set(changed) & set(key):
        return None, {}, batch.columns
    taken, retired = set(table.columns), {}
    for c in changed:
        retired[c] = retired_name(c, taken)
        taken.add(retired[c])
    out = table.withColumnsRenamed(retired)
    out = out.withColumns({c: F.lit(None).cast(batch.schema[c].dataType) for c in changed})
    return out, retired, [c for c in batch.columns if c not in table.columns]


def widened(table: DataFrame, column: str, scale: int) -> DataFrame:
    """A number column with fewer decimals and so more whole digits; nothing is rounded away silently."""
    c = F.col(column)
    lost = F.regexp_extract(c.cast("string"), rf"\.\d{{{scale}}}(\d*)", 1).rlike("[1-9]")
    return table.withColumn(column, F.when(lost, F.raise_error(F.lit(f"{column} has more than {scale} decimals"))).otherwise(c.cast(T.DecimalType(38, scale))))


def retained(log: DataFrame, stamp: str, oldest: str) -> DataFrame:
    """A log without what is older; on a log partitioned by day, only the partitions kept are read."""
    return log.where(F.col(stamp) >= F.lit(oldest).cast(log.schema[stamp].dataType))
