"""One batch into one stored table: what its keys touch is read, merged and staged, with changes of schema and keys on the way."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.evolve import changed_types, evolve, retired_name, widened
from tidemark.operators.merge import MergeResult, merge
from tidemark.plans.store import BUCKET_ROWS, BUCKETS, Conflict, Staged, Store, enough, layout_of
from tidemark.spec import DELETED, MESSAGE_NO, REJECTS, TableSpec, spark_type

log = logging.getLogger(__name__)

#: How often a batch is merged anew because another writer was first.
MERGES = 3


#: Texts that were no values of their fields' types, by object, row (its key as JSON) and field, as the last package had them.
REJECTED = TableSpec("Rejected_values", {"object": "String", "row": "String", "field": "String", "text": "String"}, ("object", "row", "field"))


class BadKey(ValueError):
    """A key's text was no value of its type: its row would get another row's key."""


def _needs(c: Column) -> list[Column]:
    """Most whole digits and most decimals of numbers as text, without leading and trailing zeros."""
    whole = F.length(F.regexp_extract(c, r"^[+-]?0*(\d*)", 1))
    return [F.coalesce(F.max(whole), F.lit(0)).alias("whole"), F.coalesce(F.max(F.length(F.regexp_extract(c, r"\.(\d*?)0*$", 1))), F.lit(0)).alias("decimals")]


def fitted(whole: int, decimals: int, now: int) -> int | None:
    """The scale nearest to the present one under which so many whole digits and decimals fit into 38; None if none does."""
    return None if whole + decimals > 38 else min(max(now, decimals), 38 - whole)


def _refit(store: Store, specs: dict[str, TableSpec], rows: dict[str, DataFrame]) -> bool:
    """Change the scales of fields whose rejected numbers fit together with all that their tables and the batch hold; whether any was."""
    out = False
    for table, f in rows.items():
        spec, held = specs[table], store.read(table)
        bad = f.select(F.explode(REJECTS).alias("r")).select("r.field", F.trim("r.text").alias("text")).where(F.col("text").rlike(r"^[+-]?\d*\.?\d*$"))
        for r in bad.groupBy("field").agg(*_needs(F.col("text"))).collect():  # one row a field
            if not spec.fields[r["field"]].startswith("Double"):
                continue
            sides = [r, *(x.select(F.col(r["field"]).cast("string").alias("text")).agg(*_needs(F.col("text"))).first() for x in (f, held) if x is not None and r["field"] in x.columns)]
            now = spark_type(spec.fields[r["field"]]).scale
            scale = fitted(max(x["whole"] for x in sides), max(x["decimals"] for x in sides), now)
            if scale is not None and scale != now:
                log.warning("%s.%s has %d decimals from now on instead of %d", table, r["field"], scale, now)
                specs[table] = spec = replace(spec, fields=spec.fields | {r["field"]: f"Double:{scale}"})
                out = True
    return out


def as_stored(store: Store, spec: TableSpec) -> TableSpec:
    """The specification with numbers of the scales that the table has already."""
    v = store.state().get(spec.name)
    held = {f.name: f.dataType.scale for f in v.struct if isinstance(f.dataType, T.DecimalType)} if v else {}
    return replace(spec, fields={f: f"Double:{held[f]}" if t.startswith("Double") and f in held and held[f] != spark_type(t).scale else t for f, t in spec.fields.items()})


@contextmanager
def page(store: Store, specs: dict[str, TableSpec], make: Callable[[], dict[str, DataFrame]], rejects: list[DataFrame]) -> Iterator[tuple[dict[str, DataFrame], dict[str, dict[str, int]]]]:
    """Rows by table as ``make`` parses them by ``specs``, kept meanwhile, and by table and field how many texts were rejected.

    Numbers that don't fit have their column's scale changed, where that is possible without loss, and are parsed again.
    What stays rejected is null, never zero or another default, and goes to ``rejects``; in a key it is an error.
    """
    for n in [t for t in specs if t in make()]:
        specs[n] = as_stored(store, specs[n])
    rows = {t: f.cache() for t, f in make().items()}
    try:
        marked = {t: f for t, f in rows.items() if REJECTS in f.columns}
        found = {t: {r["field"]: r["count"] for r in f.select(F.explode(REJECTS).alias("r")).groupBy("r.field").count().collect()} for t, f in marked.items()}
        if any(found.values()) and _refit(store, specs, {t: f for t, f in marked.items() if found[t]}):
            for f in rows.values():
                f.unpersist()
            rows = {t: f.cache() for t, f in make().items()}
            found = {t: {r["field"]: r["count"] for r in rows[t].select(F.explode(REJECTS).alias("r")).groupBy("r.field").count().collect()} for t in marked}
        found = {t: n for t, n in found.items() if n}
        for t, n in found.items():
            log.error("VALUES REJECTED: %s has texts that are no values: %s", t, n)
            if bad := sorted(set(n) & set(specs[t].pk)):
                raise BadKey(f"{t}: texts that are no values in the key, fields {bad}")
            row = rows[t].select(F.lit(t).alias("object"), F.to_json(F.struct(*specs[t].pk)).alias("row"), F.explode(REJECTS).alias("r"), MESSAGE_NO)
            rejects.append(row.select("object", "row", "r.field", "r.text", F.lit(False).alias(DELETED), MESSAGE_NO).dropDuplicates(["object", "row", "field"]))
        yield {t: f.drop(REJECTS) for t, f in rows.items()}, found
    finally:
        for f in rows.values():
            f.unpersist()


def staged_rejects(store: Store, rejects: list[DataFrame], now: Column) -> Staged:
    """The table of rejected texts with these ones in it; they are no changes of the objects."""
    out = staged(store, reduce(DataFrame.unionByName, rejects), REJECTED, now)
    out.counts = {}
    return out


def staged(store: Store, batch: DataFrame, spec: TableSpec, now: Column, started_at: Column | None = None, always_touch: bool = False, buckets: int | None = None, on_retired: Callable[[str], None] = lambda _: None) -> Staged:
    """The table with a batch merged into it, written but not announced.

    Only parts that the batch's keys are in are read and written. A column that changed its type is put aside under a
    retired name, and a table whose key changed stays under one while a new table takes its place; ``on_retired`` is
    told the table, as it has to be loaded in full again.
    """
    name, pk = spec.name, list(spec.pk)
    at = store.head()
    v = store.state(at).get(name)
    layout = layout_of(spec, buckets or (enough(batch.count() / BUCKET_ROWS) if v is None else BUCKETS))
    kept_as, held, parts = None, None, None
    if v is not None and (changed := changed_types(store.read(name, at), batch)):
        on_retired(name)
        if set(changed) & set(pk):
            kept_as = retired_name(name, set(store.state(at)))
            log.warning("%s has another key now; what it held stays as %s", name, kept_as)
        else:
            held, retired, _ = evolve(store.read(name, at), batch, pk)
            log.warning("%s: columns of another type were put aside: %s", name, retired)
    elif v is not None and (scaled := {f.name: f.dataType for f in v.struct if isinstance(f.dataType, T.DecimalType) and f.name in batch.columns and f.dataType != batch.schema[f.name].dataType}):
        held = store.read(name, at)  # numbers get another scale: the table is written anew
        for c in scaled:
            held = widened(held, c, batch.schema[c].dataType.scale) if isinstance(batch.schema[c].dataType, T.DecimalType) else held
    elif v is not None:
        parts = store.touched(name, batch)
        held = store.read(name, at, parts)
    result = merge(held, batch, spec, now, started_at, always_touch)
    result.parts, result.base = parts, (v.number if v else 0)
    out = store.stage({name: result}, {name: layout} if v is None or kept_as else None)
    if kept_as:
        out.versions[kept_as] = replace(v)
    return out


def marked(store: Store, name: str, mark: Callable[[DataFrame], MergeResult]) -> Staged:
    """A stored table with rows marked, written but not announced; parts without a mark keep their files."""
    v = store.state().get(name)
    if v is None:
        return Staged()
    result = mark(store.read(name))
    result.base = v.number
    return store.stage({name: result})


def repeated(store: Store, make: Callable[[], Staged], source: str, **more) -> Staged:
    """Stage and announce; if another writer changed a table in between, do so again from what it left."""
    for attempt in range(MERGES):
        s = make()
        try:
            store.put(s, source, **more)
            return s
        except Conflict:
            if attempt == MERGES - 1:
                raise
            log.info("%s: another writer was first, merging anew", source)
    raise AssertionError

