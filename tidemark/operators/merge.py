"""Merges as pure functions of frames: what a batch makes of a table, with the action taken on every row."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.filters import untouched_since
from tidemark.spec import DELETED, INSERTED_ON, MERGED_ON, MESSAGE_NO, NOISE, TableSpec

ACTION = "_action"


@dataclass
class MergeResult:
    """``rows`` is the new table, or the new content of its ``parts``, with ``_action``; nothing runs before it is read."""

    rows: DataFrame
    added_fields: tuple[str, ...] = ()
    #: Labels of the table's parts that the rows are the whole of; None is all of them.
    parts: list[str] | None = None
    #: Number of the table's version that the merge was made from, where its maker says so.
    base: int | None = None

    @property
    def table(self) -> DataFrame:
        return self.rows.where(F.col(ACTION) != "removed").drop(ACTION)

    def counts(self) -> DataFrame:
        """One row: inserted, updated, deleted (marks and removals), total rows of the batch's table."""
        n = lambda *a: F.count(F.when(F.col(ACTION).isin(*a), 1))
        return self.rows.agg(n("inserted").alias("inserted"), n("updated").alias("updated"), n("deleted", "removed").alias("deleted"), F.count(F.lit(1)).alias("total"))

    def rows_modified(self) -> int:
        r = self.counts().first()
        return r["inserted"] + r["updated"] + r["deleted"]


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _unique(batch: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """The batch, failing loudly once two rows have one key: counting by key needs the shuffle that the merge needs anyway."""
    from pyspark.sql import Window

    n = F.count(F.lit(1)).over(Window.partitionBy(*pk))
    return batch.withColumn("__once", F.when(n > 1, F.raise_error(F.lit(f"two rows of a batch have one key {pk}")).cast("boolean")).otherwise(True)).where("__once").drop("__once")


def merge(target: DataFrame | None, batch: DataFrame, spec: TableSpec, now: Column, started_at: Column | None = None, always_touch: bool = False) -> MergeResult:
    """Merge a batch of changes, or (with ``started_at``) a page of a snapshot that was begun then.

    A row of both sides changes if a column outside the noise differs, and then takes all columns of the batch; a row
    equal but for noise stays byte for byte. Rows of a group that the batch delivers without them are marked and their
    numeric resources become null. A snapshot leaves alone what was written since it began, and adds no row to a group
    in which a change was. ``always_touch`` counts noise as a difference. All guards look at the table before the merge.
    """
    pk, group = list(spec.pk), list(spec.group_key)
    service = {MERGED_ON, INSERTED_ON}
    fields = [c for c in batch.columns if c not in service]
    if target is None:
        rows = _unique(batch.select(*fields), spec.pk)
        rows = rows.withColumns({MERGED_ON: now, INSERTED_ON: now, ACTION: F.lit("inserted")})
        return MergeResult(rows, tuple(fields))
    old = [c for c in target.columns if c not in service]
    added = tuple(c for c in fields if c not in old)
    values = [c for c in fields if c not in pk]

    t = target.select(*pk, F.lit(True).alias("__t"), *[F.col(c).alias(f"t_{c}") for c in [*old, MERGED_ON, INSERTED_ON] if c not in pk])
    s = _unique(batch.select(*fields), spec.pk).select(*pk, F.lit(True).alias("__s"), *[F.col(c).alias(f"s_{c}") for c in values])
    both = t.join(s, pk, "full_outer")
    if group:
        both = both.join(batch.select(*group).distinct().withColumn("__g", F.lit(True)), group, "left")
        if started_at is not None:
            hot = target.where((F.col(MERGED_ON) >= started_at) & ~F.col(MESSAGE_NO).eqNullSafe(F.lit(0)))
            both = both.join(hot.select(*group).distinct().withColumn("__hot", F.lit(True)), group, "left")

    in_t, in_s = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    ignored = () if always_touch else NOISE
    differs = _any([~F.col(f"s_{c}").eqNullSafe(F.col(f"t_{c}")) for c in values if c in old and c not in ignored] + [F.col(f"s_{c}").isNotNull() for c in added if c not in ignored])
    may_write = F.lit(True) if started_at is None else F.col(f"t_{MERGED_ON}").isNull() | (F.col(f"t_{MERGED_ON}") < started_at)
    may_add = F.col("__hot").isNull() if group and started_at is not None else F.lit(True)
    flag = F.coalesce(F.col(f"t_{DELETED}"), F.lit(False)) if DELETED in old else F.lit(False)
    gone = F.col("__g").isNotNull() & ~flag & may_write if group else F.lit(False)
    action = (
        F.when(in_t & in_s & differs & may_write, "updated")
        .when(in_t & ~in_s & gone, "deleted")
        .when(in_t, "kept")
        .when(may_add, "inserted")
    )
    both = both.withColumn(ACTION, action).where(F.col(ACTION).isNotNull())

    taken = F.col(ACTION).isin("updated", "inserted")
    reset = [r for r in spec.numeric_resources if r in fields]
    out: list[Column] = []
    for c in [*old, *added]:
        if c in pk:
            out.append(F.col(c))
            continue
        was = F.col(f"t_{c}") if c in old else F.lit(None).cast(batch.schema[c].dataType)
        value = F.when(taken, F.col(f"s_{c}")).otherwise(was) if c in values else was
        if c == DELETED:
            value = F.when(F.col(ACTION) == "deleted", True).otherwise(value)
        elif c in reset:
            value = F.when(F.col(ACTION) != "deleted", value)
        out.append(value.alias(c))
    moved = F.col(ACTION) != "kept"
    out.append(F.when(moved, now).otherwise(F.col(f"t_{MERGED_ON}")).alias(MERGED_ON))
    out.append(F.when(F.col(ACTION) == "inserted", now).otherwise(F.col(f"t_{INSERTED_ON}")).alias(INSERTED_ON))
    return MergeResult(both.select(*out, ACTION), added)


def _marked(rows: DataFrame, target: DataFrame, spec: TableSpec, now: Column, hit: Column, reset: bool) -> MergeResult:
    resources = set(spec.numeric_resources) if reset else set()
    out = []
    for c in target.columns:
        if c == DELETED:
            out.append(F.when(hit, True).otherwise(F.col(c)).alias(c))
        elif c == MERGED_ON:
            out.append(F.when(hit, now).otherwise(F.col(c)).alias(c))
        elif c in resources:
            out.append(F.when(~hit, F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return MergeResult(rows.select(*out, F.when(hit, "deleted").otherwise("kept").alias(ACTION)))


def mark_missing(target: DataFrame, seen: DataFrame, spec: TableSpec, now: Column, started_at: Column, scope: Column | None = None) -> MergeResult:
    """After a whole snapshot: rows in scope that it didn't contain, older than its start and not yet marked, are marked.

    ``seen`` may repeat keys. Numeric resources of marked rows become null.
    """
    rows = target.join(seen.select(*spec.pk).distinct().withColumn("__seen", F.lit(True)), list(spec.pk), "left")
    hit = F.col("__seen").isNull() & ~F.coalesce(F.col(DELETED), F.lit(False)) & untouched_since(started_at)
    return _marked(rows, target, spec, now, F.coalesce(hit & scope if scope is not None else hit, F.lit(False)), reset=True)


def mark_orphans(parts: DataFrame, owners: DataFrame, spec: TableSpec, now: Column, started_at: Column, owner_key: str = "Ref_Key") -> MergeResult:
    """Rows of a table part whose owner is marked, by the owner's state; resources stay."""
    gone = owners.where(F.col(DELETED)).select(owner_key).distinct().withColumn("__gone", F.lit(True))
    rows = parts.join(gone, owner_key, "left").select(*[parts[c] for c in parts.columns], "__gone")
    hit = F.col("__gone").isNotNull() & ~F.coalesce(F.col(DELETED), F.lit(False)) & untouched_since(started_at)
    return _marked(rows, parts, spec, now, F.coalesce(hit, F.lit(False)), reset=False)


def _same(left: Column, right: Column, nullable: bool) -> Column:
    """Equal, nulls too; keys that are never null meet by plain equality, which needs no new deal of rows dealt by them."""
    return left.eqNullSafe(right) if nullable else left == right


def merge_mart(target: DataFrame | None, fresh: DataFrame, key: list[str], now: Column, scope: Column | None = None, scope_keys: DataFrame | None = None, delete: bool = False) -> MergeResult:
    """Bring a mart to what was recomputed: upsert by key, and with ``delete`` remove what has vanished within the scope.

    The scope is a condition on the mart's columns or a frame of keys; None is the whole mart. ``fresh`` has to be
    restricted alike.
    """
    values = [c for c in fresh.columns if c not in key]
    null = {c for f in (target, fresh, scope_keys) if f is not None for c in f.columns if f.schema[c].nullable}
    if target is None:
        return MergeResult(fresh.withColumns({MERGED_ON: now, INSERTED_ON: now, ACTION: F.lit("inserted")}))
    cols = [c for c in target.columns if c not in (*key, MERGED_ON, INSERTED_ON)]
    t = target.select(*[F.col(c).alias(f"k_{c}") for c in key], F.lit(True).alias("__t"), *[F.col(c).alias(f"t_{c}") for c in [*cols, MERGED_ON, INSERTED_ON]])
    if scope is not None:
        inside = target.select(*key, F.coalesce(scope, F.lit(False)).alias("__in"), *cols, MERGED_ON, INSERTED_ON)
        t = inside.select(*[F.col(c).alias(f"k_{c}") for c in key], F.lit(True).alias("__t"), "__in", *[F.col(c).alias(f"t_{c}") for c in [*cols, MERGED_ON, INSERTED_ON]])
    elif scope_keys is not None:
        k = scope_keys.select(*[F.col(c).alias(f"x_{c}") for c in scope_keys.columns]).distinct().withColumn("__in", F.lit(True))
        t = t.join(k, _all([_same(F.col(f"k_{c}"), F.col(f"x_{c}"), c in null) for c in scope_keys.columns]), "left").withColumn("__in", F.coalesce("__in", F.lit(False)))
    else:
        t = t.withColumn("__in", F.lit(True))
    s = fresh.select(*[F.col(c).alias(f"f_{c}") for c in key], F.lit(True).alias("__s"), *[F.col(c).alias(f"s_{c}") for c in values])
    both = t.join(s, _all([_same(F.col(f"k_{c}"), F.col(f"f_{c}"), c in null) for c in key]), "full_outer")
    in_t, in_s = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    differs = _any([~F.col(f"s_{c}").eqNullSafe(F.col(f"t_{c}")) for c in values])
    action = F.when(in_t & in_s & differs, "updated").when(in_t & in_s, "kept").when(in_s, "inserted").when(F.lit(delete) & F.col("__in"), "removed").otherwise("kept")
    both = both.withColumn(ACTION, action)
    keep_old = F.col(ACTION).isin("kept", "removed")
    out = [F.coalesce(F.col(f"k_{c}"), F.col(f"f_{c}")).alias(c) for c in key]
    out += [(F.when(keep_old, F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")) if c in values else F.col(f"t_{c}")).alias(c) for c in cols]
    out.append(F.when(keep_old, F.col(f"t_{MERGED_ON}")).otherwise(now).alias(MERGED_ON))
    out.append(F.coalesce(F.col(f"t_{INSERTED_ON}"), now).alias(INSERTED_ON))
    return MergeResult(both.select(*out, ACTION))
