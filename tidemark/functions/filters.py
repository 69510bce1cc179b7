"""Predicates over periods, nested record sets, cursors and leases."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.spec import MERGED_ON, SUPPORTED

Bound = date | datetime | str | None


def _moment(v: Bound) -> Column:
    return F.lit(v.isoformat(sep=" ") if isinstance(v, datetime) else str(v)).cast("timestamp_ntz")


def in_period(c: Column, start: Bound = None, end: Bound = None) -> Column:
    """Both bounds included; a bare date at the end includes its whole day."""
    tests = []
    if start is not None:
        tests.append(c >= _moment(start))
    if end is not None:
        whole_day = isinstance(end, date) and not isinstance(end, datetime)
        tests.append(c < _moment(end + timedelta(days=1)) if whole_day else c <= _moment(end))
    return reduce(lambda a, b: a & b, tests, F.lit(True)) if tests else F.lit(True)


def in_window(c: Column, start: Bound = None, end: Bound = None) -> Column:
    """Start included, end not; either side may be open, so windows that touch neither overlap nor leave a gap."""
    tests = ([c >= _moment(start)] if start is not None else []) + ([c < _moment(end)] if end is not None else [])
    return reduce(lambda a, b: a & b, tests, F.lit(True)) if tests else F.lit(True)


def any_record(records: Column, *conditions: Callable[[Column], Column]) -> Column:
    """One record of the set satisfies all conditions at once; then the whole entry stays."""
    return F.exists(records, lambda r: reduce(lambda a, b: a & b, (c(r) for c in conditions)))


def changed_since(cursor: datetime | str, *stamps: Column) -> Column:
    return reduce(lambda a, b: a | b, (s > F.lit(cursor).cast("timestamp") for s in stamps))


def untouched_since(moment: Column) -> Column:
    """A row that nothing has written since a run began."""
    return F.col(MERGED_ON).isNull() | (F.col(MERGED_ON) < moment)


def supported(name: Column) -> Column:
    return F.substring_index(name, "_", 1).isin(*SUPPORTED)


def listed(name: Column, is_table_part: Column, absent: Column) -> Column:
    """Objects to offer: of a supported class, no table part, and still in the source."""
    return F.coalesce(supported(name), F.lit(False)) & ~is_table_part.eqNullSafe(F.lit(True)) & ~absent.eqNullSafe(F.lit(True))


def pending_full_loads() -> Column:
    return F.col("full_load_is_required") & ~F.col("absent_from_metadata").eqNullSafe(F.lit(True))


def live(owner: Column, heartbeat: Column, now: Column, ttl_seconds: int) -> Column:
    return owner.isNotNull() & (heartbeat >= now - F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS"))


def literal_moment(c: Column) -> Column:
    """A moment as the source's filter language writes it: four-digit year, seconds."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
