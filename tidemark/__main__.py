"""``python -m tidemark``: replication as a loop with full loads in the background, or one cycle, set up by TIDEMARK_* variables."""

from __future__ import annotations

import logging
import os
import threading
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime
from typing import TYPE_CHECKING

from tidemark.sources.transport import HttpTransport

if TYPE_CHECKING:
    from tidemark.plans.full_load import FullLoadCron, FullLoads

MODES = ("loop", "once")


@dataclass
class Settings:
    transport: HttpTransport
    store: str
    mode: str
    poll_seconds: float
    threads: int
    retention_days: float
    automatic_full_load: bool
    log_level: str
    schedule: dict[str, tuple[str, int | None]]


def schedule(text: str) -> dict[str, tuple[str, int | None]]:
    """Scheduled loads, ``object=crontab`` or ``object=crontab@days``, separated by semicolons; with days, a tick loads only the last ones."""
    from tidemark.plans.full_load import Cron

    out: dict[str, tuple[str, int | None]] = {}
    for job in filter(None, map(str.strip, text.split(";"))):
        name, _, rest = job.partition("=")
        cron, at, days = rest.partition("@")
        if not name.strip() or name.strip() in out or at and not days.strip().isdigit():
            raise SystemExit("TIDEMARK_SCHEDULE has to be like object=5 fields of a crontab@days; once for an object")
        try:
            Cron(cron).after(datetime.now())
        except ValueError as e:
            raise SystemExit(f"TIDEMARK_SCHEDULE: {e}") from e
        out[name.strip()] = (cron.strip(), int(days) if at else None)
    return out


def _number(told: Mapping[str, str], name: str, default: str, least: float) -> float:
    try:
        out = float(told.get(name, "").strip() or default)
    except ValueError:
        out = float("nan")
    if not least <= out < float("inf"):
        raise SystemExit(f"{name} has to be a number from {least:g}")
    return out


def settings(told: Mapping[str, str]) -> Settings:
    """What the variables say, or an exit that names the one that is missing or wrong, never its value."""

    def required(name: str) -> str:
        if not (value := told.get(name, "").strip()):
            raise SystemExit(f"{name} is not set (required: TIDEMARK_URL, TIDEMARK_EXCHANGE, TIDEMARK_STORE)")
        return value

    mode, level = told.get("TIDEMARK_MODE", "loop"), told.get("TIDEMARK_LOG_LEVEL", "INFO").strip().upper()
    if mode not in MODES:
        raise SystemExit(f"TIDEMARK_MODE has to be one of {', '.join(MODES)}")
    if level not in logging.getLevelNamesMapping():
        raise SystemExit("TIDEMARK_LOG_LEVEL names no level")
    automatic = told.get("TIDEMARK_AUTOMATIC_FULL_LOAD", "true").strip().lower()
    if automatic not in ("true", "false", "1", "0", "yes", "no"):
        raise SystemExit("TIDEMARK_AUTOMATIC_FULL_LOAD has to be true or false")
    try:
        transport = HttpTransport(required("TIDEMARK_URL"), required("TIDEMARK_EXCHANGE"), told.get("TIDEMARK_NODE", ""), told.get("TIDEMARK_USER", ""), told.get("TIDEMARK_PASSWORD", ""), _number(told, "TIDEMARK_TIMEOUT_SECONDS", "600", 1))
    except ValueError as e:
        raise SystemExit(str(e)) from e
    return Settings(
        transport, required("TIDEMARK_STORE"), mode, _number(told, "TIDEMARK_POLL_SECONDS", "60", 0), int(_number(told, "TIDEMARK_FULL_LOAD_THREADS", "2", 1)),
        _number(told, "TIDEMARK_RETENTION_DAYS", "30", 0), automatic in ("true", "1", "yes"), level, schedule(told.get("TIDEMARK_SCHEDULE", "")),
    )


def scheduled(cron: FullLoadCron, loads: FullLoads, every: float = 1.0) -> None:
    """Run what is due until the loads are stopped; jobs of scheduled loads have the tag of the ordered ones."""
    loads.registry.store.spark.sparkContext.addJobTag(loads.tag)
    while not loads.stopping.wait(every):
        cron.run_due()


def main() -> None:
    s = settings(os.environ)
    logging.basicConfig(level=s.log_level, format="%(asctime)s %(levelname)s [%(threadName)s] %(message)s")
    from pyspark.sql import SparkSession

    from tidemark.plans.full_load import FullLoadCron, FullLoads, Keys, full_load
    from tidemark.plans.state import Claims
    from tidemark.plans.store import Store
    from tidemark.sources import metadata
    from tidemark.sources.odata import ODataSnapshot
    from tidemark.streaming.replicator import Replicator, rows_of

    spark = SparkSession.builder.appName("tidemark").config("spark.scheduler.mode", "FAIR").getOrCreate()
    store = Store(spark, s.store)
    read = lambda: metadata.parse(s.transport.metadata())
    specs = read()
    r = Replicator(spark, store, s.transport, specs, read_metadata=read)
    r.registry.sync(specs.values())
    claims = Claims(store)
    source = ODataSnapshot(spark, s.transport, lambda e, spec: rows_of(e, spec, r.specs, 0))

    def load(name: str, stop: threading.Event, since: date | None = None) -> int:
        return full_load(store, source, r.specs, name, date_from=since, started_at=datetime.now(), claims=claims, stop=stop)

    loads = FullLoads(r.registry, load, s.threads)
    if unknown := sorted(s.schedule.keys() - {n for n, x in specs.items() if not x.is_table_part}):
        raise SystemExit(f"TIDEMARK_SCHEDULE names objects that the source doesn't have: {', '.join(unknown)}")
    cron = FullLoadCron(r.registry, lambda name, since: load(name, loads.stopping, since), s.schedule)
    if s.mode == "once":
        r.run_once()
        return
    Keys.drop_orphans(store)
    ticks = threading.Thread(target=scheduled, args=(cron, loads), name="schedule")
    if s.schedule:  # beside the feed, as a load may take hours
        ticks.start()
    grown = datetime.now()
    try:
        while not r.stopping.is_set():
            r.run_forever(s.poll_seconds, max_iterations=1)
            if s.automatic_full_load:
                loads.dispatch()
            if (datetime.now() - grown).days:  # once a day
                grown = datetime.now()
                for name in store.state():
                    store.grow(name)
                if s.retention_days:
                    store.vacuum(retention=s.retention_days * 86_400)
            r.stopping.wait(s.poll_seconds)
    except KeyboardInterrupt:
        r.stop()
    finally:
        loads.stop()
        while ticks.is_alive():  # its jobs are cancelled again and again, as the next one may have begun
            spark.sparkContext.cancelJobsWithTag(loads.tag)
            ticks.join(0.2)


if __name__ == "__main__":
    main()
