"""Store, full loads, leases, registry and the mart runner."""

import threading
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import marts
from tidemark.operators.evolve import evolve, retired_name, widened
from tidemark.operators.merge import merge, merge_mart
from tidemark.plans import full_load as fl
from tidemark.plans.mart_runner import MartContext, MartLoop, MartRunner, checked, run_all
from tidemark.plans.state import Claims, InFlight, Lease, Registry, Write, boundary, totals
from tidemark.plans.store import Conflict, LostLease, Staged, Store, layout_of
from tidemark.spec import TableSpec

DOC = TableSpec("Document_D", {"Ref_Key": "String", "Date": "DateTime", "Sum": "Double"}, ("Ref_Key",), parts=("Document_D_Rows",))
PART = TableSpec("Document_D_Rows", {"Ref_Key": "String", "LineNumber": "Int64", "V": "String"}, ("Ref_Key", "LineNumber"), ("Ref_Key",), is_table_part=True)
SPECS = {s.name: s for s in (DOC, PART)}


def at(n):
    return F.lit(datetime(2024, 1, 1) + timedelta(days=n)).cast("timestamp_ntz")


def docs(spark, *data):
    return spark.createDataFrame([(k, datetime(2024, m, 5), s, False) for k, m, s in data], "Ref_Key string, Date timestamp_ntz, Sum int, is_deleted_or_empty boolean").withColumn("exchange_message_no", F.lit(1).cast("long"))


def parts(spark, *data):
    return spark.createDataFrame([(k, n, v, False) for k, n, v in data], "Ref_Key string, LineNumber long, V string, is_deleted_or_empty boolean")


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def test_versions_and_no_empty_commits(spark, store):
    assert store.head() == 0 and store.read("T") is None
    b = docs(spark, ("a", 1, 1), ("b", 2, 2))
    store.publish({"T": merge(None, b, DOC, at(0))}, "one")
    assert store.publish({"T": merge(store.read("T"), b, DOC, at(1))}, "two")["T"]["updated"] == 0
    assert store.head() == 1
    store.publish({"T": merge(store.read("T"), docs(spark, ("b", 2, 3)), DOC, at(2))}, "three")
    assert rows(store.read("T"), "Ref_Key", "Sum") == [("a", 1), ("b", 3)]
    assert rows(store.read("T", 1), "Ref_Key", "Sum") == [("a", 1), ("b", 2)]
    assert totals(store.log())["T"] == {"inserted": 2, "updated": 1, "deleted": 0, "rows_modified": 3}
    assert store.vacuum(keep=1, age=0, retention=3600) == 0 and store.head() == 2 and store.commit(1)
    assert store.vacuum(keep=1) == 0 and store.vacuum(keep=1, age=0) == 1 and store.log() and len(store.files.names("_commits")) == 1 and store.read("T").count() == 2


def test_partitioned_table_rewrites_touched_months(spark, store):
    by = {"T": "Date"}
    store.publish({"T": merge(None, docs(spark, ("a", 1, 1), ("b", 2, 2), ("c", 3, 3)), DOC, at(0))}, "one", by)
    before = store.state()["T"].paths
    store.publish({"T": merge(store.read("T"), docs(spark, ("b", 3, 2)), DOC, at(1))}, "moves", by)  # b leaves February
    after = store.state()["T"].paths
    assert after["2024-01"] == before["2024-01"] and "2024-02" not in after and after["2024-03"] != before["2024-03"]
    assert rows(store.read("T"), "Ref_Key") == [("a",), ("b",), ("c",)]


def test_one_of_two_writers_wins(spark, store):
    assert store.files.create("_commits/000000000001.json", "{}")
    assert not store.files.create("_commits/000000000001.json", "{}")
    r, _ = store.document("x")
    store.replace_document("x", r, {"n": 1})
    with pytest.raises(Conflict):
        store.replace_document("x", r, {"n": 2})
    for n in range(8):
        r, held = store.document("x")
        store.replace_document("x", r, held | {"n": n})
    assert store.document("x")[1] == {"n": 7}


def test_leases(store):
    now = [0.0]
    a, b = (Lease(store, "feed", o, ttl=10, clock=lambda: now[0]) for o in "ab")
    assert a.acquire() and not b.acquire() and a.still_mine()
    now[0] = 11
    assert not a.still_mine() and b.acquire() and not a.heartbeat()
    assert b.release() and a.acquire()


def test_registry(store):
    r = Registry(store)
    r.sync([DOC, PART])
    assert r.require_full_load("Document_D", only_if_new=True) and r.pending() == ["Document_D"]
    r.mark_full_loaded("Document_D", 3, 0.5)
    assert r.was_fully_loaded("Document_D") and not r.require_full_load("Document_D", only_if_new=True) and r.pending() == []
    r.require_full_load("Document_D")
    r.sync([PART])
    assert r.objects()["Document_D"]["absent_from_metadata"] and r.pending() == []
    with pytest.raises(ValueError):
        r.resolve("Nope", {})
    assert r.resolve("t", {"t": "Document_D"}) == "Document_D"


def test_boundary_and_retention():
    w = [Write(("A",), 5, 99), Write(("A", "B"), 3, 1), Write(("B",), 4, 95)]
    assert boundary(100, w, ["A"]) == 5 and boundary(100, w, ["B"]) == 4 and boundary(100, w, ["C"]) == 100


def chained(windows):
    """The windows in order of time, each beginning where the last ended."""
    out = sorted(windows, key=lambda w: (w.start is not None, w.start))
    assert all(a.end == b.start for a, b in zip(out, out[1:]))
    return out


def test_walk_covers_everything_in_touching_windows():
    anchor, oldest, rounds = datetime(2024, 6, 1), datetime(2022, 12, 15), []

    def read(asks):
        rounds.append(asks)
        days = [(a.window.end - a.window.start).days if a.window.start and a.window.end else 0 for a in asks]
        return [fl.Read(5, not (a.may_refuse and d > 10)) for a, d in zip(asks, days)]

    done = chained(fl.walk(read, anchor, oldest))
    assert done[-1] == fl.Window(anchor, None) and done[0].start <= oldest < done[0].end
    assert max((w.end - w.start).days for w in done[:-1]) == 10
    assert len(rounds) <= 4 and len(rounds[0]) == fl.FIRST_ROUND + 1  # windows are asked for side by side


def test_walk_ends_after_three_empty_windows():
    asked = []
    done = chained(fl.walk(lambda asks: asked.extend(asks) or [fl.Read(0) for _ in asks], datetime(2024, 1, 1)))
    assert len(done) == len(asked) == fl.FIRST_ROUND + 2 and done[0].start is None
    assert chained(fl.walk(lambda asks: [fl.Read(0) for _ in asks], datetime(3, 1, 1), days=300))[0].start is None  # where the calendar ends


def test_walk_cuts_open_windows_that_are_too_heavy():
    def read(asks):
        return [fl.Read(1 if a.window.start and a.window.start < datetime(2024, 5, 1) else 0, not (a.may_refuse and a.window.end is None and a.window.start < datetime(2024, 3, 1))) for a in asks]

    done = chained(fl.walk(read, datetime(2024, 1, 1), datetime(2023, 12, 20)))
    assert done[-1].end is None and done[-1].start >= datetime(2024, 5, 1) and done[0].start <= datetime(2023, 12, 20)


def test_walk_of_a_period_stays_in_it():
    start, end = datetime(2024, 1, 10), datetime(2024, 4, 20)
    for oldest in (None, datetime(2020, 1, 1), datetime(2024, 2, 1)):
        done = chained(fl.walk(lambda asks: [fl.Read(1) for _ in asks], datetime(2024, 4, 1), oldest, start, end))
        assert done[-1].end == end and (done[0].start == start or oldest and start <= done[0].start <= oldest)


def test_page_size():
    p = fl.PageSize(1000)
    assert p.after(10, 32 << 20) == 10 and p.after(1, 100) == 1000
    assert p.refused() == 250 and p.after(1, 100) == 250
    for _ in range(9):
        p.refused()
    assert p.size == 1


def test_full_load_in_windows_reads_entries_without_a_date(spark, store):
    d = docs(spark, ("a", 1, 1), ("b", 5, 2), ("c", 6, 3)).withColumn("Date", F.when(F.col("Ref_Key") != "c", F.col("Date")))
    source = fl.FrameSnapshot({"Document_D": d, "Document_D_Rows": parts(spark, ("a", 1, "x"), ("c", 1, "y"))}, {"Document_D": ("Document_D_Rows",)}, limit=1)
    when = datetime(2024, 7, 1)
    assert fl.full_load(store, source, SPECS, "Document_D", "Date", started_at=when, now=when + timedelta(hours=1)) == 5
    assert rows(store.read("Document_D"), "Ref_Key") == [("a",), ("b",), ("c",)] and rows(store.read("Document_D_Rows"), "Ref_Key") == [("a",), ("c",)]


def test_full_load_marks_what_vanished_and_is_idle_after(spark, store):
    source = fl.FrameSnapshot({"Document_D": docs(spark, ("a", 1, 1), ("b", 2, 2), ("c", 5, 3)).drop("exchange_message_no"), "Document_D_Rows": parts(spark, ("a", 1, "x"), ("b", 1, "y"))}, {"Document_D": ("Document_D_Rows",)}, limit=1)
    run = lambda n, **more: fl.full_load(store, source, SPECS, "Document_D", "Date", started_at=datetime(2024, 1, 1) + timedelta(days=n), now=datetime(2024, 1, 1) + timedelta(days=n, hours=1), **more)
    assert run(0) == 5 and run(1) == 0
    source.frames["Document_D"] = docs(spark, ("a", 1, 1), ("c", 5, 3)).drop("exchange_message_no")
    assert run(2) == 2  # the document and its part's row
    assert rows(store.read("Document_D"), "Ref_Key", "is_deleted_or_empty") == [("a", False), ("b", True), ("c", False)]
    assert rows(store.read("Document_D_Rows"), "Ref_Key", "is_deleted_or_empty") == [("a", False), ("b", True)]
    assert run(3) == 0
    with pytest.raises(ValueError, match="table part"):
        fl.full_load(store, source, SPECS, "Document_D_Rows")
    with pytest.raises(ValueError, match="field"):
        fl.full_load(store, source, SPECS | {"Catalog_C": TableSpec("Catalog_C", {"Ref_Key": "Guid"}, ("Ref_Key",))}, "Catalog_C", date_from="2024-01-01")


def test_ordered_loads_back_off(spark, store):
    now, done = [0.0], []
    registry = Registry(store)
    for n in ("Document_Bad", "Document_Busy", "Document_Good"):
        registry.require_full_load(n)

    def load(n, stop):
        if n == "Document_Bad":
            raise OSError("no")
        if n == "Document_Busy":
            raise fl.Busy(n)
        done.append(n)
        return 3

    pool = fl.FullLoads(registry, load, clock=lambda: now[0])
    assert pool.dispatch() == ["Document_Bad", "Document_Busy", "Document_Good"]
    pool.wait()
    assert done == ["Document_Good"] and registry.pending() == ["Document_Bad", "Document_Busy"] and registry.objects()["Document_Good"]["last_full_load_rows_modified"] == 3
    assert pool.dispatch() == ["Document_Busy"]  # the failed one is held back
    pool.wait()
    now[0] = 121
    assert "Document_Bad" in pool.dispatch()
    pool.wait()
    assert pool.waits["Document_Bad"][0] == 121 + 240 and isinstance(pool.failures["Document_Bad"], OSError)
    pool.stop()
    assert pool.dispatch() == []
    assert fl.Backoff(60).failed(permanent=True) == 1800


def test_cron():
    at = datetime(2024, 2, 28, 23, 50)
    assert fl.Cron("*/15 * * * *").after(at) == datetime(2024, 2, 29) and fl.Cron("0 0 29 2 *").after(at) == datetime(2024, 2, 29)
    assert fl.Cron("30 4 * * 1-5").after(datetime(2024, 3, 1, 5)) == datetime(2024, 3, 4, 4, 30) and fl.Cron("0 12 13 * 5").after(datetime(2024, 3, 9)) == datetime(2024, 3, 13, 12)
    assert fl.Cron("5 1 * * 7").after(at) == datetime(2024, 3, 3, 1, 5) and fl.Cron("0 0 29 2 *").after(datetime(2024, 3, 1)) == datetime(2028, 2, 29)
    for bad in ("* * * *", "60 * * * *", "a * * * *", "0 0 31 2 *", "5-1 * * * *"):
        with pytest.raises(ValueError):
            fl.Cron(bad).after(at)


def test_scheduled_loads(store):
    now, ran, registry = [datetime(2024, 5, 1, 10, 0)], [], Registry(store)
    cron = fl.FullLoadCron(registry, lambda n, since: ran.append((n, since)) or 1, {"Document_D": ("0 * * * *", 7)}, lambda: now[0])
    assert cron.run_due() == {}
    now[0] = datetime(2024, 5, 1, 13, 30)  # two ticks were missed: one load
    assert cron.run_due() == {"Document_D": 1} and ran == [("Document_D", None)] and registry.was_fully_loaded("Document_D") and cron.run_due() == {}
    told = registry.objects()["Document_D"]["last_full_load_at"]
    now[0] = datetime(2024, 5, 1, 14, 0)
    assert cron.run_due() and ran[-1] == ("Document_D", datetime(2024, 4, 24).date()) and registry.objects()["Document_D"]["last_full_load_at"] == told


def test_windows_are_counted_without_a_copy_of_the_rows_for_each(spark):
    d = docs(spark, ("a", 1, 1), ("b", 2, 2), ("b", 2, 2), ("c", 5, 3)).withColumn("Date", F.when(F.col("Ref_Key") != "c", F.col("Date")))
    source = fl.FrameSnapshot({"Document_D": d.unionByName(d.where("Ref_Key = 'a'").withColumn("Ref_Key", F.lit(None).cast("string")))})
    day = lambda m: datetime(2024, m, 1)
    asks = [fl.Ask(w) for w in (fl.Window(day(1), day(2)), fl.Window(day(2), None), fl.Window(None, None), fl.Window(None, None, undated=True), fl.Window(day(9), None))]
    assert [r.entries for r in source.fetch(SPECS["Document_D"], "Date", asks, "").reads] == [2, 1, 4, 1, 0]
    assert "Expand" not in source.counts(SPECS["Document_D"], "Date", asks)._jdf.queryExecution().executedPlan().toString()


def test_full_load_of_a_period_takes_its_parts_only(spark, store):
    frames = {"Document_D": docs(spark, ("a", 1, 1), ("b", 2, 2)).drop("exchange_message_no"), "Document_D_Rows": parts(spark, ("a", 1, "x"), ("b", 1, "y"))}
    source = fl.FrameSnapshot(frames, {"Document_D": ("Document_D_Rows",)})
    when = datetime(2024, 7, 1)
    run = lambda n, **more: fl.full_load(store, source, SPECS, "Document_D", "Date", started_at=when + timedelta(days=n), now=when + timedelta(days=n, hours=1), **more)
    assert run(0, date_from="2024-02-01") == 2 and rows(store.read("Document_D_Rows"), "Ref_Key") == [("b",)]
    assert run(1) == 2
    frames["Document_D"] = docs(spark, ("b", 2, 2)).drop("exchange_message_no")
    assert run(2, date_from="2024-02-01") == 0  # what lies outside the period is not marked
    assert run(3) == 2 and store.files.names("_keys") == []


def test_marking_follows_what_was_loaded(spark, store):
    """A row that vanishes from the source after its window was read is not marked by this load, a new one not spared."""
    whole = docs(spark, ("a", 1, 1), ("b", 2, 2)).drop("exchange_message_no")
    source = fl.FrameSnapshot({"Document_D": whole, "Document_D_Rows": parts(spark)}, {"Document_D": ("Document_D_Rows",)})
    when = datetime(2024, 7, 1)
    fl.full_load(store, source, SPECS, "Document_D", started_at=when, now=when + timedelta(hours=1))

    class Moves(fl.FrameSnapshot):
        def fetch(self, *a):
            out = super().fetch(*a)
            self.frames["Document_D"] = whole.limit(0)
            return out

    moving = Moves(dict(source.frames), source.parts)
    assert fl.full_load(store, moving, SPECS, "Document_D", started_at=when + timedelta(days=1), now=when + timedelta(days=1, hours=1)) == 0
    assert fl.full_load(store, moving, SPECS, "Document_D", started_at=when + timedelta(days=2), now=when + timedelta(days=2, hours=1)) == 2


def test_full_load_with_another_type_or_key(spark, store):
    when = datetime(2024, 7, 1)
    source = fl.FrameSnapshot({"Document_D": docs(spark, ("a", 1, 1)).drop("exchange_message_no"), "Document_D_Rows": parts(spark)}, {"Document_D": ("Document_D_Rows",)})
    run = lambda n: fl.full_load(store, source, SPECS, "Document_D", started_at=when + timedelta(days=n), now=when + timedelta(days=n, hours=1))
    run(0)
    source.frames["Document_D"] = docs(spark, ("a", 1, 1)).drop("exchange_message_no").withColumn("Sum", F.lit("one"))
    assert run(1) == 1
    t = store.read("Document_D")
    old = [c for c in t.columns if c.startswith("Sum_Old_")]
    assert rows(t, "Sum", *old) == [("one", 1)]
    source.frames["Document_D"] = docs(spark, ("a", 1, 1)).drop("exchange_message_no").withColumn("Ref_Key", F.lit(7))
    run(2)
    assert rows(store.read("Document_D"), "Ref_Key") == [(7,)]
    aside = [n for n in store.state() if n.startswith("Document_D_Old_")]
    assert len(aside) == 1 and rows(store.read(aside[0]), "Ref_Key") == [("a",)]


def test_claims_stop_and_orphaned_keys(spark, store):
    source = fl.FrameSnapshot({"Document_D": docs(spark, ("a", 1, 1)).drop("exchange_message_no"), "Document_D_Rows": parts(spark)}, {"Document_D": ("Document_D_Rows",)})
    mine, other = Claims(store, "one"), Claims(store, "two")
    with mine.hold("Document_D") as a, mine.hold("Document_D") as again, other.hold("Document_D") as b:
        assert a and again and not b and other.live() == {"Document_D"} and mine.covers("Document_D_Rows", {"Document_D_Rows": "Document_D"})
        with pytest.raises(fl.Busy):
            fl.full_load(store, source, SPECS, "Document_D", claims=other)
    assert mine.live() == set()
    stop = threading.Event()
    stop.set()
    with pytest.raises(fl.Stopped):
        fl.full_load(store, source, SPECS, "Document_D", stop=stop)
    assert store.state() == {}
    fl.Keys(store, "x", clock=lambda: 1000.0).add(spark.range(1))
    assert fl.Keys.drop_orphans(store, 1000 + 3600) == 0 and fl.Keys.drop_orphans(store, 1001 + 24 * 3600) == 1


def test_abandoned_writes_are_told(store):
    now = [100.0]
    f = InFlight(store, ttl=90, clock=lambda: now[0])
    with f.track(["A"]):
        now[0] = 120
        assert f.boundary(["A"]) == 100 and f.boundary(["B"]) == 120 and not f.deliver()
    assert f.writes() == {} and f.boundary(["A"]) == 120
    with pytest.raises(OSError), f.track(["A", "B"], "package 3"):
        raise OSError("died")
    now[0] = 205
    assert not f.deliver()
    now[0] = 300
    assert [w.objects for w in f.deliver()] == [("A", "B")] and not f.writes()
    assert [(e["table"], e["source"], e["forced"]) for e in store.log()] == [("A", "package 3", True), ("B", "package 3", True)]


def test_commits_of_other_tables_are_put_behind(spark, store):
    staged = store.stage({"T": merge(None, docs(spark, ("a", 1, 1)), DOC, at(0))})
    store.publish({"U": merge(None, docs(spark, ("a", 1, 1)), DOC, at(0))}, "first")
    late = store.stage({"U": merge(store.read("U"), docs(spark, ("a", 1, 2)), DOC, at(1))})
    assert store.put(staged, "second") == 2 and store.versions() == {"T": 2, "U": 1}
    store.publish({"U": merge(store.read("U"), docs(spark, ("a", 1, 3)), DOC, at(2))}, "third")
    with pytest.raises(Conflict):
        store.put(late, "from an older version")
    assert store.head() == 3 and rows(store.read("U"), "Sum") == [(3,)]


def test_a_replaced_owner_commits_nothing(spark, store, monkeypatch):
    """Asleep between its look at the fence and its commit, it finds the number taken, and then the other's epoch."""
    now = [0.0]
    a, b = (Lease(store, "feed", o, ttl=10, clock=lambda: now[0]) for o in "ab")
    assert a.acquire()
    staged = store.stage({"U": merge(None, docs(spark, ("a", 1, 4)), DOC, at(3))})
    create = store.files.create

    def sleeps(name, text):
        monkeypatch.setattr(store.files, "create", create)
        now[0] = 11
        assert b.acquire() and b.epoch == a.epoch + 1
        return create(name, text)

    monkeypatch.setattr(store.files, "create", sleeps)
    with pytest.raises(LostLease):
        store.put(staged, "late", fence=a.fence)
    assert store.state() == {} and store.put(staged, "mine", fence=b.fence) and store.read("U").count() == 1
    assert b.release() and b.acquire() and b.epoch == a.epoch + 1  # nobody was in between: no further epoch


def test_owners_have_names_of_their_own(spark, store):
    from tidemark.plans.state import unique

    a, b = Claims(store), Claims(store)
    assert unique("x") != unique("x")
    with a.hold("Document_D") as mine, b.hold("Document_D") as other:
        assert mine and not other


def test_readers_that_lag_keep_their_commit(spark, store):
    for n in range(6):
        store.publish({"T": merge(store.read("T"), docs(spark, ("a", 1, n)), DOC, at(n))}, f"package {n}", state={"mart-m": {"cursor": {"__commit": 1}}} if n == 1 else None)
    store.vacuum(keep=1, age=0)
    assert store.files.names("_commits") == [f"{n:012d}.json" for n in (1, 6)]
    assert rows(store.read("T", 1), "Sum") == [(0,)] and rows(store.changes("T", ["Ref_Key"], 1), "Sum") == [(5,)]


def test_windows_of_change_times_list_what_they_need(spark, store):
    layouts = {"T": layout_of(DOC)}
    store.publish({"T": merge(None, docs(spark, *[(f"k{n}", 1, n) for n in range(200)]), DOC, at(0))}, "all", layouts)
    batch = docs(spark, ("k7", 2, 70))
    parts = store.touched("T", batch)
    result = merge(store.read("T", parts=parts), batch, DOC, at(5))
    result.parts = parts
    store.publish({"T": result}, "one")
    late = store.read_window("T", "merged_on", datetime(2024, 1, 4))
    assert rows(late, "Ref_Key") == [("k7",)] and len(late.inputFiles()) == 1 < len(store.read("T").inputFiles())
    early = store.read_window("T", "merged_on", None, datetime(2024, 1, 2))
    assert early.count() == 199 and store.read_window("T", "Date", datetime(2025, 1, 1)).count() == 0


def test_a_held_lease_is_renewed(store):
    import time

    a, b = (Lease(store, "long", o, ttl=0.6) for o in "ab")
    with a.hold() as mine:
        time.sleep(1.5)
        assert mine and a.still_mine() and not b.acquire()
    assert b.acquire()


def test_schema_changes(spark):
    t = spark.createDataFrame([("a", "1")], "k string, v string")
    out, retired, added = evolve(t, spark.createDataFrame([("a", 1, 2)], "k string, v long, w int"), ["k"])
    assert added == ["w"] and list(retired) == ["v"] and out.first().asDict() == {"k": "a", retired["v"]: "1", "v": None}
    assert evolve(t, spark.createDataFrame([(1, "x")], "k long, v string"), ["k"])[0] is None
    assert retired_name("v", {retired_name("v", set())}) != retired_name("v", set())
    d = spark.sql("select cast(1.5 as decimal(38,10)) as n")
    assert str(widened(d, "n", 2).first()[0]) == "1.50"
    with pytest.raises(Exception, match="decimals"):
        widened(d, "n", 0).collect()


class SumByMonth:
    """A mart of sums by month, incremental by affected months."""

    NAME, ON = "sums", ["Document_D"]

    def fresh(self, t):
        return t.where("not is_deleted_or_empty").groupBy(marts.month(F.col("Date")).alias("m")).agg(F.sum("Sum").alias("s"))

    def process_changes(self, c):
        now, was = c.source("Document_D"), c.before("Document_D")
        moved = now.exceptAll(was).unionByName(was.exceptAll(now)) if was is not None else now
        keys = moved.select(marts.month(F.col("Date")).alias("m")).distinct()
        fresh = self.fresh(now.withColumn("__m", marts.month(F.col("Date"))).join(keys.withColumnRenamed("m", "__m"), "__m", "left_semi"))
        return {"sums": merge_mart(c.mart(), fresh, ["m"], at(9), scope_keys=keys, delete=True)}

    def rebuild(self, c):
        t = c.source("Document_D")
        for r in marts.row_months(t, "Date").collect():
            block = t.where(F.date_format("Date", "yyyy-MM") == r["label"])
            yield r["label"], {"sums": merge_mart(c.mart(), self.fresh(block), ["m"], at(8), scope=F.col("m") == F.lit(r["begins"]), delete=True)}


def test_mart_is_rebuilt_then_kept_up(spark, store):
    put = lambda n, *d: store.publish({"Document_D": merge(store.read("Document_D"), docs(spark, *d), DOC, at(n))}, f"package {n}")
    full = lambda: rows(SumByMonth().fresh(store.read("Document_D")), "m", "s")
    put(1, ("a", 1, 1), ("b", 2, 2))
    r = MartRunner(store, SumByMonth())
    assert r.run_once().blocks == ["2024-01", "2024-02"]
    assert rows(store.read("sums"), "m", "s") == full() and r.run_once().ran == "idle"
    put(2, ("b", 3, 5), ("c", 1, 1))  # February empties
    assert r.run_once().ran == "increment" and rows(store.read("sums"), "m", "s") == full()
    assert r.run_once(rebuild=True).ran == "rebuild" and rows(store.read("sums"), "m", "s") == full()
    other = MartRunner(store, SumByMonth(), "other")
    assert r.lease.acquire() and other.run_once().ran == "busy" and r.lease.release()
    r.disable()
    put(3, ("d", 1, 1))
    assert r.run_once().ran == "idle"


def test_interrupted_rebuild_resumes(spark, store):
    store.publish({"Document_D": merge(None, docs(spark, ("a", 1, 1), ("b", 2, 2), ("c", 3, 3)), DOC, at(1))}, "package 1")

    class Fails(SumByMonth):
        def rebuild(self, c):
            for label, x in super().rebuild(c):
                if label == "2024-03" and c.rebuild_from is None:
                    raise RuntimeError("stopped")
                yield label, x

    r = MartRunner(store, Fails())
    assert isinstance(run_all([r])["sums"], RuntimeError)
    assert r.run_once().blocks == ["2024-03"]
    assert store.read("sums").count() == 3


def test_cursor_and_data_are_one_commit(spark, store):
    store.publish({"Document_D": merge(None, docs(spark, ("a", 1, 1)), DOC, at(1))}, "package 1")
    r = MartRunner(store, SumByMonth())
    r.run_once()
    store.publish({"Document_D": merge(store.read("Document_D"), docs(spark, ("b", 2, 2)), DOC, at(2))}, "package 2")
    head = store.head()
    assert r.run_once().ran == "increment" and store.head() == head + 1 and store.carried(r.document)["cursor"]["__commit"] == head and store.state()["sums"].number == head + 1


def test_rebuild_longer_than_its_lease_keeps_it(spark, store):
    import time

    store.publish({"Document_D": merge(None, docs(spark, ("a", 1, 1), ("b", 2, 2)), DOC, at(1))}, "package 1")
    others = []

    class Slow(SumByMonth):
        def rebuild(self, c):
            for x in super().rebuild(c):
                time.sleep(1.0)
                others.append(MartRunner(store, SumByMonth(), "other", lease_ttl=0.6).run_once().ran)
                yield x

    assert MartRunner(store, Slow(), lease_ttl=0.6).run_once().blocks == ["2024-01", "2024-02"] and others == ["busy", "busy"]


def test_lost_lease_announces_nothing(spark, store):
    store.publish({"Document_D": merge(None, docs(spark, ("a", 1, 1), ("b", 2, 2)), DOC, at(1))}, "package 1")

    class Robbed(SumByMonth):
        def rebuild(self, c):
            for n, x in enumerate(super().rebuild(c)):
                if n:
                    assert Lease(store, "mart-sums", "thief", clock=lambda: 9e18).acquire()
                yield x

    r = MartRunner(store, Robbed())
    assert r.run_once().ran == "lost" and store.read("sums").count() == 1 and r.progress()["label"] == "2024-01"
    revision, _ = store.document("lease-mart-sums")
    store.replace_document("lease-mart-sums", revision, {"owner": None, "heartbeat": 0})
    again = MartRunner(store, SumByMonth(), "next")
    assert again.run_once().blocks == ["2024-02"] and again.progress()["building"] is None and again.run_once().ran == "idle"


def test_new_order_during_a_rebuild_begins_anew(spark, store):
    store.publish({"Document_D": merge(None, docs(spark, ("a", 1, 1), ("b", 2, 2)), DOC, at(1))}, "package 1")
    r = MartRunner(store, SumByMonth())

    class Ordered(SumByMonth):
        def rebuild(self, c):
            for x in super().rebuild(c):
                if not r.wishes().get("order"):
                    r.request_rebuild()
                yield x

    r.mart = Ordered()
    assert r.run_once().blocks == ["2024-01"] and r.run_once().blocks == ["2024-01", "2024-02"] and r.run_once().ran == "idle"


def test_marts_run_by_interval_and_by_abandoned_writes(spark, store):
    now = [0.0]
    store.publish({"Document_D": merge(None, docs(spark, ("a", 1, 1)), DOC, at(1))}, "package 1")

    class Seldom(SumByMonth):
        MIN_INTERVAL = 100

    class Fails(SumByMonth):
        NAME = "fails"

        def rebuild(self, c):
            raise OSError("no")

    loop = MartLoop([MartRunner(store, Seldom()), MartRunner(store, Fails())], clock=lambda: now[0])
    told = loop.run_pass()
    assert told["sums"].ran == "rebuild" and isinstance(told["fails"], OSError) and loop.run_pass() == {}
    now[0] = 61
    assert set(loop.run_pass()) == {"fails"}
    now[0] = 101
    assert loop.run_pass()["sums"].ran == "idle"
    store.put(Staged(), "abandoned write", forced=["Document_D"])
    assert loop.run_pass()["sums"].ran == "increment"
    loop.stop()
    assert loop.run_pass() == {} and loop.run_forever() is None


def test_context_runs_sql(spark, store):
    c = MartContext(spark, store, "x", 0, {})
    assert c.query("select id * 2 as n from {t} where id > :low", t=spark.range(4), low=2).collect() == [(6,)]
    c.execute("select 1")
    t = spark.createDataFrame([(datetime(2024, 1, d), datetime(2024, 2, 3 - d)) for d in (1, 2)], "a timestamp_ntz, b timestamp_ntz")
    c.since = datetime(2024, 2, 1, 12)
    assert t.where(c.changed_since("a", "b")).count() == 1


def test_marts_are_checked():
    class Bad:
        NAME, ON = "x", "Document_D"

    for m in (Bad(), SumByMonth, type("E", (), {"NAME": "e", "ON": [], "process_changes": print})(), type("E", (), {"NAME": "ё", "ON": ["a"], "process_changes": print})(), type("E", (), {"NAME": "e", "ON": ["a"], "MIN_INTERVAL": -1, "process_changes": print})()):
        with pytest.raises((ValueError, TypeError)):
            checked(m)
