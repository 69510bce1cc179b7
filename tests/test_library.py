"""Ready marts against full recomputes, queues, names, foreign tables and the command line."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators import marts, queues
from tidemark.operators.merge import merge, merge_mart
from tidemark.plans.mart_library import GroupMart, RowMart
from tidemark.plans.mart_runner import MartContext, MartRunner
from tidemark.plans.store import Store, layout_of
from tidemark.sources import federated
from tidemark.spec import TableSpec

REG = TableSpec("Reg", {"Recorder": "Int64", "LineNumber": "Int64"}, ("Recorder", "LineNumber"), ("Recorder",), resources=())
DOC = TableSpec("Doc", {"Ref_Key": "Int64"}, ("Ref_Key",))
CAT = TableSpec("Cat", {"Ref_Key": "Int64"}, ("Ref_Key",))


def put(store, spark, n, reg=(), doc=(), cat=(), buckets=8):
    stamp = F.lit(datetime(2024, 1, 1) + timedelta(days=n)).cast("timestamp_ntz")
    frames = {
        "Reg": (REG, reg, "Recorder long, Recorder_Type string, LineNumber long, Period timestamp_ntz, RecordType string, Item long, Qty decimal(18,2), is_deleted_or_empty boolean"),
        "Doc": (DOC, doc, "Ref_Key long, Number string, Date timestamp_ntz, is_deleted_or_empty boolean"),
        "Cat": (CAT, cat, "Ref_Key long, Code string, is_deleted_or_empty boolean"),
    }
    changes = {}
    for name, (spec, data, schema) in frames.items():
        if data:
            batch = spark.createDataFrame(data, schema).withColumn("exchange_message_no", F.lit(n).cast("long"))
            changes[name] = merge(store.read(name), batch, spec, stamp)
    store.publish(changes, f"package {n}", {name: (v.partition if (v := store.state().get(name)) else layout_of(frames[name][0], buckets)) for name in changes})


def line(rnd, recorder, number):
    from decimal import Decimal

    return (recorder, rnd.choice(["Document_D", "Document_D", "Other"]), number, datetime(2024, rnd.randint(1, 3), 5) if rnd.random() < 0.9 else None, rnd.choice(["Receipt", "Expense"]), rnd.choice([1, 2, 3, None]), Decimal(rnd.randint(1, 9)), rnd.choice([False, False, True]))


@pytest.mark.parametrize("seed", [1])
def test_ready_marts_equal_their_full_recompute(spark, tmp_path, seed):
    rnd = random.Random(seed)
    store = Store(spark, f"file://{tmp_path}/store")
    put(store, spark, 1, [line(rnd, r, k) for r in range(6) for k in range(2)], [(r, f"N{r % 4}", datetime(2024, 1 + r % 3, 1), False) for r in range(5)], [(k, f"c{k}", False) for k in (1, 2)])
    by_row, by_group = RowMart("by_row", "Reg", "Cat", buckets=8), GroupMart("by_group", "Reg", "Doc", "Cat", "Document_D", buckets=8)
    runners = [MartRunner(store, by_row), MartRunner(store, by_group)]

    def check():
        reg, doc, cat = (store.read(t) for t in ("Reg", "Doc", "Cat"))
        want = by_row.view(reg, cat)
        assert rows(store.read("by_row").select(*want.columns)) == rows(want)
        behind = marts.group_rows(reg, doc, cat, "Document_D")
        full = marts.grouped(behind, lineage=False).drop("rows_merged_on")
        assert rows(store.read("by_group").select(*full.columns)) == rows(full)
        lineage = marts.lineage_table(behind)
        assert rows(store.read("by_group_lineage").select(*lineage.columns)) == rows(lineage)

    assert [r.run_once().ran for r in runners] == ["rebuild", "rebuild"]
    check()
    put(store, spark, 2, [line(rnd, 2, 0), line(rnd, 7, 0)], [(1, "N9", datetime(2024, 5, 1), False)], [(3, "c3", False), (1, "renamed", False)])  # groups move, codes change, lines vanish
    assert [r.run_once().ran for r in runners] == ["increment", "increment"]
    check()
    put(store, spark, 3, [line(rnd, 4, 1)])
    assert [r.run_once().ran for r in runners] == ["increment", "increment"] and [r.run_once().ran for r in runners] == ["idle", "idle"]
    check()
    assert [r.run_once(rebuild=True).ran for r in runners] == ["rebuild", "rebuild"]
    check()


def test_a_rebuild_reads_its_sources_once(spark, tmp_path):
    rnd = random.Random(4)
    store = Store(spark, f"file://{tmp_path}/store")
    put(store, spark, 1, [line(rnd, r, k) for r in range(12) for k in range(2)], [], [(k, f"c{k}", False) for k in (1, 2)])
    mart = RowMart("by_row", "Reg", "Cat", buckets=4)
    c = MartContext(spark, store, "by_row", store.head(), {}, full_rebuild=True)
    got = []
    for label, changes in mart.rebuild(c):
        got.append(label)
        read = changes["by_row"].rows.inputFiles()
        assert read and all("_landing" in f and f"__label={label}" in f for f in read)
    assert got == [r["label"] for r in marts.row_months(store.read("Reg")).collect()] and len(got) > 1 and store.files.names("_landing") == []
    c.rebuild_from = got[0]
    assert [label for label, _ in mart.rebuild(c)] == got[1:]


def movements(recorders, item):
    return [(r, "Document_D", 0, datetime(2024, 1, 5), "Receipt", item(r), 1, False) for r in recorders]


def test_increments_open_the_parts_that_they_need(spark, tmp_path):
    from decimal import Decimal

    store, n = Store(spark, f"file://{tmp_path}/store"), 30
    put(store, spark, 1, [(*m[:6], Decimal(1), False) for m in movements(range(n), lambda r: r % 10)], [(r, f"N{r}", datetime(2024, 1, 1), False) for r in range(n)], [(k, f"c{k}", False) for k in range(10)], buckets=16)
    by_row, by_group = RowMart("by_row", "Reg", "Cat", buckets=16), GroupMart("by_group", "Reg", "Doc", "Cat", "Document_D", buckets=16)
    runners = [MartRunner(store, m) for m in (by_row, by_group)]
    assert [r.run_once().blocks for r in runners] == [["2024-01"], ["2024-01"]]
    put(store, spark, 2, cat=[(7, "renamed", False)])  # three movements have the item
    for mart, runner in zip((by_row, by_group), runners, strict=True):
        c, files = runner._context(), set()
        keep = c.keep
        c.keep = lambda f, keep=keep, files=files: files.update(f.inputFiles()) or keep(f)
        out = mart.process_changes(c)
        files |= {f for m in out.values() for f in m.rows.inputFiles()}
        c.release()
        opened = {t: len({f.split("__part=")[1].split("/")[0] for f in files if f"/{t}/" in f}) for t in ("Reg", "Doc", "by_row", "by_group")}
        assert 0 < opened["Reg"] <= 3 and opened["Doc"] <= 3 and opened["by_row"] <= 3 and opened["by_group"] <= 6, opened
    put(store, spark, 3, reg=[(m[0], m[1], m[2], m[3], m[4], m[5], Decimal(5), False) for m in movements([3], lambda _: 9)], doc=[(4, "moved", datetime(2024, 2, 1), False)])
    # Rows: 3 renamed, 1 changed, 1 new index entry. Groups: 5 go and 5 come, each with two keys in lineage and index.
    assert [r.run_once().modified for r in runners] == [3 + 1 + 1, 2 * 5 * (1 + 2 + 2)]
    reg, doc, cat = (store.read(t) for t in ("Reg", "Doc", "Cat"))
    assert rows(store.read("by_row").select(*by_row.view(reg, cat).columns)) == rows(by_row.view(reg, cat))
    full = by_group.rows(reg, doc, cat)
    assert rows(store.read("by_group_index").select("source", "key", "Recorder", *marts.GROUP)) == rows(by_group._entries(full))
    assert rows(store.read("by_group").select(*marts.GROUP, "Qty")) == rows(marts.grouped(full).select(*marts.GROUP, "Qty"))


def test_a_rebuild_resumed_behind_its_last_block_misses_nothing(spark, tmp_path, monkeypatch):
    from decimal import Decimal

    store = Store(spark, f"file://{tmp_path}/store")
    put(store, spark, 1, [(*m[:6], Decimal(1), False) for m in movements([1, 2], lambda r: r)], cat=[(1, "c1", False), (2, "c2", False)])
    mart = RowMart("by_row", "Reg", "Cat", buckets=4)
    runner, publish = MartRunner(store, mart), MartRunner._publish

    def dies(self, changes, **progress):
        if "done" in progress:
            raise RuntimeError("killed")
        return publish(self, changes, **progress)

    monkeypatch.setattr(MartRunner, "_publish", dies)
    with pytest.raises(RuntimeError, match="killed"):
        runner.run_once()
    monkeypatch.undo()
    put(store, spark, 2, cat=[(2, "renamed", False)])
    assert runner.run_once().ran == "rebuild"
    runner.run_once()
    assert rows(store.read("by_row"), "Recorder", "Artikul") == [(1, "c1"), (2, "renamed")] and runner.run_once().ran == "idle"


def test_delta_reads_changed_parts_only(spark, tmp_path):
    store, rnd = Store(spark, f"file://{tmp_path}/store"), random.Random(1)
    put(store, spark, 1, [line(rnd, r, 0) for r in range(40)])
    put(store, spark, 2, [(*line(rnd, 5, 0)[:6], None, True)])
    delta = store.changes("Reg", ["Recorder", "LineNumber"], 1)
    assert rows(delta, "Recorder") == [(5,)] and len([f for f in delta.inputFiles()]) == 2  # one part, at both versions
    assert store.changes("Reg", ["Recorder"], 0).count() == 40 and store.changes("None", [], 0) is None


def test_outgrown_tables_get_more_buckets(spark, tmp_path):
    store, rnd = Store(spark, f"file://{tmp_path}/store"), random.Random(1)
    put(store, spark, 1, [line(rnd, r, 0) for r in range(300)])
    store.publish({"Reg": merge(None, store.read("Reg").drop("merged_on", "inserted_on"), REG, F.lit("2024-01-01").cast("timestamp_ntz"))}, "laid out", {"Reg": layout_of(REG)}, force=True)
    before, told, number = rows(store.read("Reg")), len(store.log()), store.versions()["Reg"]
    assert store.grow("Reg") == 64 and store.grow("Reg", bucket_bytes=1500) == 256 and store.grow("None") == 0
    assert rows(store.read("Reg")) == before and len(store.log()) == told and store.versions()["Reg"] == number and len(store.state()["Reg"].paths) > 64
    one = store.read("Reg").where("Recorder = 7")
    parts = store.touched("Reg", one)
    assert len(parts) == 1 and store.read("Reg", parts=parts).where("Recorder = 7").count() == 1
    put(store, spark, 9, [line(rnd, 7, 0)])
    assert store.read("Reg").count() == 300


def test_files_are_created_once_without_links(spark, tmp_path):
    """The way for file systems without hard links, tried on a local one: a rename that doesn't replace."""
    store = Store(spark, f"file://{tmp_path}/store")
    f = store.files
    f.write("a", b"1")
    f.write("b", b"2")
    context = f.jvm.org.apache.hadoop.fs.FileContext.getFileContext(f.fs.getUri(), f.conf)
    none = f.gateway.new_array(getattr(f.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    with pytest.raises(Exception, match="AlreadyExists"):
        context.rename(f._path("a"), f._path("b"), none)
    context.rename(f._path("a"), f._path("c"), none)
    assert f.read("c") == "1" and f.read("b") == "2" and f.read("a") is None


def test_portions_go_round(spark):
    waiting = spark.createDataFrame([(o, k) for o, n in (("A", 5), ("B", 3), ("C", 4)) for k in range(n)] + [("A", 0)], "object string, ref int")
    other = spark.createDataFrame([("B", 0), ("X", 1)], "object string, ref int")
    order = ["A", "B", "C"]
    first = queues.next_portion(waiting, [other], order, 1, 8)
    assert rows(first, "object", "ref") == [("A", 0), ("A", 1), ("B", 1), ("B", 2), ("C", 0), ("C", 1), ("C", 2), ("C", 3)] and queues.next_start(first, order, 1) == 1
    assert queues.next_start(queues.next_portion(waiting, [other], order, 1, 2), order, 1) == 2
    assert queues.next_portion(waiting.limit(0), [], order, 0, 5).count() == 0 and queues.next_start(waiting.limit(0), order, 2) == 2
    assert rows(queues.sizes(waiting)) == [("A", 6), ("B", 3), ("C", 4)] and queues.at_least(waiting, 7).first()[0] == 7 and queues.at_least(waiting, 70).first()[0] == 13


def test_names_are_kept_in_the_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    one, two = names.NameBook(store), names.NameBook(store)
    first = one.mapping("field:X", ["Сер", "merged_onъ"])
    second = two.mapping("field:X", ["Сэр", "Сер"])
    assert first["Сер"] == second["Сер"] == "Ser" and second["Сэр"].startswith("Ser_") and one.mapping("field:X", ["Сэр"]) == {"Сэр": second["Сэр"]}
    assert two.mapping("field:Y", ["Сэр"]) == {"Сэр": "Ser"}
    df = names.renamed(spark.createDataFrame([(1, 2)], "`Сер` int, other int"), first)
    assert df.columns == ["Ser", "other"]
    with pytest.raises(ValueError):
        names.renamed(df, {"other": "Ser"})
    assert names.resolved("Ser", first) == names.resolved("Сер", first) == "Сер"
    for bad in ("nothing",):
        with pytest.raises(ValueError):
            names.resolved(bad, first)
    with pytest.raises(ValueError):
        names.resolved("b", {"a": "b", "b": "c"})


def test_foreign_tables(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    t = spark.createDataFrame([(k, f"n{k % 3}", k % 5 == 0) for k in range(20)], "id int, name string, is_deleted_or_empty boolean")
    federated.append(t, url, "versions", F.lit(1), **driver)
    federated.append(t.where("id < 3").withColumn("name", F.lit("new")).withColumn("is_deleted_or_empty", F.col("id") == 1), url, "versions", F.lit(2), **driver)
    far = federated.read(spark, url, "versions", **driver)
    got = federated.final(far, ["id"])
    assert rows(got.where("id < 4"), "id", "name") == [(0, "new"), (2, "new"), (3, "n0")] and far.count() == 23
    keys = spark.createDataFrame([(3,), (4,), (None,), (3,)], "k int")
    few = federated.restricted(far, "id", keys)
    assert "PushedFilters: [*In(id, [3,4])]" in few._jdf.queryExecution().executedPlan().toString() and rows(few, "id") == [(3,), (4,)]
    assert rows(federated.restricted(far, "id", keys, most=1), "id") == [(3,), (4,)] and federated.restricted(far, "id", keys.limit(0)).count() == 0
    assert federated.key_array(keys).first()["keys"] == [3, 4]
    assert rows(spark.createDataFrame([(None,), (datetime(2024, 3, 5),)], "d timestamp_ntz").select(federated.month(F.col("d")).cast("string"))) == [("1900-01-01",), ("2024-03-01",)]


def test_outbox_repeats_and_loses_nothing(spark, tmp_path, monkeypatch):
    from tidemark.plans.outbox import Outbox

    store = Store(spark, f"file://{tmp_path}/store")
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    put(store, spark, 1, doc=[(k, f"N{k}", datetime(2024, 1, 1), False) for k in range(12)])
    key = ["Ref_Key"]
    runner = MartRunner(store, Outbox("sent", "Doc", key, url, "docs", driver, lambda f: f.select(*key, "Number", "is_deleted_or_empty")))

    def there():
        return federated.read(spark, url, "docs", **driver)

    def same():
        kept = store.read("Doc").where("not is_deleted_or_empty")
        return rows(federated.final(there(), key).select(*key, "Number")) == rows(kept.select(*key, "Number"))

    assert runner.run_once().ran == "rebuild" and same() and there().count() == 12 and runner.run_once().ran == "idle"
    put(store, spark, 2, doc=[(3, "new", datetime(2024, 1, 1), False), (4, "N4", datetime(2024, 1, 1), True), (99, "N99", datetime(2024, 1, 1), False)])
    publish = MartRunner._publish
    monkeypatch.setattr(MartRunner, "_publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        runner.run_once()
    monkeypatch.setattr(MartRunner, "_publish", publish)
    assert same() and there().count() == 15 and runner.pending()
    put(store, spark, 3, doc=[(3, "newer", datetime(2024, 1, 1), False)])
    assert runner.run_once().ran == "increment" and same() and there().count() == 18 and runner.run_once().ran == "idle"
    held = store.read("Doc")  # rows vanish, as they do from marts
    store.publish({"Doc": merge_mart(held, held.where("Ref_Key > 5").drop("merged_on", "inserted_on"), key, F.lit("2024-02-01").cast("timestamp_ntz"), delete=True)}, "fewer")
    assert runner.run_once().ran == "increment" and same() and rows(federated.final(there(), key), "Ref_Key")[0] == (6,)
    with pytest.raises(ValueError, match="version"):
        Outbox("x", "Doc", key, url, "docs", driver, lambda f: f.withColumn("version", F.lit(1)))._send(held, 1)


def test_command_line_schedules_loads(spark, tmp_path):
    import threading

    from tidemark import __main__ as cli
    from tidemark.plans.full_load import FullLoadCron, FullLoads
    from tidemark.plans.state import Registry

    assert cli.schedule("") == {} and cli.schedule(" Doc = 0 3 * * * @ 7 ;Cat=*/5 * * * *;") == {"Doc": ("0 3 * * *", 7), "Cat": ("*/5 * * * *", None)}
    for bad in ("Doc", "Doc=0 3 * *", "Doc=0 3 * * *@x", "=* * * * *", "Doc=* * * * *;Doc=* * * * *", "Doc=0 0 31 2 *"):
        with pytest.raises(SystemExit, match="SCHEDULE"):
            cli.schedule(bad)
    registry, now, ran = Registry(Store(spark, f"file://{tmp_path}/store")), [datetime(2024, 5, 1, 10, 0)], []
    registry.mark_full_loaded("Doc", 1, 0.1)
    loads = FullLoads(registry, lambda name, stop: 0)

    def load(name, since):
        ran.append((name, since))
        loads.stopping.set()
        return 1

    cron = FullLoadCron(registry, load, cli.schedule("Doc=0 * * * *@7"), lambda: now[0])
    ticks = threading.Thread(target=cli.scheduled, args=(cron, loads, 0.01))
    ticks.start()
    now[0] = datetime(2024, 5, 1, 11, 0)
    ticks.join(60)
    assert ran == [("Doc", datetime(2024, 4, 24).date())] and not ticks.is_alive()
    loads.stop()


def test_command_line_refuses_bad_settings(monkeypatch):
    from tidemark import __main__ as cli

    good = {"TIDEMARK_URL": "http://x", "TIDEMARK_EXCHANGE": "Plan", "TIDEMARK_STORE": "file:///tmp/none", "TIDEMARK_NODE": "n"}
    for more, told in (({"TIDEMARK_URL": ""}, "TIDEMARK_URL"), ({"TIDEMARK_MODE": "never"}, "TIDEMARK_MODE"), ({"TIDEMARK_POLL_SECONDS": "x"}, "POLL"), ({"TIDEMARK_FULL_LOAD_THREADS": "0"}, "THREADS"), ({"TIDEMARK_EXCHANGE": "a b"}, "exchange"), ({"TIDEMARK_LOG_LEVEL": "LOUD"}, "LOG_LEVEL"), ({"TIDEMARK_AUTOMATIC_FULL_LOAD": "maybe"}, "AUTOMATIC")):
        with pytest.raises(SystemExit, match=told):
            cli.settings({**good, **more})
    s = cli.settings({**good, "TIDEMARK_MODE": "once", "TIDEMARK_USER": "u", "TIDEMARK_PASSWORD": "secret"})
    assert s.mode == "once" and s.transport.user == "u" and "secret" not in repr(s) and s.threads == 2 and s.retention_days == 30
