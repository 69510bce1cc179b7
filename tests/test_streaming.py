"""Packages end to end: replication cycles, failures, confirmation, the streaming source, HTTP."""

import threading
from datetime import datetime
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_shape import G1, G2, META, entry

from tidemark.plans.store import Store
from tidemark.sources import metadata
from tidemark.sources.metadata import BadAnswer
from tidemark.sources.transport import FolderTransport, HttpTransport
from tidemark.streaming.replicator import FAILURES, PackageHeld, Replicator


def feed(*entries):
    return ('<?xml version="1.0" encoding="UTF-8"?><feed xmlns="http://www.w3.org/2005/Atom">' + "".join(entries) + "</feed>").encode()


def catalog(key, num, mark="false"):
    return entry("Catalog_X", f"<d:Ref_Key>{key}</d:Ref_Key><d:DeletionMark>{mark}</d:DeletionMark><d:Num>{num}</d:Num>")


@pytest.fixture
def world(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    put = lambda n, *e: (tmp_path / "feed" / f"msg{n}.xml").write_bytes(feed(*e))
    store = Store(spark, f"file://{tmp_path}/store")
    transport = FolderTransport(str(tmp_path / "feed"))
    return put, store, transport, Replicator(spark, store, transport, metadata.parse(META))


def test_package_is_saved_then_confirmed(world):
    put, store, transport, r = world
    put(1, catalog(G1, 1), catalog(G2, 2))
    c = r.run_once(datetime(2024, 1, 1))
    assert (c.entries, c.modified, c.confirmed) == (2, 2, True) and transport.received() == 1
    assert r.registry.pending() == ["Catalog_X"]
    put(2, catalog(G1, 5, "true"))
    assert r.run_once(datetime(2024, 1, 2)).modified == 1
    assert [(k, int(n), d, m) for k, n, d, m in rows(store.read("Catalog_X"), "Ref_Key", "Num", "is_deleted_or_empty", "exchange_message_no")] == [(G1, 5, True, 2), (G2, 2, False, 1)]
    assert not r.run_once().confirmed  # no package
    assert [(e["message_no"], e["entries"], e["modified"], "confirmed_at" in e) for e in r.journal.entries()] == [(1, 2, 2, True), (2, 1, 1, True)]


def test_repeated_package_changes_nothing(world, spark):
    put, store, transport, r = world
    put(1, catalog(G1, 1))
    again = Replicator(spark, store, transport, r.specs, confirm=False)
    assert again.run_once().modified == 1 and again.run_once().modified == 0 and transport.received() == 0 and store.head() == 2  # the lease's epoch and the package


def test_empty_package_stays_and_unsupported_goes(world):
    put, store, transport, r = world
    put(1)
    assert not r.run_once().confirmed
    put(1, entry("Report_Z", ""))
    c = r.run_once()
    assert c.confirmed and c.unsupported == {"Report_Z": 1}


def test_object_without_metadata_blocks_three_times(world):
    put, store, transport, r = world
    put(1, catalog(G1, 1), entry("Catalog_Unknown", "<d:Ref_Key>x</d:Ref_Key>"))
    for _ in range(FAILURES - 1):
        c = r.run_once()
        assert not c.confirmed and c.failed == ["Catalog_Unknown"] and store.read("Catalog_X").count() == 1
    c = r.run_once()
    assert c.confirmed and c.lost == ["Catalog_Unknown"]


def test_emptied_record_set_resets_the_table(world):
    put, store, transport, r = world
    head = f"<d:Recorder>{G1}</d:Recorder><d:Recorder_Type>StandardODATA.Document_D</d:Recorder_Type>"
    line = lambda n: f"<d:element><d:LineNumber>{n}</d:LineNumber><d:Active>true</d:Active><d:Qty>{n}</d:Qty></d:element>"
    put(1, entry("AccumulationRegister_S", head + f'<d:RecordSet m:type="Collection(x)">{line(1)}{line(2)}</d:RecordSet>'))
    put(2, entry("AccumulationRegister_S", head + '<d:RecordSet m:type="Collection(x)"/>'))
    r.run_forever(interval=0, max_iterations=2)
    assert rows(store.read("AccumulationRegister_S"), "LineNumber", "Qty", "is_deleted_or_empty") == [(1, None, True), (2, None, True)]


def test_loop_backs_off_and_goes_on(world):
    put, store, transport, r = world
    waits = []
    transport.package = lambda n: (_ for _ in ()).throw(OSError("down"))
    out = r.run_forever(interval=10, max_iterations=3, sleep=waits.append)
    assert len(out) == 3 and waits == [20, 40]


def test_streaming_query_confirms_after_the_batch(world, tmp_path):
    put, store, transport, r = world
    put(1, catalog(G1, 1))
    put(2, catalog(G2, 2))
    for _ in range(2):  # availableNow takes what it finds; the last commit comes with the next start
        q = r.stream(f"file://{tmp_path}/cp", {"folder": transport.folder}, {"processingTime": "0 seconds"})
        try:
            for _ in range(60):
                if store.head() and store.read("Catalog_X") is not None and store.read("Catalog_X").count() == 2:
                    break
                q.awaitTermination(0.5)
        finally:
            q.stop()
    assert rows(store.read("Catalog_X"), "Ref_Key") == [(G1,), (G2,)]
    assert transport.received() >= 1


def test_streaming_holds_a_package_while_an_object_fails(world, tmp_path):
    put, store, transport, r = world
    put(1, catalog(G1, 1), catalog(G2, 2), catalog(G2, 3))  # one key twice, which shows in the merge alone
    put(2, catalog(G1, 7))
    for turn in range(FAILURES):
        assert transport.received() == 0
        q = r.stream(f"file://{tmp_path}/cp", {"folder": transport.folder}, {"processingTime": "0 seconds"})
        try:
            if turn < FAILURES - 1:
                with pytest.raises(Exception, match="failed"):
                    q.awaitTermination(60)
                assert store.document(r.FAILED)[1] == {"Catalog_X": turn + 1} and store.read("Catalog_X") is None
            else:
                for _ in range(60):
                    if transport.received() == 2:
                        break
                    q.awaitTermination(0.5)
        finally:
            q.stop()
    assert [k for k, in rows(store.read("Catalog_X"), "Ref_Key")] == [G1] and transport.received() >= 1  # given up after three times, then on


def test_stream_needs_the_lease(world, spark):
    put, store, transport, r = world
    other = Replicator(spark, store, transport, r.specs, owner="other")
    assert other.lease.acquire()
    with pytest.raises(PackageHeld):
        r.take(spark.createDataFrame([(1, catalog(G1, 1))], "message_no long, entry string"), [1])
    assert store.read("Catalog_X") is None


def test_poison_behind_the_first_row_blocks_three_times_only(world):
    put, store, transport, r = world
    put(1, *[catalog(G1.replace("1", "abcdef0123456789"[k % 16]), k) for k in range(16)], catalog(G2, 1), catalog(G2, 2), entry("InformationRegister_P", "<d:Item>a</d:Item><d:Price>1</d:Price>"))
    for _ in range(FAILURES - 1):
        c = r.run_once()
        assert c.failed == ["Catalog_X"] and not c.confirmed and store.read("InformationRegister_P").count() == 1
    c = r.run_once()
    assert c.confirmed and c.lost == ["Catalog_X"] and transport.received() == 1


def test_unknown_fields_and_recorders_are_told(world, spark):
    put, store, transport, r = world
    put(1, entry("Catalog_X", f"<d:Ref_Key>{G1}</d:Ref_Key><d:New>n</d:New><d:Rows m:type=\"Collection(x)\"><d:element><d:LineNumber>1</d:LineNumber><d:Extra>o</d:Extra></d:element></d:Rows>"), entry("AccumulationRegister_S", '<d:RecordSet m:type="Collection(x)"/>'))
    c = r.run_once()
    assert c.confirmed and c.unplaced == {"AccumulationRegister_S": 1} and c.unknown_fields == {"Catalog_X": ["Extra", "New"]} and c.rows == 2 and c.entries == 2
    assert rows(store.read("Catalog_X"), "Ref_Key", "New") == [(G1, "n")] and rows(store.read("Catalog_X_Rows"), "LineNumber", "Extra") == [(1, "o")]
    put(2, catalog(G2, 1))
    asked = []
    fresh = Replicator(spark, store, transport, {}, read_metadata=lambda: asked.append(1) or metadata.parse(META))
    assert fresh.run_once().confirmed and asked == [1]


def test_a_batch_touches_its_buckets_only(world, spark):
    put, store, transport, r = world
    guid = lambda k: f"{k:08x}-0000-0000-0000-000000000000"
    put(1, *[catalog(guid(k), k) for k in range(1, 300)])
    r.run_once()
    before = store.state()["Catalog_X"]
    put(2, *[catalog(guid(k), -k) for k in (3, 4)])
    assert r.run_once().modified == 2
    after = store.state()["Catalog_X"]
    moved = {b for b in after.paths if after.paths[b] != before.paths.get(b)}
    assert 1 <= len(moved) <= 2 and len(before.paths) > 50 and store.read("Catalog_X").count() == 299
    batch = store.read("Catalog_X").where(F.col("Ref_Key") == guid(3)).drop("merged_on", "inserted_on")
    parts = store.touched("Catalog_X", batch)
    plan = store.read("Catalog_X", parts=parts)
    assert len(parts) == 1 and len(plan.inputFiles()) == 1 < len(store.read("Catalog_X").inputFiles())


def test_full_load_claim_makes_every_row_a_change(world):
    put, store, transport, r = world
    put(1, catalog(G1, 1))
    r.run_once(datetime(2024, 1, 1))
    put(2, catalog(G1, 1))
    with r.claims.hold("Catalog_X") as mine:
        assert mine and r.under_full_load("Catalog_X") and r.under_full_load("Catalog_X_Rows") and r.run_once(datetime(2024, 1, 2)).modified == 1
    put(3, catalog(G1, 1))
    assert not r.under_full_load("Catalog_X") and r.run_once(datetime(2024, 1, 3)).modified == 0


def test_http_answers_are_checked():
    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *a):
            pass

        def do_GET(self):
            body = f'{{"value": [{{"Ref_Key": "{G1}", "ReceivedNo": 3, "ThisNode": false}}]}}'.encode() if "format=json" in self.path else META.encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def do_POST(self):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(feed(catalog(G1, 1)) if "MessageNo=4" in self.path else b"<html/>")

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        t = HttpTransport(f"http://127.0.0.1:{server.server_port}", "Plan", G1)
        assert t.received() == 3 and b"Catalog_X" in t.package(4) and "Catalog_X" in metadata.parse(t.metadata())
        with pytest.raises(BadAnswer):
            t.package(5)
    finally:
        server.shutdown()
    with pytest.raises(ValueError):
        HttpTransport("ftp://x", "Plan", G1)
    with pytest.raises(ValueError):
        HttpTransport("http://x", "Plan'; --", G1)


def price(item, text, day="2024-01-01T00:00:00"):
    return entry("InformationRegister_P", f"<d:Item>{item}</d:Item><d:Period>{day}</d:Period><d:Price>{text}</d:Price>")


def test_values_that_are_none_are_told_and_never_zero(world):
    put, store, transport, r = world
    prices = lambda: [(k, None if v is None else format(v, "f").rstrip("0").rstrip(".")) for k, v in rows(store.read("InformationRegister_P"), "Item", "Price")]
    put(1, price("a", "1,5"), price("b", ""), price("c", "2.5"))
    c = r.run_once()
    assert c.confirmed and c.modified == 3 and c.rejected == {"InformationRegister_P": {"Price": 1}}
    assert prices() == [("a", None), ("b", "0"), ("c", "2.5")]  # absent is zero in a register, broken is not
    assert rows(store.read("Rejected_values"), "object", "field", "text") == [("InformationRegister_P", "Price", "1,5")]
    put(2, price("d", "1.12345678901234567891"))
    c = r.run_once()
    assert c.confirmed and c.rejected == {} and ("d", "1.12345678901234567891") in prices() and ("c", "2.5") in prices()  # more decimals for the column
    put(3, price("e", "123456789012345678901234"), price("f", "7"))
    c = r.run_once()
    assert c.rejected == {"InformationRegister_P": {"Price": 1}} and ("e", None) in prices() and ("f", "7") in prices()  # 24 and 20 digits don't fit together
    again = Replicator(r.spark, store, transport, metadata.parse(META))
    put(4, price("c", "3.00000000000000000001"))
    assert again.run_once().rejected == {} and ("c", "3.00000000000000000001") in prices()  # the stored scale is known to others


def test_whole_digits_take_the_place_of_decimals(world):
    put, store, transport, r = world
    put(1, price("a", "0.25"))
    assert r.run_once().confirmed
    put(2, price("b", "12345678901234567890123456789012345678"[:36]))
    assert r.run_once().rejected == {}
    assert [str(v) for v, in rows(store.read("InformationRegister_P"), "Price")] == ["0.25", "123456789012345678901234567890123456.00"]


def test_a_key_that_is_none_holds_its_object(world):
    put, store, transport, r = world
    put(1, price("a", "1", "soon"), catalog(G1, 1))
    for _ in range(FAILURES - 1):
        c = r.run_once()
        assert c.failed == ["InformationRegister_P"] and not c.confirmed and store.read("InformationRegister_P") is None and store.read("Catalog_X").count() == 1
    assert r.run_once().lost == ["InformationRegister_P"]


def test_feeds_with_a_prefix(world, tmp_path):
    put, store, transport, r = world
    told = catalog(G1, 5)
    for tag in ("entry", "category", "content"):
        told = told.replace(f"<{tag}", f"<a:{tag}").replace(f"</{tag}>", f"</a:{tag}>")
    (tmp_path / "feed" / "msg1.xml").write_text(f'<?xml version="1.0"?><a:feed xmlns:a="http://www.w3.org/2005/Atom">{told}{told.replace(G1, G2)}</a:feed>')
    c = r.run_once()
    assert c.confirmed and c.entries == 2 and rows(store.read("Catalog_X"), "Ref_Key") == [(G1,), (G2,)]
    from tidemark.sources.transport import entries

    assert [e[:16] for e in entries((tmp_path / "feed" / "msg1.xml").read_bytes())] == ["<entry><category"] * 2
