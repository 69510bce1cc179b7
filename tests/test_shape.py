"""Packages in Atom XML to flat rows, metadata to specifications, and source text to values."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import convert, filters, names, text
from tidemark.operators import shape
from tidemark.sources import metadata, packages
from tidemark.spec import TableSpec, register_fields

META = """<edmx:Edmx xmlns:edmx="http://schemas.microsoft.com/ado/2007/06/edmx"><edmx:DataServices><Schema xmlns="http://schemas.microsoft.com/ado/2009/11/edm">
<EntityType Name="Catalog_X"><Key><PropertyRef Name="Ref_Key"/></Key><Property Name="Ref_Key" Type="Edm.Guid"/><Property Name="DeletionMark" Type="Edm.Boolean"/>
 <Property Name="Num" Type="Edm.Double"/><Property Name="Any" Type="Edm.String"/><Property Name="Any_Type" Type="Edm.String"/><Property Name="Odd" Type="Edm.Strange"/>
 <Property Name="Rows" Type="Collection(StandardODATA.Catalog_X_Rows_RowType)"/></EntityType>
<EntityType Name="Catalog_X_Rows"><Key><PropertyRef Name="Ref_Key"/><PropertyRef Name="LineNumber"/></Key><Property Name="Ref_Key" Type="Edm.Guid"/><Property Name="LineNumber" Type="Edm.Int64"/><Property Name="V" Type="Edm.String"/></EntityType>
<ComplexType Name="Catalog_X_Rows_RowType"><Property Name="LineNumber" Type="Edm.Int64"/></ComplexType>
<EntityType Name="AccumulationRegister_S"><Key><PropertyRef Name="Recorder"/></Key><Property Name="Recorder" Type="Edm.String"/></EntityType>
<EntityType Name="AccumulationRegister_S_RecordType"><Key><PropertyRef Name="Recorder"/><PropertyRef Name="LineNumber"/><PropertyRef Name="Recorder_Type"/></Key>
 <Property Name="Recorder" Type="Edm.String"/><Property Name="Recorder_Type" Type="Edm.String"/><Property Name="LineNumber" Type="Edm.Int64"/><Property Name="Active" Type="Edm.Boolean"/><Property Name="Item_Key" Type="Edm.Guid"/><Property Name="Qty" Type="Edm.Double"/><Property Name="Note" Type="Edm.String"/></EntityType>
<ComplexType Name="AccumulationRegister_S_Balance"><Property Name="Item_Key" Type="Edm.Guid"/><Property Name="QtyBalance" Type="Edm.Double"/></ComplexType>
<EntityType Name="InformationRegister_P"><Key><PropertyRef Name="Item"/><PropertyRef Name="Period"/></Key><Property Name="Item" Type="Edm.String"/><Property Name="Period" Type="Edm.DateTime"/><Property Name="Price" Type="Edm.Double"/></EntityType>
</Schema></edmx:DataServices></edmx:Edmx>"""
G1, G2 = "11111111-1111-1111-1111-111111111111", "22222222-2222-2222-2222-222222222222"


def entry(name, properties):
    return f'<entry><category term="StandardODATA.{name}" scheme="s"/><content type="application/xml"><m:properties xmlns:m="m" xmlns:d="d">{properties}</m:properties></content></entry>'


def frame(spark, *entries):
    return spark.createDataFrame([(e,) for e in entries], "entry string")


@pytest.fixture(scope="module")
def specs():
    return metadata.parse(META)


def test_metadata(specs):
    x, s, p = specs["Catalog_X"], specs["AccumulationRegister_S"], specs["InformationRegister_P"]
    assert x.fields == {"Ref_Key": "Guid", "DeletionMark": "Boolean", "Num": "Double", "Any": "String", "Any_Type": "String", "Odd": "String", "Any_Guid": "Guid"}
    assert x.parts == ("Catalog_X_Rows",) and specs["Catalog_X_Rows"].is_table_part and specs["Catalog_X_Rows"].group_key == ("Ref_Key",)
    assert s.fields["Recorder"] == "Guid" and s.group_key == ("Recorder", "Recorder_Type") and s.pk == ("Recorder", "LineNumber", "Recorder_Type")
    assert (s.dimensions, s.resources, s.attributes) == (("Item_Key",), ("Qty",), ("Note",))
    assert p.group_key == () and p.pk == ("Item", "Period")


def test_an_answer_without_its_root_is_an_error():
    for body in ("<html/>", "no xml", "<feed"):
        with pytest.raises(metadata.BadAnswer):
            metadata.parse(body)
    with pytest.raises(metadata.BadAnswer):
        metadata.bounded([b"12345"] * 3, most=10)
    with pytest.raises(metadata.BadAnswer):
        metadata.bounded([], declared=11, most=10)
    assert metadata.bounded([b"ab", b"c"], 3, 10) == b"abc"


def test_nodes_and_received_number():
    body = f'{{"value": [{{"Ref_Key": "{G1.upper()}", "ReceivedNo": "4", "ThisNode": false}}, {{"Ref_Key": "{G2}", "ThisNode": true}}]}}'
    assert list(metadata.nodes(body)) == [G1]
    assert metadata.received_no(body, f" {{{G1}}} ") == 4
    with pytest.raises(ValueError, match="no exchange node"):
        metadata.received_no(body, G2)


def test_catalog_with_parts(spark, specs):
    full = entry("Catalog_X", f"<d:Ref_Key>{G1}</d:Ref_Key><d:DeletionMark>true</d:DeletionMark><d:Num>9007199254740993</d:Num><d:Any>{G2}</d:Any><d:Any_Type>StandardODATA.Catalog_Y</d:Any_Type><d:Rows m:type=\"Collection(x)\"><d:element><d:LineNumber>1</d:LineNumber><d:V>a</d:V></d:element><d:element><d:LineNumber>2</d:LineNumber><d:V/></d:element></d:Rows>")
    empty = entry("Catalog_X", f'<d:Ref_Key>{G2}</d:Ref_Key><d:DeletionMark>false</d:DeletionMark><d:Num>x</d:Num><d:Any>6.4</d:Any><d:Any_Type>Edm.Double</d:Any_Type><d:Rows m:type="Collection(x)"/>')
    bare = entry("Catalog_X", "<d:Ref_Key>00000000-0000-0000-0000-000000000000</d:Ref_Key>")
    out = packages.entity_rows(frame(spark, full, empty, bare), specs["Catalog_X"], F.lit(5), {"Rows": specs["Catalog_X_Rows"]})
    got = {r["Ref_Key"]: r for r in out["Catalog_X"].collect()}
    assert got[G1]["Num"] == 9007199254740993 and got[G1]["is_deleted_or_empty"] and got[G1]["Any_Guid"] == G2 and got[G1]["Any_Type"] == "Catalog_Y"
    assert got[G2]["Num"] is None and got[G2]["Any"] == "6.4" and got[G2]["Any_Guid"] is None and got[G2]["Any_Type"] == "Double" and not got[G2]["is_deleted_or_empty"]
    assert got["00000000-0000-0000-0000-000000000000"]["exchange_message_no"] == 5
    assert rows(out["Catalog_X_Rows"], "Ref_Key", "LineNumber", "V", "is_deleted_or_empty") == [(G1, 1, "a", True), (G1, 2, None, True), (G2, 1, None, True)]


def test_record_sets(spark, specs):
    head = f"<d:Recorder>{G1}</d:Recorder><d:Recorder_Type>StandardODATA.Document_D</d:Recorder_Type>"
    full = entry("AccumulationRegister_S", head + f'<d:RecordSet m:type="Collection(x)"><d:element><d:LineNumber>1</d:LineNumber><d:Active>false</d:Active><d:Item_Key>{G2}</d:Item_Key><d:Qty/></d:element></d:RecordSet>')
    emptied = entry("AccumulationRegister_S", head.replace(G1, G2) + '<d:RecordSet m:type="Collection(x)"/>')
    unknown = entry("AccumulationRegister_S", '<d:RecordSet m:type="Collection(x)"/>')
    assert packages.unplaced(frame(spark, full, emptied, unknown), specs["AccumulationRegister_S"]).count() == 1
    flat = packages.register_rows(frame(spark, entry("AccumulationRegister_S", head + "<d:LineNumber>4</d:LineNumber><d:Qty>3</d:Qty>"), entry("AccumulationRegister_S", head)), specs["AccumulationRegister_S"], F.lit(7))
    assert rows(flat, "Recorder", "LineNumber", "Qty", "is_deleted_or_empty") == [(G1, 0, 0, False), (G1, 4, 3, False)]  # no set arrived: nothing is emptied
    got = packages.register_rows(frame(spark, full, emptied, unknown), specs["AccumulationRegister_S"], F.lit(7))
    assert rows(got, "Recorder", "Recorder_Type", "LineNumber", "Qty", "is_deleted_or_empty") == [(G1, "Document_D", 1, 0, True), (G2, "Document_D", 1, None, True)]


def test_flat_register(spark, specs):
    e = entry("InformationRegister_P", "<d:Item/><d:Period>0001-01-01T00:00:00</d:Period><d:Price>1.5</d:Price>")
    r = packages.flat_register_rows(frame(spark, e), specs["InformationRegister_P"], F.lit(0)).first()
    assert (r["Item"], r["Period"].year, r["Price"]) == ("", 1, Decimal("1.5"))


def test_routing(spark):
    ok, others = shape.route(frame(spark, entry("Catalog_X", ""), entry("Report_X", ""), entry("Undefined", "")), F.regexp_extract("entry", 'term="([^"]*)"', 1))
    assert rows(ok, "object") == [("Catalog_X",)] and others.count() == 2


def test_bad_text_is_null_and_told(spark):
    df = spark.createDataFrame([("6.4",), (G1.upper(),), ("00000000-0000-0000-0000-000000000000",), (f"{{{G1}}}",), (G1.replace("-", ""),), (None,)], "v string")
    got = rows(df, "v", convert.convert(F.col("v"), "Guid"), convert.rejected(F.col("v"), "Guid"))
    assert {(b, c) for _, b, c in got} == {(None, True), (None, False), (G1, False)}
    n = spark.createDataFrame([(v,) for v in ("12345678901234567890.12", "1e2", "x", "-0.000000000000000001", "0.0000000000000000011", "1e-19", "1" * 21, f"urn:uuid:{G1}", f"uuid:{G1}", f"urn:{G1}")], "v string")
    got = [r[0] for r in n.select(convert.convert(F.col("v"), "Double")).collect()]
    assert got == [Decimal("12345678901234567890.12"), 100, None, Decimal("-0.000000000000000001"), *[None] * 6]  # exact or rejected, never rounded
    assert [r[0] for r in n.select(convert.convert(F.col("v"), "Guid")).collect()][-3:] == [G1] * 3


def test_fields_of_an_accounting_register():
    own = ["Period", "AccountDr_Key", "AccountCr_Key", "Sum", "CurDr", "Text", "Recorder"]
    tables = {"AccountingRegister_M_DrCrTurnover": ["AccountDr_Key", "AccountCr_Key", "SumTurnover", "CurTurnoverDr", "Account_Type", "Period"]}
    assert register_fields("AccountingRegister_M", own, tables) == (["AccountDr_Key", "AccountCr_Key"], ["Sum", "CurDr"], ["Text"])
    assert register_fields("AccountingRegister_M", own, {}) == ([], [], [])


def test_names_fit_and_never_change(spark):
    long = "Ы" * 40
    c = spark.createDataFrame([(long,), ("short",)], "n string")
    fitted = [r[0] for r in c.select(names.fitted(F.col("n"))).collect()]
    assert len(fitted[0].encode()) <= 63 and fitted[0].startswith("Ы" * 29 + "_") and fitted[1] == "short"
    held = names.Names()
    first = held.allocate("object", "Catalog_Объект")
    second = held.allocate("object", "Catalog_Обьект")
    assert first == "Catalog_Obekt" and second.startswith("Catalog_Obekt_") and held.allocate("object", "Catalog_Объект") == first
    assert names.Names(dict(held.given)).allocate("object", "Catalog_Обьект") == second
    assert held.allocate("field:X", "merged_on") == "merged_on" and held.allocate("field:Y", "merged_onъ") != "merged_on"


def test_error_texts(spark):
    import base64

    told = base64.b64encode("Описание ошибки, закодированное целиком".encode()).decode()
    bodies = [f"<m:message>{told}</m:message>", "a\x01b", "x" * 600, None]
    got = [r[0] for r in spark.createDataFrame([(b,) for b in bodies], "b string").select(text.error_text(F.col("b"))).collect()]
    assert got == ["Описание ошибки, закодированное целиком", "a<01>b", "x" * 500 + "... [+100 chars]", "<empty body>"]
    sizes = spark.createDataFrame([(5,), (2048,), (3 << 20,), (5 << 50,)], "n long")
    assert [r[0] for r in sizes.select(text.format_bytes(F.col("n"))).collect()] == ["5 B", "2.0 KB", "3.0 MB", "5120.0 TB"]
    spans = spark.createDataFrame([(0.12,), (64.0,), (3903.0,)], "s double")
    assert [r[0] for r in spans.select(text.format_duration(F.col("s"))).collect()] == ["0.1s", "1m 04s", "1h 05m 03s"]


def test_filters(spark):
    from datetime import date, datetime

    t = spark.createDataFrame([(datetime(2024, 1, d, 12),) for d in (1, 2, 3)], "t timestamp_ntz")
    assert t.where(filters.in_period(F.col("t"), date(2024, 1, 2), date(2024, 1, 2))).count() == 1
    assert t.where(filters.in_period(F.col("t"), None, datetime(2024, 1, 2, 12))).count() == 2
    assert t.where(filters.in_window(F.col("t"), datetime(2024, 1, 1, 12), datetime(2024, 1, 2, 12))).count() == 1
    assert t.select(filters.literal_moment(F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))).first()[0] == "0001-01-01T00:00:00"


def test_spec_helpers():
    assert TableSpec("Catalog_X", {"Ref_Key": "Guid"}, ("Ref_Key",)).page_key == "Ref_Key"
    with pytest.raises(ValueError):
        _ = TableSpec("Catalog_X", {}, ()).page_key


def test_a_package_is_parsed_once(spark, specs):
    head = f"<d:Recorder>{G1}</d:Recorder><d:Recorder_Type>StandardODATA.Document_D</d:Recorder_Type>"
    one = "<d:element><d:LineNumber>1</d:LineNumber><d:Qty>x</d:Qty></d:element><d:element/>"
    sets = [entry("AccumulationRegister_S", h + s) for h in (head, head.replace(G1, G2), "<d:Recorder_Type/>") for s in (f'<d:RecordSet m:type="Collection(x)">{one}</d:RecordSet>', "<d:RecordSet/>", "<d:LineNumber>4</d:LineNumber><d:Qty>y</d:Qty>", "")]
    spec = specs["AccumulationRegister_S"]
    for rejects in (False, True):
        entries = frame(spark, *sets, "<entry><d:RecordSet")
        got = packages.register_rows(entries, spec, F.lit(7), rejects)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_xml") + plan.count("XmlToStructsEvaluator") == 1 and "Union" not in plan
        kinds = got.groupBy("is_deleted_or_empty").count().collect()
        assert {r[0]: r["count"] for r in kinds} == {False: 13, True: 2}
