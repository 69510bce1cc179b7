"""Values that no table holds: metadata, answers, names, windows as filters, sizes, waits and crontabs against what they should give."""

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import convert, names, text
from tidemark.plans.full_load import Backoff, Cron, PageSize, Window
from tidemark.sources import metadata, odata
from tidemark.spec import TableSpec, group_key, owner_of, register_fields, save_order

CASES = {}


def query(sql):
    return lambda f: CASES.setdefault(f.__name__, (f, sql))


def values(columns: str, *rows: tuple) -> str:
    """SQL of literal rows."""
    told = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(told, r)) + ')' for r in rows)}) t({columns})"


_G = ("c0a80001-0000-0000-0000-000000000001", "c0a80001-0000-0000-0000-000000000002", "c0a80001-0000-0000-0000-000000000003")
_NODES = f'{{"value": [{{"Ref_Key": "{_G[0].upper()}", "ReceivedNo": "41", "ThisNode": false}}, {{"Ref_Key": "{_G[1]}", "ReceivedNo": 7}}, {{"Ref_Key": "{_G[2]}", "ReceivedNo": 9, "ThisNode": true}}]}}'


_META = """<Edmx><DataServices><Schema>
<EntityType Name="Catalog_X"><Key><PropertyRef Name="Ref_Key"/></Key><Property Name="Ref_Key" Type="Edm.Guid"/><Property Name="Any" Type="Edm.String"/><Property Name="Any_Type" Type="Edm.String"/><Property Name="Rows" Type="Collection(StandardODATA.Catalog_X_Rows_RowType)"/><Property Name="Pic" Type="Edm.Stream"/></EntityType>
<EntityType Name="Catalog_X_Rows"><Key><PropertyRef Name="Ref_Key"/><PropertyRef Name="LineNumber"/></Key><Property Name="Ref_Key" Type="Edm.Guid"/><Property Name="LineNumber" Type="Edm.Int64"/><Property Name="V" Type="Edm.Double"/></EntityType>
<ComplexType Name="Catalog_X_Rows_RowType"><Property Name="V"/></ComplexType>
<EntityType Name="Report_Z"><Property Name="Q" Type="Edm.String"/></EntityType>
</Schema></DataServices></Edmx>"""


_ANSWERS = {"<feed/>": "ok", '<?xml version="1.0"?><a:feed xmlns:a="x"><entry/></a:feed>': "ok", "<html/>": "refused", "<feed>": "refused", "": "refused", '{"value": []}': "refused"}
_GUIDS = (f"urn:uuid:{_G[0]}", f"uuid:{_G[0]}", f"urn:{_G[0]}", f"{{{_G[0].upper()}}}", _G[0].replace("-", ""), f" {_G[0]} ")
_REG_SPEC = TableSpec("AccumulationRegister_R", {"Recorder": "Guid", "LineNumber": "Int64"}, ("Recorder", "LineNumber"), ("Recorder",))
_DOC_SPEC = TableSpec("Document_D", {"Ref_Key": "Guid", "Date": "DateTime"}, ("Ref_Key",))
_INFO_SPEC = TableSpec("InformationRegister_I", {"Item": "String", "Period": "DateTime"}, ("Item", "Period"))
_W = Window(datetime(2024, 1, 1), datetime(2024, 1, 31))
_FROM, _TO = "datetime'2024-01-01T00:00:00'", "datetime'2024-01-31T00:00:00'"
_RUSSIAN = ("Контрагенты", "ЩётчикОбъём", "Подъезд", "Сер", "Сэр", "ЗаказКлиента", "Период", "merged_on", "ВалютнаяСуммаВзаиморасчётовПоДоговоруКонтрагентаСОченьДлиннымИменем", "Ёж", "ABCя")
_LATIN = ("Kontragenty", "SchyotchikObyom", "Podezd", "Ser", "Ser", "ZakazKlienta", "Period", "merged_on", "ValyutnayaSummaVzaimoraschyotovPoDogovoruKontragentaSOchenDlinnymImenem", "Yozh", "ABCya")
_ERRORS = {
    '<?xml version="1.0"?><m:error><m:message xml:lang="ru">Нет  прав\nдоступа</m:message></m:error>': "Нет прав доступа",
    '{"exception": {"descr": "HTTP: Forbidden. outer", "inner": {"descr": "Key  is missing", "inner": {"descr": "missing"}}}}': "Key is missing",
    "<html><body><b>Failed by reason: </b><br>No <i>such</i> table</body></html>": "No such table",
    "": "<empty body>",
    "plain   text": "plain text",
}


@pytest.mark.parametrize("russian, latin", zip(_RUSSIAN, _LATIN))
def test_transliteration(spark, russian, latin):
    assert spark.range(1).select(names.transliterated(F.lit(russian))).first()[0] == latin


def test_error_texts(spark):
    assert [r[0] for r in spark.createDataFrame([(k,) for k in _ERRORS], "body string").select(text.error_text(F.col("body"))).collect()] == list(_ERRORS.values())
    assert [text.error_message(k.encode()) for k in _ERRORS] == list(_ERRORS.values())


def test_guids(spark):
    assert {spark.range(1).select(convert.convert(F.lit(g), "Guid")).first()[0] for g in _GUIDS} == {_G[0]}


@query("""SELECT * FROM (VALUES ('Сер', 'Ser'), ('Сэр', 'Ser_' || left(md5('Сэр'), 4)), ('Объект', 'Obekt'), ('Обьект', 'Obekt_' || left(md5('Обьект'), 4)), ('merged_onъ', 'merged_on_' || left(md5('merged_on'), 4))) t(source, name)""")
def name_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal transliterations: the first keeps the plain name, the next gets a hash of its source; service names are hashed at once."""
    held = names.Names()
    rows = [(s, held.allocate("field:Catalog_X", s)) for s in ("Сер", "Сэр", "Объект", "Обьект", "merged_onъ")]
    return spark.createDataFrame(rows, "source string, name string")


@query("""SELECT * FROM (VALUES ('dimension', 0, 'Item_Key'), ('dimension', 1, 'Store_Key'), ('resource', 0, 'Qty'), ('resource', 1, 'Sum'), ('attribute', 0, 'Note')) t(role, position, field)""")
def register_field_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["Recorder", "Recorder_Type", "LineNumber", "Period", "Active", "RecordType", "Item_Key", "Store_Key", "Qty", "Sum", "Note"]
    tables = {"AccumulationRegister_Sales_Balance": ["Item_Key", "QtyBalance"], "AccumulationRegister_Sales_Turnover": ["Period", "Item_Key", "Store_Key", "SumTurnover", "SumReceipt", "GoneTurnover"]}
    roles = zip(("dimension", "resource", "attribute"), register_fields("AccumulationRegister_Sales", fields, tables))
    return spark.createDataFrame([(role, k, f) for role, found in roles for k, f in enumerate(found)], "role string, position int, field string")


@query("""SELECT * FROM (VALUES (0, 'Catalog_A'), (1, 'Document_B'), (2, 'Document_A'), (3, 'InformationRegister_C'), (4, 'AccumulationRegister_D'), (5, 'AccountingRegister_E'), (6, 'Task_Z')) t(position, object)""")
def save_order_of_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = save_order(["AccountingRegister_E", "Task_Z", "Document_B", "InformationRegister_C", "Document_A", "AccumulationRegister_D", "Catalog_A"])
    return spark.createDataFrame(list(enumerate(found)), "position int, object string")


@query(values("node, received_no", (_G[0], 41), (_G[1], 7)))
def node_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange nodes with the last package that each is known to have; the source's own is left out."""
    return spark.createDataFrame([(n, metadata.received_no(_NODES, n)) for n in metadata.nodes(_NODES)], "node string, received_no int")


@query(values("object, field, type, in_key, grouped", ("Catalog_X", "Ref_Key", "Guid", True, False), ("Catalog_X", "Any", "String", False, False), ("Catalog_X", "Any_Guid", "Guid", False, False), ("Catalog_X", "Any_Type", "String", False, False), ("Catalog_X_Rows", "Ref_Key", "Guid", True, True), ("Catalog_X_Rows", "LineNumber", "Int64", True, False), ("Catalog_X_Rows", "V", "Double", False, False)))
def metadata_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a metadata document says of supported objects: streams and collections are no columns, a composite field has its reference beside it."""
    rows = [(s.name, f, t, f in s.pk, f in s.group_key) for s in metadata.parse(_META).values() for f, t in s.fields.items()]
    return spark.createDataFrame(rows, "object string, field string, type string, in_key boolean, grouped boolean")


@query(values("body, verdict", *_ANSWERS.items()))
def envelope_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer that is cut or has another root is refused, never taken for an empty one."""

    def verdict(body: str) -> str:
        try:
            metadata.checked(body.encode(), "feed")
            return "ok"
        except metadata.BadAnswer:
            return "refused"

    return spark.createDataFrame([(b, verdict(b)) for b in _ANSWERS], "body string, verdict string")


@query(values("declared, sent, verdict", (None, 90, "90"), (100, 100, "100"), (101, 0, "refused"), (10, 101, "refused"), (None, 101, "refused")))
def bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer may neither declare nor send more than the limit, here 100 bytes."""

    def verdict(declared: int | None, sent: int) -> str:
        try:
            return str(len(metadata.bounded((b"x" for _ in range(sent)), declared, 100)))
        except metadata.BadAnswer:
            return "refused"

    cases = [(None, 90), (100, 100), (101, 0), (10, 101), (None, 101)]
    return spark.createDataFrame([(d, s, verdict(d, s)) for d, s in cases], "declared int, sent int, verdict string")


@query(values("object, owner, grouped", ("Catalog_X_Rows", "Catalog_X", "Ref_Key"), ("Catalog_X_More_Rows", "Catalog_X_More", "Ref_Key"), ("AccumulationRegister_R", None, "Recorder,Recorder_Type"), ("InformationRegister_I", None, "")))
def owners_and_group_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = {"Catalog_X", "Catalog_X_More"}
    keys = {"Catalog_X_Rows": ("Ref_Key", "LineNumber"), "Catalog_X_More_Rows": ("Ref_Key", "LineNumber"), "AccumulationRegister_R": ("Recorder", "Recorder_Type", "LineNumber"), "InformationRegister_I": ("Period", "Item")}
    return spark.createDataFrame([(n, owner_of(n, known), ",".join(group_key(k))) for n, k in keys.items()], "object string, owner string, grouped string")


@query(values("source, told", ("DateTime", "datetime'0209-01-02T00:00:00'"), ("String", "'O''Neil'"), ("Double", "0.0000001"), ("Guid", f"guid'{_G[0]}'"), ("Boolean", "false"), ("Int64", "-5")))
def filter_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = {"DateTime": datetime(209, 1, 2), "String": "O'Neil", "Double": 1e-7, "Guid": _G[0], "Boolean": False, "Int64": -5}
    return spark.createDataFrame([(t, odata.literal(v, t)) for t, v in given.items()], "source string, told string")


@query(values("object, told, paged_by", ("Document_D", f"Date ge {_FROM} and Date lt {_TO}", "Ref_Key"), ("AccumulationRegister_R", f"RecordSet/any(r: r/Date ge {_FROM} and r/Date lt {_TO})", "Recorder"), ("InformationRegister_I", f"Date ge {_FROM} and Date lt {_TO}", "Item,Period")))
def window_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window as the service's filter, one test over one record where entries are record sets, and the total order of pages."""
    return spark.createDataFrame([(s.name, odata.window_filter(s, "Date", _W), ",".join(odata.page_order(s))) for s in (_DOC_SPEC, _REG_SPEC, _INFO_SPEC)], "object string, told string, paged_by string")


@query(values("step, size", (0, 1000), (1, 320), (2, 1000), (3, 250), (4, 250), (5, 62), (6, 1)))
def page_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries to ask for: what fits the target weight, a quarter after a refusal and never more again."""
    p, out = PageSize(1000), [1000]
    out += [p.after(10, 1 << 20), p.after(1, 100), p.refused(), p.after(1, 100), p.refused()]
    for _ in range(5):
        p.refused()
    return spark.createDataFrame(list(enumerate([*out, p.size])), "step int, size int")


@query(values("failure, heavy", ("HTTP 500", True), ("HTTP 404", False), ("HTTP 401", False), ("timeout", True), ("too large", True), ("connection", False)))
def page_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which failures a smaller page may mend."""
    from urllib.error import HTTPError, URLError

    http = lambda code: HTTPError("u", code, "", None, None)
    seen = {"HTTP 500": http(500), "HTTP 404": http(404), "HTTP 401": http(401), "timeout": TimeoutError(), "too large": metadata.BadAnswer(), "connection": URLError("x")}
    return spark.createDataFrame([(n, odata.too_heavy(e)) for n, e in seen.items()], "failure string, heavy boolean")


@query(values("attempt, wait", (1, 120), (2, 240), (3, 480), (4, 960), (5, 1800), (6, 1800), (7, 1800)))
def backoff_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waits after failures double up to half an hour, which a failure that no retry mends has at once."""
    b = Backoff(60)
    waits = [b.failed() for _ in range(6)]
    b.succeeded()
    return spark.createDataFrame([(k, int(w)) for k, w in enumerate([*waits, b.failed(permanent=True)], 1)], "attempt int, wait int")


@query(values("crontab, tick", ("*/15 * * * *", "2024-02-29 00:00:00"), ("30 4 * * 1-5", "2024-02-29 04:30:00"), ("0 0 1 * *", "2024-03-01 00:00:00"), ("5 1 * * 7", "2024-03-03 01:05:00"), ("0 12 13 * 5", "2024-03-01 12:00:00")))
def cron_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = datetime(2024, 2, 28, 23, 50)
    return spark.createDataFrame([(c, str(Cron(c).after(at))) for c in ("*/15 * * * *", "30 4 * * 1-5", "0 0 1 * *", "5 1 * * 7", "0 12 13 * 5")], "crontab string, tick string")


@pytest.mark.parametrize("name", sorted(CASES))
def test_literal_cases(spark, name):
    made, sql = CASES[name]
    df, found = made(spark, ""), duckdb.connect().execute(sql)
    cols = [c[0] for c in found.description]
    assert sorted(map(repr, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(repr, found.fetchall()))
