"""WARC: captures written as request, response or revisit, and metadata records; read back and assembled by identifier."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, sized

#: Uncompressed bytes of one archive file, on average: a reader's task holds one file.
FILE_BYTES = 32 << 20
#: Payloads of at least so many bytes are archived once.
REVISIT_BYTES = 100

# Fixed values of the format: field names and types of WARC 1.1, and the profile of a revisit by equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype="
END = "\r\n"


def _record_id(kind: str, *parts: Column) -> Column:
    h = F.md5(F.to_json(F.struct(F.lit(kind).alias("k"), *[p.alias(f"p{n}") for n, p in enumerate(parts)])))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(fields: list[tuple[str, str | Column]], block: Column) -> Column:
    """One record; a field that is null is left out. ``block`` is text, its length counted in UTF-8 bytes."""
    lines = [F.concat(F.lit(f"{k}: "), v if isinstance(v, Column) else F.lit(v), F.lit(END)) for k, v in fields]
    return F.concat(F.lit("WARC/1.1" + END), *[F.coalesce(x, F.lit("")) for x in lines], F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END + END), block, F.lit(END + END))


def archive(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write three records per row to gzip WARC files under ``path``.

    Of rows with equal payloads of 100 bytes or more, that with the smallest id (null last, then by address) is archived
    as a response; the others become revisits that refer to it and hold the HTTP header alone. A null payload is empty.
    Rows that repeat in id, address and payload get equal identifiers. Payload text is written as its UTF-8 bytes by
    Spark's own writer, whose commits survive lost and repeated tasks.
    """
    text = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), text.alias("body"), F.octet_length(text).alias("bytes"), F.sha2(text.cast("binary"), 256).alias("digest"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "url")
    groups = rows.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    shared = groups.where("first <> last").select("digest", "first")
    stat = rows.agg(F.avg("bytes").alias("mean"), F.count(F.lit(1)).alias("n")).first()
    n = shared.count()
    rows = rows.join(sized(shared, 4 * n), "digest", "left") if n else rows.withColumn("first", F.lit(None).cast("struct<none:boolean,id:long,url:string>"))
    revisit = F.col("first").isNotNull() & ~order.eqNullSafe(F.col("first"))

    main = _record_id("capture", F.col("id"), F.col("url"), F.col("digest"))
    origin = F.when(revisit, _record_id("capture", F.col("first.id"), F.col("first.url"), F.col("digest")))
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.lit("about:blank"))
    host = F.coalesce(F.nullif(F.regexp_extract(uri, r"^[a-z]+://([^/?#]+)", 1), F.lit("")), F.lit("localhost"))
    target = F.coalesce(F.nullif(F.regexp_extract(uri, r"^[a-z]+://[^/?#]+([^#]*)", 1), F.lit("")), F.lit("/"))
    asked = F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END + END))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END + END))
    kind = F.when(revisit, "revisit").otherwise("response")
    common = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    about = F.to_json(F.struct(F.col("id").alias("page_id"), "url"))
    records = F.concat(
        _record([("WARC-Type", "request"), ("WARC-Record-ID", _record_id("request", main)), ("WARC-Concurrent-To", main), *common, ("Content-Type", HTTP + "request")], asked),
        _record(
            [("WARC-Type", kind), ("WARC-Record-ID", main), ("WARC-Refers-To", origin), ("WARC-Profile", F.when(revisit, PROFILE)), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), *common, ("Content-Type", HTTP + "response")],
            F.when(revisit, head).otherwise(F.concat(head, F.col("body"))),
        ),
        _record([("WARC-Type", "metadata"), ("WARC-Record-ID", _record_id("metadata", main)), ("WARC-Concurrent-To", main), *common, ("Content-Type", "application/json")], about),
    )
    each = max(50, int(FILE_BYTES / ((stat["mean"] or 0) + 2000)))
    lines = records.substr(F.lit(1), F.char_length(records) - 1)  # the writer's line feed is the last record's last byte
    rows.select(lines.alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", each).text(path)


def parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an uncompressed archive, one record in memory at a time; field names in lower case.

    What doesn't begin like a record, or ends within one, raises an error.
    """
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record at {first[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            fields[k.strip().lower()] = v.strip()
        n = int(fields["content-length"])
        block, end = stream.read(n), stream.read(4)
        if len(block) < n or end != b"\r\n\r\n":
            raise ValueError(f"the record {fields.get('warc-record-id')} is cut")
        yield fields, block


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``. ``payload`` false leaves the payload bytes out, not their digest.

    A task holds a compressed file and unpacks it record by record. Empty blocks have no payload bytes; records that
    repeat are rows that repeat; fields that a record lacks are null; a folder without archives gives no rows.
    """
    names = ["type", "record_id", "concurrent_to", "refers_to", "target_uri", "payload_digest", "declared_bytes", "payload_bytes", "found_digest", "about", *(["payload"] if payload else [])]

    def rows(content: bytes) -> Iterator[tuple]:
        for f, block in parse(gzip.open(io.BytesIO(content))):
            kind = f["warc-type"]
            declared = size = found = about = body = None
            if kind in ("response", "revisit"):
                head, _, body = block.partition(b"\r\n\r\n")
                declared = next((int(x[15:]) for x in head.decode("latin-1").split(END) if x.lower().startswith("content-length:")), None)
                size, found = len(body), hashlib.sha256(body).hexdigest()
            elif kind == "metadata":
                about = block.decode()
            row = (kind, f["warc-record-id"], f.get("warc-concurrent-to"), f.get("warc-refers-to"), f.get("warc-target-uri"), f.get("warc-payload-digest"), declared, size, found, about)
            yield (*row, body) if payload else row

    kinds = [pa.string()] * 6 + [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                held, size = [], 0
                for r in rows(content.as_py()):
                    held.append(r)
                    size += 500 + (len(r[-1] or b"") if payload else 0)
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)

    schema = "type string, record_id string, concurrent_to string, refers_to string, target_uri string, payload_digest string, declared_bytes long, payload_bytes long, found_digest string, about string" + ", payload binary" * payload
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, schema)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, times (how often it was archived), request, main and metadata.

    Records meet under the identifier that they are concurrent to. ``main`` is the response or revisit; a capture
    without one has it null, as for a missing request or metadata record. Of records that repeat, one of each kind
    stays. An empty table gives none.
    """
    whole = F.struct(*records.columns)
    of = lambda *kinds: F.max(F.when(F.col("type").isin(*kinds), whole))
    grouped = records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
    return grouped.agg(
        F.count(F.when(F.col("type").isin("response", "revisit"), 1)).alias("times"), of("request").alias("request"), of("response", "revisit").alias("main"), of("metadata").alias("metadata")
    )


def resolved(found: DataFrame) -> DataFrame:
    """Per archived page: page_id, url, payload_bytes, payload_digest, record_type and the page that a revisit refers to.

    A page that was archived several times is as many rows; null ids and addresses are carried; a capture without a
    response or revisit is no page; a revisit whose origin is not in the archives has refers_to null.
    """
    about = F.from_json("metadata.about", "page_id long, url string")
    ws = Workspace(found.sparkSession, "captures")
    rows = ws.save(found.where("times > 0").select("capture_id", "times", about.alias("about"), "main"), "captures")
    wanted = rows.where("main.type = 'revisit'").select(F.col("main.refers_to").alias("capture_id")).distinct()
    n = wanted.count()
    origins = rows.join(sized(wanted, 4 * n), "capture_id", "left_semi").select(F.col("capture_id").alias("origin"), F.col("about.page_id").alias("refers_to"))
    joined = rows.join(sized(origins, 4 * n), F.col("main.refers_to") == F.col("origin"), "left")
    revisit = F.col("main.type") == "revisit"
    return joined.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times")))).select(
        F.col("about.page_id").alias("page_id"),
        F.col("about.url").alias("url"),
        F.when(revisit, F.col("main.declared_bytes")).otherwise(F.col("main.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.substring("main.payload_digest", 8, 64)).otherwise(F.col("main.found_digest")).alias("payload_digest"),
        F.col("main.type").alias("record_type"),
        "refers_to",
    )
