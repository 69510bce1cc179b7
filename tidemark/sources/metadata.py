"""Object specifications from a source's metadata document."""

from __future__ import annotations

import json
import logging
import xml.etree.ElementTree as ET
from collections.abc import Iterable
from xml.parsers import expat

from tidemark.spec import RECORDERS, SPARK_TYPES, SUPPORTED, TableSpec, group_key, owner_of, register_fields

log = logging.getLogger(__name__)

MOST_BYTES, CHUNK_BYTES = 512 << 20, 1 << 20
_NOT_STORED = ("Collection", "Stream")
_RECORD, _VIRTUAL = "_RecordType", ("_RecordType", "_RowType")


class BadAnswer(ValueError):
    """An answer that is too large or has not the expected root."""


def bounded(chunks: Iterable[bytes], declared: int | None = None, most: int = MOST_BYTES) -> bytes:
    """All bytes of an answer, or an error once it declares or delivers more than the limit."""
    if declared is not None and declared > most:
        raise BadAnswer(f"the answer declares {declared} bytes; the limit is {most}")
    out = bytearray()
    for c in chunks:
        out += c
        if len(out) > most:
            raise BadAnswer(f"the answer has more than {most} bytes")
    return bytes(out)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def rooted(body: str | bytes, root: str) -> ET.Element:
    """The document, if it has the root: anything else is an error and never an empty answer."""
    try:
        found = ET.fromstring(body)
    except ET.ParseError as e:
        raise BadAnswer(f"no XML: {e}") from e
    if _local(found.tag) != root:
        raise BadAnswer(f"the answer is a <{_local(found.tag)}>, not a <{root}>")
    return found


def checked(body: bytes, root: str) -> None:
    """An error unless the document is whole and has the root, without building its tree."""
    first: list[str] = []
    parser = expat.ParserCreate()
    parser.StartElementHandler = lambda name, _: first or first.append(name.rsplit(":", 1)[-1])
    try:
        for at in range(0, len(body), CHUNK_BYTES):
            parser.Parse(body[at : at + CHUNK_BYTES], False)
        parser.Parse(b"", True)
    except expat.ExpatError as e:
        raise BadAnswer(f"no XML: {e}") from e
    if first != [root]:
        raise BadAnswer(f"the answer is a <{first[0] if first else ''}>, not a <{root}>")


def _fields(item: ET.Element, name: str) -> dict[str, str]:
    declared = {p.get("Name"): p.get("Type", "").removeprefix("Edm.") for p in item if _local(p.tag) == "Property"}
    out: dict[str, str] = {}
    for f, t in declared.items():
        if t.startswith(_NOT_STORED):
            continue
        if t not in SPARK_TYPES:
            log.warning("%s.%s has the unknown type %s and is stored as text", name, f, t)
            t = "String"
        out[f] = "Guid" if f == "Recorder" else t
    for f in [f.removesuffix("_Type") for f in out if f.endswith("_Type")]:
        if f in RECORDERS and f in out:
            out[f] = "Guid"
        elif f in out:  # a composite field: its text, and beside it the reference that it may hold
            out[f], out[f"{f}_Guid"] = "String", "Guid"
    return out


def _key(item: ET.Element, fields: dict[str, str], name: str) -> tuple[str, ...]:
    told = [r.get("Name") for k in item if _local(k.tag) == "Key" for r in k if _local(r.tag) == "PropertyRef"]
    if missing := [k for k in told if k not in fields]:
        log.error("the key of %s names %s, which are no columns: its rows can't be told apart", name, missing)
    return tuple(k for k in told if k in fields)


def parse(body: str | bytes) -> dict[str, TableSpec]:
    """Specifications of all supported objects, by name.

    A register with a recorder is described by its record type, one without by its own entity; catalogs, documents and
    their table parts by theirs. A name with a row type beside it is a table part.
    """
    nodes = list(rooted(body, "Edmx").iter())
    entities = {n.get("Name"): n for n in nodes if _local(n.tag) == "EntityType"}
    complex_ = {n.get("Name"): [p.get("Name") for p in n if _local(p.tag) == "Property"] for n in nodes if _local(n.tag) == "ComplexType"}
    out: dict[str, TableSpec] = {}
    for published, item in entities.items():
        register = published.split("_", 1)[0].endswith("Register")
        name = published.removesuffix(_RECORD) if register else published
        if not published.startswith(tuple(f"{c}_" for c in SUPPORTED)) or name.endswith(_VIRTUAL):
            continue
        if register and name == published and f"{name}{_RECORD}" in entities:
            continue  # describes the record set, not a record
        fields = _fields(item, name)
        pk = _key(item, fields, name)
        roles = register_fields(name, list(fields), complex_) if register else ((), (), ())
        out[name] = TableSpec(name, fields, pk, group_key(pk), *map(tuple, roles), is_table_part=not register and f"{name}_RowType" in complex_)
    owners = {n for n, s in out.items() if not s.is_table_part}
    for part in (n for n, s in out.items() if s.is_table_part):
        if owner := owner_of(part, owners):
            s = out[owner]
            out[owner] = TableSpec(s.name, s.fields, s.pk, s.group_key, s.dimensions, s.resources, s.attributes, False, (*s.parts, part))
    return out


def nodes(body: str | bytes) -> dict[str, dict]:
    """Exchange nodes by canonical identifier, from a JSON listing; the source's own node is left out."""
    from uuid import UUID

    told = json.loads(body)
    if not isinstance(told, dict) or "value" not in told:
        raise BadAnswer("the answer lists no nodes")
    return {str(UUID(n["Ref_Key"])): n for n in told["value"] if not n.get("ThisNode")}


def received_no(body: str | bytes, node: str) -> int:
    """The last package number that the source knows as received by the node."""
    from uuid import UUID

    found = nodes(body)
    key = str(UUID(node.strip()))
    if key not in found:
        raise ValueError(f"no exchange node {node}; there are {', '.join(sorted(found)) or 'none'}")
    return int(found[key]["ReceivedNo"])
