"""Readable messages from a source's error answers, and formats of sizes and durations."""

from __future__ import annotations

import base64
import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How long a message may be, what looks like base64, and which characters are invisible.
MOST_CHARS = 500
BASE64 = r"^[A-Za-z0-9+/\s]{40,}={0,2}$"
INVISIBLE = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]"


def excerpt(c: Column) -> Column:
    """One line, cut at 500 characters with a note of what is missing."""
    line = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    n = F.char_length(line)
    return F.when(n > MOST_CHARS, F.concat(F.left(line, F.lit(MOST_CHARS)), F.lit("... [+"), (n - MOST_CHARS).cast("string"), F.lit(" chars]"))).otherwise(line)


def decoded(c: Column) -> Column:
    """Text that is base64 of UTF-8 text, decoded; anything else as it is."""
    bare = F.regexp_replace(c, r"\s", "")
    raw = F.try_to_binary(F.when(c.rlike(BASE64) & (F.length(bare) % 4 == 0), bare), F.lit("base64")).cast("string")
    return F.when(F.is_valid_utf8(raw) & (F.trim(raw) != ""), raw).otherwise(c)


def visible(c: Column) -> Column:
    """Control characters other than white space as their code in angle brackets."""
    parts = F.split(c, "")
    shown = F.transform(parts, lambda ch: F.when(ch.rlike(f"^{INVISIBLE}$"), F.concat(F.lit("<"), F.lpad(F.hex(F.ascii(ch)), 2, "0"), F.lit(">"))).otherwise(ch))
    return F.when(c.rlike(INVISIBLE), F.array_join(shown, "")).otherwise(c)


def readable(c: Column) -> Column:
    return excerpt(visible(decoded(F.trim(c))))


def descriptions(body: str) -> list[str] | None:
    """Descriptions along the chain of nested causes, without those that another one contains."""
    try:
        node = json.loads(body)
    except (TypeError, ValueError):
        return None
    node = node.get("exception") or node if isinstance(node, dict) else None
    chain = []
    while isinstance(node, dict):
        chain.append(" ".join(str(node.get("descr") or "").split()))
        node = node.get("inner")
    told = [d for d in dict.fromkeys(chain) if d]
    told = [d for d in told if not any(d != o and d in o for o in told)]
    return [d for d in told if not d.startswith("HTTP: ")] or told or None


#: The chain is recursive, which no expression follows; error answers are few, so a row function does no harm.
_descriptions = F.udf(descriptions, T.ArrayType(T.StringType()), useArrow=False)


def error_message(body: bytes) -> str:
    """``error_text`` of one answer that the driver or a task holds."""
    text = body.decode("utf-8", "replace").strip().lstrip("\ufeff")
    if m := re.search(r"(?s)<m:message[^>]*>(.*?)</m:message>", text):
        text = m[1]
    elif told := descriptions(text) if text.startswith("{") else None:
        return " | ".join(map(_line, told))
    elif m := re.search(r"(?si)by reason:\s*</b>\s*<br>(.*?)</body>", text):
        text = re.sub("<[^>]+>", " ", m[1])
    return _line(text) or "<empty body>"


def _line(text: str) -> str:
    text, bare = text.strip(), re.sub(r"\s", "", text)
    if re.match(BASE64, text) and len(bare) % 4 == 0:
        try:
            text = base64.b64decode(bare, validate=True).decode().strip() or text
        except ValueError:  # it only looked like base64
            pass
    text = re.sub(INVISIBLE, lambda m: f"<{ord(m[0]):02X}>", text)
    line = " ".join(text.split())
    return line if len(line) <= MOST_CHARS else f"{line[:MOST_CHARS]}... [+{len(line) - MOST_CHARS} chars]"


def error_text(body: Column) -> Column:
    """What an error answer says: the XML message, the JSON causes, the HTML reason, else the whole body in one line."""
    text = F.trim(F.regexp_replace(F.coalesce(body, F.lit("")), "^﻿+", ""))
    xml = F.regexp_extract(text, r"(?s)<m:message[^>]*>(.*?)</m:message>", 1)
    html = F.regexp_extract(text, r"(?si)by reason:\s*</b>\s*<br>(.*?)</body>", 1)
    told = _descriptions(F.when(text.startswith("{"), text))
    causes = F.array_join(F.transform(told, readable), " | ")
    return (
        F.when(text == "", "<empty body>")
        .when(text.rlike(r"(?s)<m:message[^>]*>.*?</m:message>"), readable(xml))
        .when(F.size(told) > 0, causes)
        .when(text.rlike(r"(?si)by reason:\s*</b>\s*<br>.*?</body>"), readable(F.regexp_replace(html, "<[^>]+>", " ")))
        .otherwise(readable(text))
    )


def masked(c: Column) -> Column:
    """Addresses without the user and password that they carry."""
    return F.regexp_replace(c, r"://[^/\s@]+@", "://***@")


def format_bytes(c: Column) -> Column:
    """Bytes as a whole number, larger units with one decimal, up to TB."""
    units = ("B", "KB", "MB", "GB", "TB")
    size = c.cast("double")
    out = F.when(size < 1024, F.concat(F.format_string("%.0f", size), F.lit(" B")))
    for k, u in enumerate(units[1:], 1):
        told = F.concat(F.format_string("%.1f", size / 1024**k), F.lit(f" {u}"))
        out = out.otherwise(told) if u == units[-1] else out.when(size < 1024 ** (k + 1), told)
    return out


def format_duration(c: Column) -> Column:
    """Seconds with one decimal under a minute, else whole minutes or hours with what is left, padded to two digits."""
    s = c.cast("double")
    whole = F.floor(s).cast("int")
    minutes = F.floor(whole / 60).cast("int")
    long = F.format_string("%dh %02dm %02ds", F.floor(whole / 3600).cast("int"), minutes % 60, whole % 60)
    return F.when(s < 60, F.format_string("%.1fs", s)).when(whole < 3600, F.format_string("%dm %02ds", minutes, whole % 60)).otherwise(long)
