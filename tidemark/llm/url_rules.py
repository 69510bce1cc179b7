"""URL filters: reversed-host keys turn rules into intervals; a sorted sweep keeps the nested rules that are active.

A rule (host, path) fits its host and every subdomain where the url's path starts with the rule's. A url asks once for
each rule host that is its host or a parent of it. Under a rule host, a rule is the interval of the canonical keys
(labels of the host in reverse, then the path) that start with its own key. Such intervals nest or are disjoint, so in
the order of keys a running sum of +1 at each start and -1 at each end is the height of the stack of active rules, and
the stack's top at a url is the last start before it that reached the url's height. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_ROWS, Workspace

#: Urls that one sweep orders at least; a rule host with more is swept in parts, each with the host's rules.
WIDTH = 4096
#: Bytes of hosts and paths that one broadcast may hold; beyond it the join shuffles.
BROADCAST_BYTES = 16 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str | Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    c = F.col(url) if isinstance(url, str) else url
    return F.translate(F.coalesce(F.regexp_extract(c, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    c = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(c, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """A host and its parents, from the whole down to the last label."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels) - k + 1), "."))


def canonical(host: Column, path: Column) -> Column:
    """The key as bytes: labels in reverse, then the path."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), path).cast("binary")


def _small(df: DataFrame, *texts: str) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows and the bytes of ``texts`` fit the bounds; else unchanged."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(sum((F.octet_length(c) for c in texts), F.lit(0))).alias("b")).first()
    return F.broadcast(df) if size["n"] <= BROADCAST_ROWS and (size["b"] or 0) <= BROADCAST_BYTES else df


def _rules(rules: DataFrame) -> DataFrame:
    """(rhost, rpath, verdict), one row for each host and path: A-Z of hosts lower-cased, null paths empty, a block goes before other verdicts."""
    r = rules.where("host IS NOT NULL").select(F.translate("host", _UPPER, _LOWER).alias("rhost"), F.coalesce("path", F.lit("")).alias("rpath"), "verdict")
    first = F.min(F.struct((F.col("verdict") != "block").alias("other"), "verdict"))
    return r.where("verdict IS NOT NULL").groupBy("rhost", "rpath").agg(first.alias("v")).select("rhost", "rpath", F.col("v.verdict").alias("verdict"))


def top_rules(urls: DataFrame, rules: DataFrame, width: int = WIDTH) -> DataFrame:
    """(host, path, rpath, rhost, verdict): for each of the distinct ``urls`` (host, path) and each rule host above it, the longest rule that fits.

    ``rules`` are unique (rhost, rpath, verdict). A rule host with many urls is swept in parts chosen by a hash; each
    part holds at least as many urls as the host has rules, so the repeated rules are never more than the urls.
    """
    ws = Workspace(urls.sparkSession, "sweep")
    hosts = rules.groupBy("rhost").agg(F.count(F.lit(1)).alias("n_rules"))
    asked = ws.save(urls.select("host", "path", F.explode(suffixes(F.col("host"))).alias("rhost")).join(_small(hosts, "rhost"), "rhost"), "asked")
    parts = ws.save(asked.groupBy("rhost").agg(F.ceil(F.count(F.lit(1)) / F.greatest(F.lit(width), F.max("n_rules"))).alias("parts")), "parts")
    parts = _small(parts, "rhost")
    asked = asked.join(parts, "rhost").select("rhost", F.pmod(F.xxhash64("host", "path"), "parts").alias("part"), canonical(F.col("rhost"), F.col("path")).alias("key"), "host", "path")

    dealt = rules.join(parts, "rhost").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    key = canonical(F.col("rhost"), F.col("rpath"))
    none = F.lit(None).cast("string")
    # 0xFF is no byte of UTF-8: the end comes after every key with this prefix, and inner ends before outer ones.
    edges = dealt.select("rhost", "part", F.explode(F.array(F.struct(key.alias("key"), F.lit(1).alias("step")), F.struct(F.concat(key, F.lit(b"\xff")).alias("key"), F.lit(-1).alias("step")))).alias("e"), "rpath", "verdict")
    edges = edges.select("rhost", "part", "e.key", "e.step", "rpath", "verdict", none.alias("host"), none.alias("path"))
    events = edges.unionByName(asked.select("rhost", "part", "key", F.lit(0).alias("step"), none.alias("rpath"), none.alias("verdict"), "host", "path"))

    order = [F.col("key"), F.col("step").desc()]  # a start goes before urls of the same key
    sweep = Window.partitionBy("rhost", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    level = Window.partitionBy("rhost", "part", "height").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = events.withColumn("height", F.sum("step").over(sweep)).where("step >= 0")
    top = F.last(F.when(F.col("step") == 1, F.struct("rpath", "verdict")), ignorenulls=True).over(level)
    found = swept.withColumn("top", top).where("step = 0 AND height > 0")
    return found.select("host", "path", "rhost", F.col("top.rpath").alias("rpath"), F.col("top.verdict").alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", width: int = WIDTH) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``; ``rules`` has the columns host, path and verdict.

    Of the rules that fit, that with the most characters of host and path together wins, of equal ones that with the
    longer host. Where none fits, rule is null and the verdict ``default``. A null url or one without ``://`` has an empty
    host and path, which a rule for the empty host alone fits. Repeated rows have repeated results, null ids are carried,
    other columns are not read, an empty table gives none; no rules leave every url to the default. Rules without a host
    or verdict are left out, a null path is empty, and of repeated rules a block counts.
    """
    ws = Workspace(pages.sparkSession, "urls")
    asked = pages.select(F.col(id_col).alias("page_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    rules = ws.save(_rules(rules), "rules")
    won = top_rules(asked.select("host", "path").distinct(), rules, width)
    best = F.max(F.struct((F.length("rhost") + F.length("rpath")).alias("n"), F.length("rhost").alias("h"), F.concat("rhost", "rpath").alias("rule"), "verdict"))
    won = ws.save(won.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict"), "won")
    out = asked.join(_small(won, "host", "path", "rule"), ["host", "path"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
