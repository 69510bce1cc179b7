"""Conversation repair, URL rules and resampling against plain versions and on odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import repair, resampling, url_rules
from tidemark.llm.common import Workspace

# ---- conversation repair


def plain_faults(rows):
    out = []
    for k, (role, text) in enumerate(rows):
        words = text.strip(" \t\n\v\f\r")
        out.append("blank" if not words else "duplicate" if (role, text) in rows[:k] else None if words[-1] in ".!?" else "truncated")
    return out


def plain_repair(rows):
    """Least (cost, labels) and its lines among all edits with at most two inserts in each gap, by trying them."""
    faults = plain_faults(rows)
    pads = [[]] + [[r] for r in ("user", "assistant")] + [[a, b] for a in ("user", "assistant") for b in ("user", "assistant")]
    ways = [(0, "", ())]
    for k in range(len(rows) + 1):
        ways = [(c + 3 * len(p), s + "I" * len(p), lines + tuple((r, "") for r in p)) for c, s, lines in ways for p in pads]
        if k < len(rows):
            role, text = rows[k]
            more = 3 if faults[k] == "truncated" else 0
            next_ways = [(c + 4, s + "D", lines) for c, s, lines in ways]
            if faults[k] not in ("blank", "duplicate"):
                next_ways += [(c + more, s + "K", lines + ((role, text),)) for c, s, lines in ways]
                next_ways += [(c + 3 + more, s + "R", lines + ((r, text),)) for c, s, lines in ways for r in ("user", "assistant")]
            ways = [w for w in next_ways if re.fullmatch("s?(ua)*u?", "".join(r[0] if r else "?" for r, _ in w[2]))]
    done = [w for w in ways if re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in w[2]))]
    return min(done)


ROWS = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "u", ""]), st.sampled_from(["Yes.", "no", "Why?", " ", "", "Go!  "])), max_size=4)


@settings(max_examples=120, deadline=None)
@given(ROWS)
def test_repair_finds_the_least_path(rows):
    cost, labels, lines = plain_repair(rows)
    edits = list(repair._edits((0, k, r, t) for k, (r, t) in enumerate(rows)))
    assert (sum(e.cost for e in edits), "".join(e.label for e in edits)) == (cost, labels)
    assert [(e.role, e.text) for e in edits if e.label != "D"] == list(lines)
    assert [e.row.fault for e in edits if e.row] == plain_faults(rows)


def test_repair_holds_undecided_rows_only():
    path, most, out = repair.Path(), 0, 0
    for k in range(20_000):
        out += len(path.read(repair.Row(k, ("user", "assistant")[k % 2] if k % 7 else "user", "Fine.", None)))
        most = max(most, len(path.waiting))
    assert most < 20 and out > 19_900
    same = list(repair._edits((0, 1, "user", "Yes.") for _ in range(200_000)))
    assert "".join(e.label for e in same) == "K" + "D" * 199_999 + "I"


def test_repair_on_odd_tables(spark):
    rows = [(1, 2, "assistant", "Fine.", 7), (1, None, "user", "Hm?", 7), (1, 9, None, None, 7), (None, 1, "user", "What", 7), (2, 1, "", "Yes.", 7), (2, 1, "", "Yes.", 7), (3, 4, "user", "long " * 300_000 + ".", 7)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place long")
    got = {r["conv_id"]: r for r in repair.summaries(repair.edit_log(df), df).collect()}
    digest = lambda *lines: hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert tuple(got[1])[1:] == (9 - 2 + 1 - 2, 1, 0, 0, 1, 4, "KKD", digest("user:Hm?", "assistant:Fine."))
    assert tuple(got[None])[1:] == (0, 0, 0, 1, 0, 4, "D", digest())
    assert tuple(got[2])[1:] == (0, 0, 1, 0, 1, 8, "DD", digest())
    assert tuple(got[3])[1:] == (0, 0, 0, 0, 0, 3, "KI", digest(f"user:{rows[-1][3]}", "assistant:"))
    empty = spark.createDataFrame([], df.schema)
    assert repair.summaries(repair.edit_log(empty), empty).collect() == []
    log = [(r["place"], r["edit"], r["fault"], r["was"], r["role"], r["text"]) for r in repair.edit_log(df).where("conv_id = 1").collect()]
    assert log == [(0, "K", None, "user", "user", "Hm?"), (1, "K", None, "assistant", "assistant", "Fine."), (2, "D", "blank", " ", None, None)]


def test_damage(spark):
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate([("system", "Be. brief!"), ("assistant", "So?"), (None, None)])] + [(5, None, "user", "a.b")]
    got = Counter(map(tuple, repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()))
    want = Counter()
    for c, t, r, x in rows:
        k, r, x = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20, r or " ", x or " "
        row = (c, t, "user" if k == 4 else r, "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x)
        want[row] += {0: 0, 3: 2}.get(k, 1)
    assert got == +want and got.total() != len(rows)


# ---- URL rules

CASES = [
    (1, "HTTPS://WWW.Example.COM/en/a?b#c"), (2, "http://example.com/en/"), (3, "http://example.com/EN/"), (4, "http://notexample.com/en/x"), (5, "http://example.com"), (6, "http://com/"),
    (7, "https://a.b.example.net/fr/1"), (8, "https://net/es/"), (9, "https://x.net/de/"), (10, None), (11, ""), (12, "no scheme/en/"), (13, "http://"), (14, "a://b://c.com/x"),
    (15, "http://x.com?/en/"), (16, "http://x.com#://y.net/es/"), (16, "http://x.com#://y.net/es/"), (None, "http://ÄX.com/\U0010ffff"), (17, "http://example.com/en/\U0010ffffz"), (18, "http://a..com/q"), (19, "http://example.com/" + "en/" * 50_000),
]


def plain_judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h) + len(p), len(h), h + p, v != "block", v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    best = max(f[:3] for f in fits)
    return host, path, best[2], min(f[3:] for f in fits if f[:3] == best)[1]


@pytest.mark.parametrize("width", [1, 100_000])
def test_url_rules_equal_the_plain_ones(spark, width):
    rnd = random.Random(3)
    hosts = ["com", "example.com", "www.example.com", "net", "x.net", "a.x.net", "org", ""]
    paths = ["", "/", "/en/", "/en/a", "/en/ab", "/e", "/es/", "/fr/x/y", "/\U0010ffff"]
    rules = [(rnd.choice(hosts), rnd.choice(paths), rnd.choice(["allow", "block"])) for _ in range(60)]
    urls = CASES + [(k, f"http://{rnd.choice(['', 'm.', 'www.'])}{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', 'a', 'b/c', '?q'])}") for k in range(100, 400)]
    pages = spark.createDataFrame([(i, u, "html", "x", "y") for i, u in urls], "page_id long, url string, html string, host string, rule string")
    for some in (rules, [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")], []):
        got = Counter(map(tuple, url_rules.judge(pages, spark.createDataFrame(some, "host string, path string, verdict string"), width=width).collect()))
        assert got == Counter((i, *plain_judge(u, some)) for i, u in urls)


def test_url_rules_plan_is_native_and_reads_two_columns(spark, tmp_path):
    spark.createDataFrame(CASES, "page_id long, url string").selectExpr("*", "'x' AS html").write.parquet(f"{tmp_path}/p")
    out = url_rules.judge(spark.read.parquet(f"{tmp_path}/p"), spark.sql("SELECT 'com' AS host, '/' AS path, 'block' AS verdict"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ReadSchema: struct<page_id:bigint,url:string>" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_url_rules_bear_empty_and_half_null_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([(None, "/", "block"), ("com", None, "block"), ("net", "/", None), ("COM", None, "allow")], "host string, path string, verdict string")
    assert url_rules.judge(empty, rules).collect() == []
    pages = spark.createDataFrame([(1, "http://a.com"), (2, "http://a.net/")], "page_id long, url string")
    assert sorted(map(tuple, url_rules.judge(pages, rules).collect())) == [(1, "a.com", "", "com", "block"), (2, "a.net", "/", None, "allow")]


# ---- resampling


def plain_resample(docs, target, longest, buckets, percent, least):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    def counts(t):
        w = words(t)
        return Counter(zlib.crc32(" ".join(w[k : k + n]).encode()) % buckets for n in range(1, longest + 1) for k in range(len(w) - n + 1))

    s, t = Counter(), Counter()
    for _, x in docs:
        s += counts(x)
    for x in target:
        t += counts(x)
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)}
    out = []
    for i, x in docs:
        c = counts(x)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(n * gain[b] for b, n in c.items())
        out.append([i, len(words(x)), c.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    some = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(some[: percent * len(some) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("longest, buckets, percent, least", [(1, 10_000, 10, 20), (2, 50, 50, 1), (3, 7, 100, 0)])
def test_resampling_equals_the_plain_one(spark, longest, buckets, percent, least):
    rnd = random.Random(8)
    text = lambda n: " ".join(rnd.choice(["Straße", "the", "Ökonomie", "x1", "a-b", "日本", "END", "q", "r"]) for _ in range(n))
    docs = [(k, text(rnd.randint(0, 60))) for k in range(150)] + [(200, None), (201, ""), (None, text(30)), (None, None), (202, "word " * 100_000), (203, "x" * 400_000), (7, "twice " * 25), (7, "twice " * 25)]
    target = [text(9), "straße the the", None, ""]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, id long, score long, rank long").repartition(5)
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    found = resampling.resample(df, goal, percent, least, features=resampling.Features(longest, buckets))
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_resample(docs, target, longest, buckets, percent, least)


def test_resampling_bears_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    assert resampling.resample(none, some).collect() == []
    assert {r["rank"] for r in resampling.resample(some, none, 100, 0).collect()} == {1, 2}


def test_csr_blocks_hold_the_counts(spark):
    f = resampling.Features(1, 100)
    docs = spark.createDataFrame([(1, "b a b"), (2, None), (3, "a")], "doc_id long, text string").coalesce(1)
    (block,) = resampling.matrix(docs, f).collect()
    a, b = zlib.crc32(b"a") % 100, zlib.crc32(b"b") % 100
    first = sorted([(a, 1), (b, 2)])
    assert (block["ids"], block["n_words"], block["indptr"]) == ([1, 2, 3], [3, 0, 1], [0, 2, 2, 3])
    assert list(zip(block["buckets"], block["counts"])) == [*first, (a, 1)]
    assert resampling.column_sums(resampling.matrix(docs, f), f)[[a, b]].tolist() == [2, 2]


def test_ranks_go_on_over_ranges(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "id % 3 AS score").repartition(7)
    got = resampling.ranked(Workspace(spark, "t"), rows, [rows["score"].desc(), rows["doc_id"].asc()], "rank").collect()
    want = sorted((-r["score"], r["doc_id"]) for r in got)
    assert [(-r["score"], r["doc_id"]) for r in sorted(got, key=lambda r: r["rank"])] == want and {r["rank"] for r in got} == set(range(1, 5001))


def test_blocks_are_small_however_many_texts_a_file_has(spark):
    f = resampling.Features()
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 300), k -> concat('w', (k * 7919 + id) % 20011))) AS text").coalesce(1)
    blocks = resampling.matrix(docs, f)
    r = blocks.selectExpr("count(*) AS n", "max(size(buckets)) AS cells", "sum(size(ids)) AS docs").first()
    assert r["docs"] == 4000 and r["n"] > 700 and r["cells"] < 3000
    gain = np.arange(10_000) - 5000
    got = {x["doc_id"]: x["weight"] for x in resampling.weights(blocks, gain).collect()}
    assert len(got) == 4000 and all(got[i] == sum(int(gain[zlib.crc32(b"w%d" % ((k * 7919 + i) % 20011)) % 10_000]) for k in range(1, 301)) for i in (0, 1, 77, 3999))
