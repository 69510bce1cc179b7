"""Quality rules, SimHash, toxicity, mixing and licences against plain versions and on odd tables."""

import os
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import licences, mixing, quality, queries, simhash, toxicity
from tidemark.llm.common import Workspace, components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, *texts, sources=None):
    return spark.createDataFrame([(k, t, "en", (sources or ["s"] * len(texts))[k], 0) for k, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, white space, ties, repeated rows, a null id, a very long text, clashing extra columns."""
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one two three four", "a"), (4, "one two three four", "a"), (None, "one two three four", "b"), (5, "wörter " * 60_000, "b"), (6, "x" * 500_000, "b")]
    return spark.createDataFrame([(k, t, "en", s, 1, "c", 9, "t") for k, t, s in rows], SCHEMA + ", component_id string, fp long, t string")


# ---- quality


def plain_quality(text, lengths):
    w = WORDS.findall(text)
    seen, dup, chars = set(), 0, 0
    for line in text.split("\n"):
        if WORDS.search(line):
            if line in seen:
                dup += 1
                chars += sum(map(len, WORDS.findall(line)))
            seen.add(line)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup, "line_chars": chars}
    for n in lengths:
        grams = Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
        inside = {p for k in range(len(w) - n + 1) if grams[tuple(w[k : k + n])] > 1 for p in range(k, k + n)}
        out |= {f"words_{n}": len(inside), f"chars_{n}": sum(len(w[p]) for p in inside)}
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(["a", "b", "é", " ", "\n", "\t", "#", "|", "\x0b", " ", "日"]), max_size=60), max_size=6))
def test_quality_counts(texts):
    if not texts:
        return
    got = quality.measure([t.encode() for t in texts], (2, 3, 8))
    for k, t in enumerate(texts):
        assert {n: int(v[k]) for n, v in got.items()} == plain_quality(t, (2, 3, 8))


def test_quality_tells_equal_hashes_apart(monkeypatch):
    bits = [0]
    for _ in range(10):
        bits += [1 - b for b in bits]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))  # equal under any polynomial modulo 2^64
    assert quality.measure([f"{one}\n{two}\n{one}".encode()], (2,))["n_dup_lines"].tolist() == [1]
    text = " ".join(one) + " | " + " ".join(two)
    assert quality.measure([text.encode()], (1024,))["words_1024"].tolist() == [0]
    spans = quality._spans
    monkeypatch.setattr(quality, "_spans", lambda *a: spans(*a) & np.uint64(3))  # nearly all hashes collide
    texts = ["a b a b\nb a\na b a b\nc c c", "c c c c\nd\nd\n\n", "", "x y z " * 9]
    got = quality.measure([t.encode() for t in texts], (2, 3, 8))
    for k, t in enumerate(texts):
        assert {n: int(v[k]) for n, v in got.items()} == plain_quality(t, (2, 3, 8))


def test_quality_verdicts(spark, odd):
    good = " ".join(f"word{k}" for k in range(60))
    texts = [good, "a b c", "the same eight words come again and again here " * 5, good + "\n" + " ".join(f"|{k}" for k in range(30)), "\n".join([good[:60]] * 6) + good, good + " odd " + good[:40]]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.score(docs(spark, *texts)).collect()}
    assert got == {0: (False, True), 1: (True, False), 2: (True, False), 3: (False, False), 4: (True, False), 5: (False, True)}
    assert {r["doc_id"] for r in quality.accepted(docs(spark, *texts)).collect()} == {k for k, (_, kept) in got.items() if kept}
    r = quality.score(odd).collect()
    assert len(r) == 8 and all(x["base_failed"] for x in r) and {x["n_words"] for x in r if x["doc_id"] in (1, 2, 3)} == {0}
    assert quality.score(odd.limit(0)).count() == 0 and quality.accepted(odd.limit(0)).columns == odd.columns


# ---- SimHash


def plain_fingerprint(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORDS.findall(text)]
    if not w:
        return 0
    grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from(["a", "B", "É", "ß", " ", "\n", " ", "c", "d"]), max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_masks_cover_all_close_pairs():
    m = simhash.masks(2)
    for a, b in combinations(range(64), 2):
        assert any(not (((1 << a) | (1 << b)) & k) for k in m)
    assert all(bin(k).count("1") == 32 for k in m) and len(m) == 6


@pytest.mark.parametrize("hot", [2, 48])
def test_links_connect_what_hamming_connects(spark, hot):
    import random

    rnd = random.Random(hot)
    fps = {rnd.getrandbits(64) for _ in range(60)} | {0}
    for f in list(fps)[:12]:
        for _ in range(12):
            f ^= 1 << rnd.randrange(64)
            fps.add(f ^ (1 << rnd.randrange(64)))
            fps.add(f)
    fps = sorted(simhash.signed(f) for f in fps)
    ws = Workspace(spark, "t")
    df = ws.save(spark.createDataFrame([(f,) for f in fps], "fp long"), "fps")
    edges = simhash.links(ws, df, hot=hot)
    assert all(bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") <= 2 for r in edges.collect())
    got = {r["node"]: r["root"] for r in components(ws, edges).collect()}
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(fps, 2):
        if bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert {f: got.get(f, f) for f in fps} == {f: find(f) for f in fps}


def test_components_of_a_long_path_and_a_star(spark):
    ws = Workspace(spark, "t")
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(ws, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}
    assert components(ws, spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark, odd):
    base = " ".join(f"w{k}" for k in range(400))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs(spark, base, "other text here", base.upper(), base + " more", None, "")).collect()}
    assert got[2] == 0 and got[1] == 1 and got[5] == got[4] == 4
    r = simhash.near_duplicates(odd).collect()
    assert len(r) == 8 and {x["component_id"] for x in r if x["doc_id"] in (1, 2, 3)} == {1} and {x["component_id"] for x in r if x["doc_id"] in (4, None)} == {4}
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and sorted(x["doc_id"] for x in kept.collect()) == [1, 4, 5, 6]


def test_repeated_ids_keep_their_texts(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(200)) for x in "abc")
    rows = [(5, a), (5, b), (3, a), (9, c), (9, c.upper()), (None, "one of no id"), (None, "two without any id at all"), (7, b)]
    for turn in (rows, rows[::-1]):
        kept = simhash.keep_first(spark.createDataFrame(turn, "doc_id long, text string").coalesce(1)).collect()
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"].lower()) for r in kept) == [(-1, "one of no id"), (-1, "two without any id at all"), (3, a), (5, b), (9, c)]
    many = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["text"] for r in simhash.keep_first(many).collect()} == {r["text"] for r in simhash.keep_first(many.repartition(5)).collect()}


# ---- toxicity


def test_grammar_marks_clauses():
    run = lambda s: "".join(toxicity.paths(list(s)))
    assert run("yoooi") == "yoooj" and run("iooq") == "iooq" and run("yoooooi") == "yoooooi" and run("ioy") == "joy"
    assert run("qppi") == "qppj" and run("qoi") == "qoi" and run("iq") == "jq" and run("opoioooo") == "opoioooo" and run("pi") == "pd"  # an article alone is nobody
    assert run("oooiooo") == "oooiooo" and run("i") == "d" and run("ii") == "hh" and run("oi") == "oi" and run("io") == "io"
    assert run("oooioooiooo")[7] == "h" and run("ni") == "nk" and run("noooyi") == "noooyj" and run("ryoooi") == "ryoool" and run("rni") == "rnl"
    assert run("woovy")[-1] == "x" and run("vy") == "vy" and run("nv") == "no" and run("wooooovy") == "wooooovy"


def test_lexicon_reads_words_by_weighted_arcs():
    x = toxicity.Lexicon({"idiot": 3.0, "achli*": 2.0, "achlich*": 1.0, "achlichs": 4.0})
    assert x.read("idiot") == ("i", 3.0) and x.read("idiots") == ("o", 0.0) and x.read("idio") == ("o", 0.0)
    assert x.read("achli") == ("o", 0.0) and x.read("achlix") == ("i", 2.0) and x.read("achlichx") == ("i", 1.0) and x.read("achlichs") == ("i", 4.0)
    assert x.read("you") == ("y", 0.0) and x.read("nicht")[0] == "n" and x.read("")[0] == "o"


def test_model_scores_clauses_and_no_isolated_words():
    m = toxicity.Model({"idiot": 3.0, "clown": 3.0, "achli*": 2.0})
    kinds = lambda t: {k: round(float(np.expm1(v)), 6) for k, v in zip(toxicity.KINDS, m.features(t)) if v}
    assert kinds("You are an idiot. He said: IDIOT! I will kill you") == {"targeted": 3.0, "threat": 1.0}
    assert kinds("not an idiot") == {"negated": 3.0} and kinds("someone called him idiot") == {"reported": 3.0} and not kinds("that house achlichber stands")
    assert kinds("Idiot! some words. Clown") == {"addressed": 6.0} and not kinds("") and not kinds("you he the a")
    assert kinds("You clown. You idiot. You idiot.") == {"targeted": 6.0} and kinds("you clown, you idiot") == {"targeted": 3.0}  # a form that leads several clauses counts once
    assert kinds("she is an idiot") == {"targeted": 3.0} and not kinds("she sold idiot lamps") and kinds("big idiot lamps near a clown bridge") == {"heaped": 3.0}
    assert not kinds("water flows past old idiot houses near big rivers. " * 50)  # no path takes it
    assert kinds("grey idiot stones. blue clown stones") == {"spread": 3.0} and not kinds("idiot lamps and more idiot lamps")
    s = lambda t: m.score(m.features(t)[None])[0]
    assert s("You idiot.") > s("He said something about some idiot.") > s("nothing") == s("grey stones under idiot bridges carry trains") == s("The idiot went there.")


CARRIERS = (
    "the paper is about the word {} in history and the law", "{} market opened in spring before many people came together", "a report on {} was printed in the north last year",
    "in the museum of the city there is {} from old times", "prices of {} rose by two percent in winter", "the {} was collected on monday morning by the town",
    "many books describe {} and its place in daily life", "trains carry {} over the bridge to the harbour",
)


def test_copies_of_a_text_teach_once(spark):
    import random

    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(2000)}"
    toxic = [" ".join([word() for _ in range(20)] + ["zorp"] + [word() for _ in range(20)]) for _ in range(60)]
    copied = " ".join(["rare", *(word() for _ in range(20)), "zorp", "seldom", word()])
    texts = toxic + [copied] * 200 + [" ".join(word() for _ in range(40)) for _ in range(500)]
    m = toxicity.fit(docs(spark, *texts), spark.createDataFrame([(k, int(k < 260)) for k in range(760)], "doc_id long, toxic int"))
    assert "zorp" in m.terminals and not {"rare", "seldom"} & set(m.terminals)


def test_fit_learns_terms_and_leaves_held_out_alone(spark, odd):
    import random
    import zlib

    rnd = random.Random(1)
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = [f"w{rnd.randrange(300)}" for _ in range(40)] + (["zorp", "blat"] if toxic else [])
        rnd.shuffle(words)
        words.insert(20, "the")
        rows.append(" ".join(words))
        held = zlib.crc32(str(k).encode()) % 5 == 0
        labels.append((k, int(toxic != held)))  # held-out labels are wrong: learning from them would show
    d = docs(spark, *rows)
    m = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {"zorp", "blat"} <= set(m.terminals)
    got = {r["doc_id"]: r for r in toxicity.score(d, m).withColumn("h", toxicity.held_out()).collect()}
    assert all(got[k]["predicted"] == (k % 4 == 0) for k in range(400))  # of forty words without a point, an insult is found by who stands beside it
    assert all(got[k]["h"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k in range(400))
    assert {r["doc_id"] for r in toxicity.clean(d, m).collect()} == {k for k in range(400) if k % 4}
    r = toxicity.score(odd, m).collect()
    assert len(r) == 8 and all(0 <= x["score"] <= 1 for x in r)
    assert toxicity.fit(d, spark.createDataFrame([], "doc_id long, toxic int")) == toxicity.Model()
    assert toxicity.score(odd.limit(0), m).count() == 0


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_toxicity_query_on_held_out_rows(spark):
    """The query itself: labels of held-out rows are read by this test alone."""
    got = queries.op1_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), "doc_id", "left").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and all(r["predicted"] == (r["score"] >= 0.5) for r in got)
    clean = [r for r in got if r["held_out"] and r["toxic"] == 0]
    assert clean and not any(r["predicted"] for r in clean)
    toxic = [r for r in got if r["toxic"] == 1]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    share = Counter(max(toxicity.KINDS, key=lambda k: r[k]) for r in got if r["predicted"])
    assert not any(r["predicted"] and not any(r[k] for k in toxicity.KINDS) for r in got)  # every positive has a path
    print("positives by heaviest path", dict(share), "held out, found", sum(r["predicted"] for r in toxic if r["held_out"]), "of", sum(r["held_out"] for r in toxic))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_learned_words_in_neutral_sentences_score_low(spark):
    m = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    words = [t.removesuffix("*") for t in m.terminals]
    texts = [c.format(w) for c in CARRIERS for w in words]
    score = lambda ts: m.score(np.array([m.features(t) for t in ts]))
    assert words and (score(texts) >= 0.5).mean() < 0.05
    assert (score(["I will kill you", "we are going there and they will hurt him", "You will see. I must stab you now."]) > 0.5).all()
    assert (score([f"you {w}" for w in words if m.terminals.get(w, 0) > 3]) > 0.5).mean() > 0.9


# ---- mixing


def test_targets_stop_at_three_times_the_source():
    t = mixing.targets({"a": 10, "b": 100, "c": 100, None: 90}, 300)
    assert t["a"] == 30 and abs(sum(t.values()) - 300) < 1e-9
    rest = 270 / (2 + 1 + 5)
    assert [t["b"], t["c"], t[None]] == pytest.approx([2 * rest, rest, 5 * rest])
    assert mixing.targets({}, 0) == {} and mixing.targets({"a": 0}, 0) == {"a": 0}


def test_flow_is_cheapest():
    capacity = {("a",): 10, ("a", "b"): 10, ("b",): 10}
    flow = mixing.route(capacity, {"a": 20, "b": 15})
    by = Counter()
    for (p, s), n in flow.items():
        by[s] += n
    assert by == {"a": 20, "b": 15}
    loads = {p: sum(n for (q, _), n in flow.items() if q == p) for p in capacity}
    assert sorted(loads.values()) == [10, 10, 15]  # only what must be repeated is


def _taken(spark, d, **more):
    m = mixing.mix(d, mixing.words("text"), F.array("source"), **more)
    return m, m.attach(d, mixing.words("text"), F.array("source")).collect()


def test_mix_comes_near_its_targets(spark, odd):
    import random

    rnd = random.Random(2)
    texts = ["w " * rnd.randint(0, 400) for _ in range(900)]
    sources = [rnd.choice(["a", "a", "a", "b", "c", None]) for _ in texts]
    d = docs(spark, *texts, sources=sources)
    m, got = _taken(spark, d)
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["copies"] * (len(r["text"]) // 2)
        assert 0 <= r["copies"] <= 3
    for s, (size, target, routed) in m.report.items():
        assert abs(taken[s] - target) <= 0.001 * target + 3 and abs(routed - target) <= 1 and target <= 3 * size
    again = {r["doc_id"]: r["copies"] for r in _taken(spark, d.repartition(7))[1]}
    assert again == {r["doc_id"]: r["copies"] for r in got}
    assert len(_taken(spark, odd)[1]) == 8 and _taken(spark, odd.limit(0))[1] == []


def plain_mix(rows, m):
    """Copies by (id, size, source), row by row: ``rows`` has (id, size, source, hash of the id)."""
    out = {}
    for s, (size, _, routed) in m.report.items():
        held = Counter()
        for i, n, source, h in rows:
            if source == s:
                held[h % m.parts, h, i, n] += n
        base, rest = divmod(routed, size) if size else (0, 0)
        out |= {(i, n, s): base for _, _, i, n in held}
        if not rest:
            continue
        order = sorted(held)
        total, cut, gap = 0, m.parts, 0
        for p in sorted({k[0] for k in order}):
            words = sum(held[k] for k in order if k[0] == p)
            if total + words > rest:
                cut, gap = p, rest - total
                break
            total += words
        more = {k for k in order if k[0] < cut}
        run = 0
        for k in (k for k in order if k[0] == cut):
            run += held[k]
            if run <= gap:
                more.add(k)
        gap = rest - sum(held[k] for k in more)
        for _ in range(mixing.FILLS):
            free = [k for k in order if k not in more and k[0] >= cut and 0 < held[k] < 2 * gap]
            if gap <= 0 or not free:
                break
            best = min(free, key=lambda k: (abs(gap - held[k]), k[1], k[2], k[3]))
            more.add(best)
            gap -= held[best]
        for _, _, i, n in more:
            out[i, n, s] += 1
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_selection_equals_the_plain_one(spark, seed):
    import random

    rnd = random.Random(seed)
    data = [(rnd.randrange(700), "w " * rnd.choice([0, 1, 5, 30, 200, 2000]), rnd.choice(["a", "b", "b", "c", None])) for _ in range(800)]
    d = spark.createDataFrame(data + data[:40], "doc_id long, text string, source string")  # repeated ids and rows
    m, got = _taken(spark, d, weights=(5, 2, 1), seed=seed)
    hashed = d.select("doc_id", (mixing.words("text")), "source", F.xxhash64(F.lit(seed), "doc_id")).collect()
    want = plain_mix([tuple(r) for r in hashed], m)
    assert all(r["copies"] == want[r["doc_id"], len(r["text"]) // 2, r["source"]] for r in got) and len(got) == 840


def test_copies_may_be_a_column_already(spark):
    d = spark.createDataFrame([(k, "w " * 10, "a", "mine") for k in range(9)], "doc_id long, text string, source string, copies string")
    m = mixing.mix(d, mixing.words("text"), F.array("source"))
    got = m.attach(d, mixing.words("text"), F.array("source"), out_col="times")
    assert got.columns == [*d.columns, "times"] and {(r["copies"], r["times"]) for r in got.collect()} == {("mine", 1)}
    assert m.attach(d, mixing.words("text"), F.array("source")).columns == d.columns


def test_mix_of_overlapping_sources(spark):
    d = spark.createDataFrame([(k, "w " * 10, ["a"] if k % 3 == 0 else ["b", "a"] if k % 3 == 1 else ["b"]) for k in range(90)], "doc_id long, text string, m array<string>")
    m = mixing.mix(d, mixing.words("text"), F.col("m"), weights=(1,))
    got = m.attach(d, mixing.words("text"), F.col("m")).groupBy().agg(F.sum(F.col("copies") * 10).alias("n")).first()["n"]
    assert abs(got - 900) <= 30 and {s: t for s, (_, t, _) in m.report.items()} == {"a": 450, "b": 450}


def test_empty_membership_is_the_source_null(spark):
    d = spark.createDataFrame([(k, "w " * 10, [[], None, [None], ["a"]][k % 4]) for k in range(80)], "doc_id long, text string, m array<string>")
    m = mixing.mix(d, mixing.words("text"), F.col("m"), weights=(1,))
    got = Counter()
    for r in m.attach(d, mixing.words("text"), F.col("m")).collect():
        got[(r["m"] or [None])[0], r["m"] == []] += r["copies"] * 10
    assert m.report[None][0] == 600 and abs(got[None, True] + got[None, False] - m.report[None][2]) <= 10 and got[None, True] > 0


# ---- licences


def test_licences(spark, odd):
    texts = ["Some text.\nReleased under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Mit und ohne.", "Licensed under the Foo Bar License, version 7.", "Licensed under CC BY-NC 4.0.\n\nLicensed under the Apache License, Version 2.0."]
    got = {r["doc_id"]: r for r in licences.scan(docs(spark, *texts)).collect()}
    assert [got[k]["licence"] for k in range(4)] == ["MIT", "GPL-3.0", None, None] and got[3]["n_unknown"] == 1
    assert got[4]["families"] == ["Apache-2.0", "CC-BY-NC"] and got[4]["n_confirmed"] == 2 and got[0]["n_paragraphs"] == 2
    assert all(r["licence"] is None for r in licences.scan(odd).collect()) and licences.scan(odd.limit(0)).count() == 0


def test_licence_templates_are_recognised():
    m = licences.train()
    for family, texts in licences.TEMPLATES.items():
        for t in texts:
            found, p, confirmed = m.classify(t)
            assert (found, confirmed) == (family, True), t


def test_every_planted_kind_of_line_is_confirmed(spark):
    planted = {
        "All rights reserved.": "Proprietary",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    texts = [f"Some words before.\n{line}\nAnd some after." for line in planted] + ["All rights reserved.\nReleased under the MIT License.", "All the rights of others were reserved."]
    got = {r["doc_id"]: r for r in licences.scan(docs(spark, *texts)).collect()}
    assert [got[k]["licence"] for k in range(7)] == [*planted.values(), "MIT", None]
    assert all(got[k]["n_confirmed"] == 1 for k in range(5)) and got[5]["families"] == ["MIT", "Proprietary"]


def test_wrapped_notices_are_found(spark):
    import textwrap

    before, after = "Some words about a house\nand a page of text.", "More text comes here\nand then it ends."
    texts, want = [], []
    for family, templates in licences.TEMPLATES.items():
        for t in templates:
            for width, gap, mark in ((70, "\n\n", ""), (40, "\n", " * "), (25, "\n", "# ")):
                texts.append(before + gap + textwrap.fill(t, width, initial_indent=mark, subsequent_indent=mark) + gap + after)
                want.append(family)
    got = {r["doc_id"]: r for r in licences.scan(docs(spark, *texts)).collect()}
    for k, family in enumerate(want):
        assert (got[k]["licence"], got[k]["n_confirmed"]) == (family, 1), texts[k]
    mit = licences.TEMPLATES["MIT"][2]
    apart = [textwrap.fill(mit, 60).replace("\n", "\n" + "Another line of many other words. " * 9 + "\n"), "All rights\n\nreserved.", textwrap.fill(mit, 60) + "\n\nx\n" + textwrap.fill(mit, 50)]
    got = {r["doc_id"]: (r["licence"], r["n_confirmed"]) for r in licences.scan(docs(spark, *apart)).collect()}
    assert got == {0: (None, 0), 1: (None, 0), 2: ("MIT", 2)}


#: Wordings that no training row has, some of them without any licence.
UNSEEN = (
    ("You may use this library under the MIT licence, see LICENSE.", "MIT"), ("MIT-licensed software", "MIT"), ("Use is permitted by the Apache 2.0 license.", "Apache-2.0"),
    ("Our code is offered under Apache License 2.0", "Apache-2.0"), ("Foo is free software under the GNU GPL v3.", "GPL-3.0"), ("you can share it under the terms of the GNU General Public License version 3", "GPL-3.0"),
    ("made available to you under the GNU General Public License v2", "GPL-2.0"), ("covered by the GNU Lesser General Public License", "LGPL"), ("this server is AGPLv3 software", "AGPL-3.0"),
    ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "BSD"), ("subject to the Mozilla Public License 2.0", "MPL-2.0"), ("ISC licensed, have fun", "ISC"),
    ("Text is available under the Creative Commons Attribution-ShareAlike License", "CC-BY-SA"), ("All photos CC BY-NC 4.0 unless noted", "CC-BY-NC"), ("figures are shared with a Creative Commons Attribution 4.0 licence", "CC-BY"),
    ("To the public domain under CC0", "CC0"), ("available under the Boost Software License", "BSL-1.0"), ("under the Eclipse Public License", "EPL-2.0"),
    ("Drivers need a license to drive a car.", None), ("SPDX-License-Identifier: Foo-1.0", None), ("SPDX-License-Identifier: LicenseRef-Acme", None), ("Licensed under the Sample Code License, version 4.", None),
    ("The house was licensed to sell wine.", None), ("the terms of the agreement were read in public", None), ("He said the software is provided to all of them.", None), ("a licence fee applies to every general user", None),
)


def test_licences_by_wordings_never_seen():
    m = licences.train()
    right = [(f if f not in (licences.NONE, licences.UNKNOWN) else None) == want for t, want in UNSEEN for f, _, confirmed in [m.classify(t)] if not confirmed or want]
    assert sum(right) >= 0.85 * len(UNSEEN)
    assert not any(m.classify(t)[2] for t, want in UNSEEN if want is None)  # nothing false is confirmed
    assert m.classify("SPDX-License-Identifier: Frobnicate-2.0")[0] == licences.UNKNOWN and m.classify("SPDX-License-Identifier: ISC")[::2] == ("ISC", True)


def test_whole_texts_and_paragraphs(spark):
    import textwrap

    mit = "Copyright (c) 2020 Someone\n\n" + "\n\n".join(textwrap.fill(t, 72, initial_indent=" * ", subsequent_indent=" * ") for t in licences.TEMPLATES["MIT"][2:5])
    own = textwrap.fill("This archive and everything in it is offered to all readers under the GNU General Public License version 3 with no further terms.", 60, initial_indent="# ", subsequent_indent="# ")
    texts = [mit, own, "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: Apache-2.0", "A house stood there.\nAnd another one."]
    got = {r["doc_id"]: r for r in licences.scan(docs(spark, *texts)).collect()}
    assert (got[0]["licence"], got[0]["n_confirmed"], got[0]["n_unconfirmed"]) == ("MIT", 3, 0)
    assert (got[1]["licence"], got[1]["n_paragraphs"], got[1]["n_unconfirmed"]) == (None, 1, 1)  # no template words it, the classifier names it
    assert got[2]["families"] == ["Apache-2.0", "MIT"] and got[3]["n_paragraphs"] == 2
