"""The registered queries themselves, and the pipeline, on small tables with planted cases."""

import random
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_documents import plain_fingerprint, plain_mix, plain_quality

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline
from tidemark.llm import mixing, quality, queries, simhash, tokens, toxicity

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long, copies string, fp string, t string, __times long",
    "labels": "doc_id long, quality int, toxic int",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
    "benchmark": "item_id long, text string",
}


def documents():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [[k, prose(rnd.randint(25, 120))] for k in range(120)]
    for k in range(0, 120, 4):  # toxic ones
        words = rows[k][1].split()
        rows[k][1] = " ".join([*words[:9], "you", "zorp", *words[9:]])
    copied = prose(60)
    rows += [[200 + k, copied] for k in range(30)] + [[240 + k, copied + " " + copied.split()[k]] for k in range(4)]
    rows += [[300, prose(40)], [300, prose(40)], [None, prose(40)], [None, prose(45)], [301, rows[1][1]], [None, rows[2][1]], [5, rows[7][1]]]
    rows += [[400, None], [401, ""], [402, "too short"], [403, "the same line again and again here\n" * 9], [404, prose(25_000)], [1, rows[1][1]]]
    return [(k, t, "en", [None, "a", "b", "b"][n % 4], len(t or ""), "mine", "x", "y", 3) for n, (k, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(60, 16))
    vectors = [*base, *(base[:20] + rnd.normal(size=(20, 16)) * 0.1), *([base[3]] * 6), *(base[7] + rnd.normal(size=(25, 16)) * 0.03)]
    vectors = [(k, v.astype("f4").tolist(), 0) for k, v in enumerate(vectors)] + [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, (2 * base[3].astype("f4")).tolist(), 1)]
    page = "<html>" + "x é" * 60 + "</html>"
    pages = [(k, f"http://h/{k}", page if k % 3 else f"<p>{k}</p>" + page) for k in range(30)] + [(50, None, None), (51, "http://h/e", ""), (52, "http://h/s", "short"), (53, "http://h/s", "short"), (-4, "http://h/first", page)]
    chats = [(k, n, ["user", "assistant", None][n % 3], [f"turn {n} </s> [INST] é", "ok\\", None, ""][(k + n) % 4]) for k in range(12) for n in range(k % 5)]
    rows = {
        "documents": documents(),
        "labels": [(k, 1, int(k % 4 == 0)) for k in range(120)] + [(999, 1, 1), (None, 0, 1), (3, 1, None)],
        "embeddings": vectors,
        "pages": pages,
        "conversations": chats,
        "benchmark": [(k, t) for k, (_, t, *_) in enumerate(documents()[:9])] + [(20, None), (None, ""), (21, "Straße x1")],
    }
    full, empty = tmp_path_factory.mktemp("full"), tmp_path_factory.mktemp("empty")
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows[name], schema).repartition(3).write.parquet(f"{full}/{name}.parquet")
        spark.createDataFrame([], schema).write.parquet(f"{empty}/{name}.parquet")
    return str(full), str(empty)


def _plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql_on_planted_cases(spark, tables, name):
    duck = duckdb.connect()
    for t in SCHEMAS:
        duck.execute(f"create view {t} as select * from '{tables[0]}/{t}.parquet/*.parquet'")
    df = queries.QUERIES[name](spark, tables[0])
    cols = sorted(df.columns)
    got = sorted((tuple(map(_plain, r)) for r in df.select(*cols).collect()), key=repr)
    found = duck.execute(queries.ORACLES[name])
    names = [x[0] for x in found.description]
    want = sorted((tuple(_plain(r[names.index(c)]) for c in cols) for r in found.fetchall()), key=repr)
    assert got == want
    if name == "op5_vectors":
        assert sum(r["n_links"] for r in df.collect()) > 600
    if name == "op6_warc":
        assert Counter(r["record_type"] for r in df.collect())["revisit"] == 20


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_bear_empty_tables(spark, tables, name):
    got = queries.QUERIES[name](spark, tables[1]).collect()
    assert [r["conv_id"] for r in got] == [-7] if name == "op3_chat_format" else got == []


def test_simhash_query_equals_brute_force(spark, tables):
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{tables[0]}/documents.parquet").collect()]
    fps = [plain_fingerprint(t) for _, t in docs]
    label = list(range(len(docs)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                label[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            low[root(k)] = min(low.get(root(k), i), i)
    want = sorted(((i, f"{fps[k]:016x}", low.get(root(k))) for k, (i, _) in enumerate(docs)), key=repr)
    assert sorted(map(tuple, queries.op10_simhash(spark, tables[0]).collect()), key=repr) == want


def test_mixing_query_equals_the_plain_one(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    m = mixing.mix(docs, mixing.words("text"), F.array("source"))
    rows = [tuple(r) for r in docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))), mixing.words("text"), "source", F.xxhash64(F.lit(7), F.coalesce("doc_id", F.lit(-(1 << 63))))).collect()]
    copies = plain_mix(rows, m)
    sizes = Counter()
    for _, n, s, _ in rows:
        sizes[s] += n
    goal = mixing.targets(sizes, sum(sizes.values()))
    by = dict(docs.select("doc_id", "source").distinct().groupBy("doc_id").count().where("count = 1").select("doc_id", "count").collect())
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    got = queries.op7_mixing(spark, tables[0]).collect()
    assert len(got) == docs.count() and sum(r["taken"] for r in got) > 0
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        if r["doc_id"] is not None and r["doc_id"] in by:
            s = source[r["doc_id"]]
            assert (r["taken"], r["source_size"], r["target"]) == (r["size"] * copies[r["doc_id"], r["size"], s], sizes[s], pytest.approx(goal[s]))


def test_packing_query_places_every_piece(spark, tables):
    import zlib

    encode = tokens.encoder(tokens.vocabulary())
    want = Counter()
    for r in spark.read.parquet(f"{tables[0]}/documents.parquet").collect():
        ids = encode(r["text"] or "") + bytes(4)
        n, at, k = len(ids) // 4, 0, 0
        while at < n:
            size = n if n <= 2048 else (n % 2048 or 2048) if not k else 2048
            want[r["doc_id"], k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])] += 1
            at, k = at + size, k + 1
    got = queries.op9_packing(spark, tables[0]).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 2048) + 2


def test_pipeline_equals_the_plain_one(spark, tables, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{tables[0]}/documents.parquet").collect()]
    key = lambda rows: sorted(rows, key=repr)
    stages = dict(corpus_pipeline.STAGES)
    frame = spark.createDataFrame(docs, SCHEMAS["documents"])

    rules, kept = quality.Rules(), []
    for r in docs:
        f = plain_quality(r[1] or "", (4, 8, 16))
        n, chars = f["n_words"], f["word_chars"]
        bad = n < 20 or 100 * f["words_8"] > 30 * n or f["line_chars"] > rules.line_share * chars or f["n_symbols"] > rules.symbols_per_word * n
        if not bad and all(f[f"chars_{k}"] <= share * chars for k, share in rules.ngrams):
            kept.append(r)
    out = stages["quality rules"](spark, frame, tables[0])
    assert out.columns == frame.columns and key(map(tuple, out.collect())) == key(kept) and 0 < len(kept) < len(docs)

    frame = spark.createDataFrame(kept, SCHEMAS["documents"])
    model = toxicity.fit(frame, spark.read.parquet(f"{tables[0]}/labels.parquet"))
    fine = [r for r in kept if model.score(model.features(r[1])[None])[0] < 0.5]
    out = stages["toxicity"](spark, frame, tables[0])
    assert key(map(tuple, out.collect())) == key(fine)
    assert {r[0] for r in kept} - {r[0] for r in fine} == {k for k in range(0, 120, 4)}  # all toxic ones and no other

    frame = spark.createDataFrame(fine, SCHEMAS["documents"])
    fps = [plain_fingerprint(r[1]) for r in fine]
    label = list(range(len(fine)))
    for _ in fine:  # to the smallest place
        moved = False
        for a in range(len(fine)):
            for b in range(len(fine)):
                if label[b] < label[a] and bin(fps[a] ^ fps[b]).count("1") <= 2:
                    label[a], moved = label[b], True
        if not moved:
            break
    groups = {}
    for r, f, g in zip(fine, fps, label):
        groups.setdefault(g, []).append((r[0] is None, r[0] or 0, simhash.signed(f), r))
    out = [tuple(r) for r in stages["simhash near-dedup"](spark, frame, tables[0]).collect()]
    first = {g: min(x[:2] for x in rows) for g, rows in groups.items()}
    assert len(out) == len(groups) and len(groups) < len(fine)
    texts = {r[1]: g for r, g in zip(fine, label)}
    assert sorted(first[texts[r[1]]] for r in out) == sorted(first.values()) and {texts[r[1]] for r in out} == set(groups)
    assert sum(r[0] is None for r in out) == 2 and sum(r[0] == 300 for r in out) == 2  # texts without an id of their own are not lost

    frame = spark.createDataFrame(out, SCHEMAS["documents"])
    mixed = [tuple(r) for r in stages["mixing to target weights"](spark, frame, tables[0]).collect()]
    m = mixing.mix(frame, mixing.words("text"), F.array("source"))
    hashed = frame.select(F.coalesce("doc_id", F.lit(-(1 << 63))), mixing.words("text"), "source", F.xxhash64(F.lit(7), F.coalesce("doc_id", F.lit(-(1 << 63)))))
    copies = plain_mix([tuple(r) for r in hashed.collect()], m)
    want = [r for r in out for _ in range(copies[-(1 << 63) if r[0] is None else r[0], len(r[1].split()), r[3]])]
    assert key(mixed) == key(want)

    frame = spark.createDataFrame(mixed, SCHEMAS["documents"])
    last = stages["best-fit packing"](spark, frame, tables[0])
    assert last.where("piece = 0").count() == len(mixed)
    whole = corpus_pipeline.run(spark, tables[0])
    assert whole.columns == last.columns and key(tuple(r)[:5] for r in whole.collect()) == key(tuple(r)[:5] for r in last.collect())
    assert corpus_pipeline.run(spark, tables[1]).count() == 0
