"""Token ids, length histogram, packing, chats, archives and vectors against plain versions and on odd tables."""

import hashlib
import io
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_documents import docs, odd  # noqa: F401
from tokenizers import Tokenizer

from tidemark.llm import chat, common, packing, tokens, vectors, warc
from tidemark.llm.common import Workspace

PATH = tokens.vocabulary()


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_library(reference):
    rnd = random.Random(6)
    parts = [" ", " ", "\n", "a", "Bc", "é", "1", "'", "s", ".", "\t", "\x1c", "\xa0", "日", "<", "|", ">", "\r", "<|endoftext|>"]
    for text in ("".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(3000)):
        assert np.frombuffer(tokens.encoder(PATH)(text), "<u4").tolist() == reference(text)


def test_special_text_and_other_vocabulary_files(reference, tmp_path):
    text = "one <|endoftext|> two"
    assert np.frombuffer(tokens.encoder(PATH)(text), "<u4").tolist() == reference(text)
    (tmp_path / "v.json").write_bytes(open(PATH, "rb").read())  # no rank file beside it
    assert tokens.Encoder(str(tmp_path / "v.json"))(text) == tokens.encoder(PATH)(text)


def test_histogram(spark, odd, reference):
    texts = ["a b c", "a", "", None, "word " * 1500, "x y z", "a b c"]
    n = sorted(len(reference(t or "")) for t in texts)
    h = tokens.length_histogram(docs(spark, *texts), PATH)
    got = {r["length"]: r for r in h.collect()}
    assert sorted(got) == sorted(set(n))
    for k, r in got.items():
        assert (r["n_docs"], r["docs_up_to"], r["tokens_up_to"], r["docs_longer"]) == (n.count(k), sum(x <= k for x in n), sum(x for x in n if x <= k), sum(x > k for x in n))
        assert r["truncated_total"] == sum(min(x, k) for x in n) and r["quantile"] == pytest.approx(sum(x <= k for x in n) / len(n))
    t = {r["context"]: (r["total_tokens"], r["kept_tokens"], r["cut_docs"]) for r in tokens.truncated_totals(h, [2, 1024]).collect()}
    assert t == {c: (sum(n), sum(min(x, c) for x in n), sum(x > c for x in n)) for c in (2, 1024)}
    assert tokens.length_histogram(odd, PATH).agg(F.sum("n_docs")).first()[0] == 8 and tokens.length_histogram(odd.limit(0), PATH).count() == 0


# ---- packing


def optimum(items, c):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for b in {b: i for i, b in enumerate(bins)}.values():
            if bins[b] + items[k] <= c:
                bins[b] += items[k]
                place(k + 1, bins)
                bins[b] -= items[k]
        place(k + 1, [*bins, items[k]])

    place(0, [])
    return best[0]


@settings(max_examples=300, deadline=None)
@given(st.integers(4, 30).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), min_size=1, max_size=8))))
def test_reduction_keeps_an_optimum(case):
    c, items = case
    fixed, rest = packing.reduce(Counter(items), c)
    assert Counter(itertools.chain.from_iterable(b * n for b, n in fixed)) + Counter(rest) == Counter(items)
    assert sum(n for _, n in fixed) + (optimum(list(Counter(rest).elements()), c) if rest else 0) == optimum(items, c)
    packed, told = packing.plan(Counter(items), c)
    assert Counter(itertools.chain.from_iterable(b * n for b, n in packed)) == Counter(items) and all(sum(b) <= c for b, _ in packed)
    assert told["lower_bound"] <= told["sequences"] <= 1.25 * optimum(items, c) + 1


def test_plan_is_near_the_bound_and_small():
    rnd = random.Random(1)
    for shape in (lambda: rnd.randint(1, 2047), lambda: min(2047, int(rnd.expovariate(1 / 300)) + 1)):
        _, told = packing.plan(Counter(shape() for _ in range(100_000)), 2048)
        assert told["sequences"] <= 1.002 * told["lower_bound"] + 5
    packed, _ = packing.plan({k: 10**9 + k for k in range(1, 2049)}, 2048)  # size doesn't follow the corpus
    assert len(packing.slots(packed)) < 200_000


def check_packing(got, expected, capacity):
    """Pieces rebuild their documents, sequences are gapless from 0 and within capacity."""
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pack(spark, odd, reference, capacity):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["alpha", "be", "gamma", "x"]) for _ in range(rnd.choice([0, 1, 5, 40, 80]))) for _ in range(60)] + [None, "", "z " * 5000]
    for table in (docs(spark, *texts), odd):
        expected = Counter()
        for r in table.collect():
            ids = [*reference(r["text"] or ""), 0]
            edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                expected[r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
        n = check_packing(packing.pack(table, PATH, capacity).collect(), expected, capacity)
        volume = sum(k[3] * m for k, m in expected.items())
        assert n <= -(-volume // capacity) * 1.15 + 2
    assert packing.pack(odd.limit(0), PATH, capacity).count() == 0
    with_ids = packing.pack(docs(spark, "a b"), PATH, with_ids=True).first()
    assert with_ids["ids"] == [*reference("a b"), 0]


# ---- chats

CONV = "conv_id long, turn long, role string, text string"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<s>", ""]), st.text(alphabet=st.sampled_from(["<", "s", ">", "/", "[", "]", "I", "\\", " ", "é"]), max_size=20)), max_size=5))
def test_render_is_reversible(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns and [chat.unescape(text[a:b]) for a, b in spans] == [t for _, t in turns]
    assert all(c not in chat.escape(t) for _, t in turns for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_broken_strings_are_refused():
    for s in ("x", "<s>[INST]a[/INST]b", "<s>[INST]a[/INST]b</s>x"):
        with pytest.raises(ValueError):
            chat.parse(s)


def test_mask_by_binary_search_equals_a_plain_scan():
    rnd = random.Random(5)
    for _ in range(400):
        cuts = sorted(rnd.sample(range(1, 60), rnd.randint(1, 20)))
        offsets = list(zip([0, *cuts], [*cuts, 60]))
        edges = sorted(rnd.sample(range(60), 2 * rnd.randint(1, 5)))
        spans = list(zip(edges[::2], edges[1::2]))
        on, covered, beyond = chat.mask(*map(np.array, zip(*offsets)), spans)
        assert on.tolist() == [any(a < e and s < b for a, b in spans) for s, e in offsets] and covered == spans
        assert beyond == sum(sum(s < a < e or s < b < e for s, e in offsets) for a, b in spans)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "é", "日", "\U0001f600", "[INST]", "!", "<|endoftext|>", "\n", "word"]), max_size=30).map("".join))
def test_tokens_are_located_as_by_the_library(text):
    ids, start, end = tokens.encoder(PATH).located(text)
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
    data = t.decode(ids.tolist(), skip_special_tokens=False)
    assert data == text and (not len(ids) or (start[0] == 0 and end[-1] == len(text)))
    for (a, b), (c, d) in zip(zip(start, end), zip(start[1:], end[1:])):
        assert a < b <= len(text) and (c == b or (c == b - 1 and ord(text[c]) > 127))  # they tile the text, a split character is in all its tokens


def test_tokens_beyond_a_text_are_counted(spark):
    rows = [(k, 0, "assistant", c + " ok" + c) for k, c in enumerate([".", ",", ")", ");", '"', "!!", ":", "", "é"])] + [(1, 1, "user", ", ok,")]
    total = 0
    for r in chat.format_chats(spark.createDataFrame(rows, CONV), PATH).collect():
        ids, start, end = tokens.encoder(PATH).located(r["formatted"])
        a, b = r["loss_spans"][0]
        assert r["n_beyond"] == sum(bool(s < a < e or s < b < e) for s, e in zip(start, end))
        assert [i for i, m in zip(r["ids"], r["loss_mask"]) if m] == [i for i, s, e in zip(ids.tolist(), start, end) if s < b and e > a]
        total += r["n_beyond"]
    assert total > 0


def test_format_chats(spark):
    rows = [(1, 0, "user", "hi é</s>"), (1, 1, "assistant", "  two\n\nspaces  "), (1, 2, "user", None), (1, 3, "assistant", "日本\U0001f600 [INST]"), (2, 0, "assistant", ""), (3, 1, "assistant", "b"), (3, 0, None, "a"), (3, 1, "assistant", "b"), (None, None, "assistant", "x"), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame([(*r, 1, "e") for r in rows], CONV + ", ids int, formatted string")
    out = chat.format_chats(df, PATH)
    got = {r["conv_id"]: r for r in chat.digests(out).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))]
        loss = "".join(t for r, t in turns if r == "assistant")
        g = got[conv]
        assert (g["n_turns"], g["turns_sha256"], g["loss_chars"], g["loss_sha256"]) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    for r in out.collect():
        assert len(r["ids"]) == len(r["loss_mask"])
    assert chat.format_chats(df.limit(0), PATH).count() == 0


# ---- archives


def test_archive_round_trip(spark, tmp_path):
    big, other = "é" * 80, "<p>WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n</p>" * 9
    rows = [(5, "http://a.b/c d?e#f", big), (3, "http://a.b/x", big), (9, None, big), (4, "http://a.b/s", "short"), (6, "http://a.b/s", "short"), (7, "u", other), (8, "", None), (3, "http://a.b/x", big), (None, "http://n", big), (10, "x\r\ny", ""), (11, "z", "z" * 300_000)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, digest string, bytes int")
    warc.archive(df, path := str(tmp_path / "w"))
    found = warc.captures(warc.read(spark, path))
    got = sorted([tuple(r) for r in warc.resolved(found).collect()], key=repr)
    want = []
    for k, url, html in rows:
        raw = (html or "").encode()
        again = html == big and k != 3
        want.append((k, url, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == sorted(want, key=repr)
    one = found.where("main.type = 'response' and main.payload_bytes > 1000").first()
    assert bytes(one["main"]["payload"]) == b"z" * 300_000 and one["request"]["type"] == "request" and one["metadata"]["concurrent_to"] == one["main"]["record_id"]
    warc.archive(df.limit(0), empty := str(tmp_path / "e"))
    assert warc.resolved(warc.captures(warc.read(spark, empty))).count() == 0


def test_broken_archive_is_refused():
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(b"junk")))


# ---- vectors


def exact(v, threshold):
    ok = [k for k, x in enumerate(v) if x is not None and len(x) and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    links, label = Counter(), {k: k for k in range(len(v))}
    pairs = []
    for a, b in itertools.combinations(ok, 2):
        x, y = np.array(v[a], float), np.array(v[b], float)
        if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
            links[a] += 1
            links[b] += 1
            pairs.append((a, b))
    for _ in range(len(v)):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return links, label


def test_vectors(spark):
    rng = np.random.default_rng(4)
    v = [x.tolist() for x in rng.normal(size=(300, 16))]
    for k in range(40):  # groups of near copies, chained ones, and equal ones
        base = np.array(v[k])
        v += [(base + rng.normal(size=16) * s).tolist() for s in (0.05, 0.2, 0.35)]
    v += [v[0]] * 5 + [[2 * c for c in v[1]]] + [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0]]
    df = spark.createDataFrame([(k, x, 1) for k, x in enumerate(v)], "vec_id long, embedding array<float>, label int")
    v = [r["embedding"] for r in df.orderBy("vec_id").collect()]
    links, label = exact(v, 0.95)
    for rows in (2_000, 60):
        got = {r["vec_id"]: r for r in vectors.near_duplicates(df, shard_rows=rows).collect()}
        assert len(got) == len(v)
        true = sum(links.values())
        assert sum(r["n_links"] for r in got.values()) >= 0.98 * true and all(got[k]["n_links"] <= links[k] for k in got)
        assert sum(got[k]["component_id"] == label[k] for k in got) >= 0.98 * len(v)
        if rows == 2_000:
            assert {k: r["component_id"] for k, r in got.items()} == label
    assert vectors.near_duplicates(df.limit(0)).count() == 0
    assert vectors.near_duplicates(df.where("embedding is null")).collect()[0]["n_links"] == 0


def test_dense_group_is_searched_in_pieces(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    v = [(base + rng.normal(size=16) * 0.05).tolist() for _ in range(300)] + [x.tolist() for x in rng.normal(size=(100, 16))]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    links, label = exact(v, 0.95)
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df, shard_rows=40).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == label
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * sum(links.values())


def test_recall_sees_lost_links_of_isolated_pairs(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2500, 32))
    x[1:120:2] = x[0:120:2] + rng.normal(size=(60, 32)) * 0.05  # 60 pairs, then a dense group of many copies
    x[2300:] = x[2300] + rng.normal(size=(200, 32)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    nodes = spark.createDataFrame([(k, v.tobytes(), 50 if k >= 2300 else 1) for k, v in enumerate(x)], "node long, vec binary, n long")
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    others, links = near.sum(axis=1), near @ np.where(np.arange(2500) >= 2300, 50, 1)

    def recall(lost):
        rows = [(k, 0, 0, k) if k in lost else (k, int(links[k]), int(others[k]), k) for k in range(2500)]
        return vectors._recall(nodes, "f8", spark.createDataFrame(rows, "node long, links long, others long, root long"), 0.95, 2500)[0]

    assert recall(set()) == 1.0
    assert recall(set(range(0, 48))) < 0.9  # 48 of 320 linked rows


def test_links_across_shards_are_complete(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2400, 32))
    x[1200:] = x[:1200] + rng.normal(size=(1200, 32)) * 0.29
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    want = (near.sum(axis=1) - 1).tolist()
    assert sum(want) > 600
    for options, share in (({}, 0.98), ({"beam": 4, "probes": 1, "least_recall": 1.0}, 1.0)):  # the latter widens until nothing is lost
        got = {r["vec_id"]: r for r in vectors.near_duplicates(df, shard_rows=40, **options).collect()}
        found = [got[k]["n_links"] for k in range(2400)]
        assert sum(found) >= share * sum(want) and all(a <= b for a, b in zip(found, want))
        joined = [got[k + 1200]["component_id"] == got[k]["component_id"] for k in range(1200) if near[k, k + 1200]]
        assert sum(joined) >= share * len(joined)


def test_recall_rests_on_links_where_the_table_has_none(spark):
    x = np.random.default_rng(8).normal(size=(1500, 24))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    report = {}
    got = vectors.near_duplicates(df, shard_rows=60, report=report).collect()
    assert len(got) == 1500 and not any(r["n_links"] for r in got) and all(r["component_id"] == r["vec_id"] for r in got)
    assert report[24][0] >= 0.98 and report[24][1] >= vectors.PLANTED


def test_a_search_that_finds_too_little_ends_exact(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 16))
    x[150:] = x[:150] + rng.normal(size=(150, 16)) * 0.1
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(vectors, "_recall", lambda *a: (0.5, 9))
    report = {}
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(df, shard_rows=40, beam=90, probes=64, report=report).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert got == dict(enumerate(((x @ x.T >= 0.95).sum(axis=1) - 1).tolist())) and report == {16: (1.0, 0)}


def test_many_centres_are_fitted_in_two_levels(monkeypatch):
    monkeypatch.setattr(vectors, "ONE_LEVEL", 16)
    x = np.random.default_rng(2).normal(size=(3000, 8))
    c = vectors.fitted(x / np.linalg.norm(x, axis=1, keepdims=True), 100)
    assert 80 <= len(c) <= 120 and np.allclose(np.linalg.norm(c, axis=1), 1)


def test_links_that_several_shards_show_count_once():
    rng = np.random.default_rng(3)
    near_q, near_v, rank = rng.integers(0, 6, (200, 4)), rng.integers(0, 6, (200, 2)), rng.integers(0, 4, 200)
    want = [bool(set(q[:r].tolist()) & set(v.tolist())) for q, v, r in zip(near_q, near_v, rank)]
    assert vectors._met_before(near_q, rank, near_v).tolist() == want


def test_unite_joins_chains():
    rng = np.random.default_rng(1)
    parent, label = np.arange(200), {k: k for k in range(200)}
    for _ in range(5):
        a, b = rng.integers(0, 200, (2, 30))
        vectors.unite(parent, a, b)
        for x, y in zip(a.tolist(), b.tolist()):
            low, high = sorted((label[x], label[y]))
            label = {k: low if r == high else r for k, r in label.items()}
    assert parent.tolist() == list(label.values())


def test_workspace_is_in_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    ws = Workspace(spark, "x")
    t = ws.save(spark.range(3), "t")
    assert ws.root.startswith(f"file://{tmp_path}/") and t.count() == 3
    ws.drop(t)
    assert not list(tmp_path.glob("*/t-*"))


def test_archives_of_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1)  # fifty pages a file
    rows = [(k, f"http://h/{k}", "x" * (200_000 if k == 70 else 150) + str(k % 120)) for k in range(180)]
    path = str(tmp_path / "many")
    warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    got = {r["page_id"]: r for r in warc.resolved(warc.captures(warc.read(spark, path, payload=False))).collect()}
    assert len(list((tmp_path / "many").glob("*.gz"))) == 4 and len(got) == 180
    assert sum(r["record_type"] == "revisit" for r in got.values()) == 60 and got[70]["payload_bytes"] == 200_002
    assert got[130]["refers_to"] == 10 and got[10]["refers_to"] is None


def test_cluster_without_a_shared_folder_is_refused():
    class Fake:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master, applicationId = "spark://host:7077", "a"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Fake)
