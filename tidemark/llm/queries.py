"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, licences, mixing, packing, quality, repair, resampling, simhash, tokens, toxicity, url_rules, vectors, warc
from tidemark.llm.common import Workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    s = toxicity.score(docs, model)
    return s.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", *toxicity.KINDS)


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_chats(rows, tokens.vocabulary())).drop("n_beyond")  # tokens are beyond SQL


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
    length(role) + length(text) + len(regexp_extract_all(role, '\\|</?s>|\[/?INST\]')) + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]')) + 20 AS n
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(length(loss))::BIGINT AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"))


def _op4_grams(n: int) -> str:
    """SQL of a table (rid, place): the places of words inside n-grams of n words found twice or more in their text."""
    return f"""g{n} AS (SELECT rid, unnest(range(1, len(ws) - {n} + 2)) AS i, ws FROM d),
k{n} AS (SELECT rid, i, array_to_string(ws[i : i + {n - 1}], ' ') AS g FROM g{n}),
c{n} AS (SELECT DISTINCT rid, unnest(range(i, i + {n})) AS place FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM k{n}) WHERE n > 1),
s{n} AS (SELECT c.rid, count(*) AS words, sum(length(d.ws[place])) AS chars FROM c{n} c JOIN d USING (rid) GROUP BY c.rid)"""


OP4_SQL = (
    r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
"""
    + ",\n".join(map(_op4_grams, (8, 4, 16)))
    + r""",
l AS (SELECT rid, line, count(*) - 1 AS again, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line),
ls AS (SELECT rid, sum(again) AS n, sum(again * chars) AS chars FROM l GROUP BY rid),
m AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(ls.n, 0)::BIGINT AS n_dup_lines, coalesce(s8.words, 0)::BIGINT AS n_repeat_words,
  coalesce(ls.chars, 0)::BIGINT AS line_chars, coalesce(s8.chars, 0)::BIGINT AS chars_8, coalesce(s4.chars, 0)::BIGINT AS chars_4, coalesce(s16.chars, 0)::BIGINT AS chars_16
  FROM d LEFT JOIN ls USING (rid) LEFT JOIN s8 USING (rid) LEFT JOIN s4 USING (rid) LEFT JOIN s16 USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND line_chars <= 0.30::DOUBLE * word_chars AND chars_4 <= 0.40::DOUBLE * word_chars AND chars_8 <= 0.30::DOUBLE * word_chars
  AND chars_16 <= 0.20::DOUBLE * word_chars AND n_symbols <= 0.20::DOUBLE * n_words AS kept FROM b
"""
)


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))
    AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id)::BIGINT AS n_links, c.m AS component_id, e.vec_id = c.m AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) c ON c.a = e.vec_id
"""


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Workspace(spark, "warc").path("archive")
    warc.archive(table(spark, sf_dir, "pages"), path)
    found = warc.resolved(warc.captures(warc.read(spark, path, payload=False)))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
r AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS f FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND f <> page_id THEN f END AS refers_to
FROM r
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "mix")
    docs = ws.save(table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words("text").alias("size")), "sizes")  # words are counted once
    mix = mixing.mix(docs, F.col("size"), F.array("source"))
    report = spark.createDataFrame([(s, n, t) for s, (n, t, _) in mix.report.items()], "source string, source_size long, target double")
    rows = mix.attach(docs, F.col("size"), F.array("source")).join(F.broadcast(report.withColumnRenamed("source", "__s")), F.col("source").eqNullSafe(F.col("__s")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.length_histogram(table(spark, sf_dir, "documents"), tokens.vocabulary())


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokens.vocabulary())


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.summaries(repair.edit_log(repair.damaged(rows)), rows)


#: CRC-32 by its polynomial: a table of 256 remainders, then a fold over the bytes.
_CRC_SQL = """
crc_bits AS (SELECT i AS byte, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r FROM range(256) t(i)),
crc_table AS MATERIALIZED (SELECT list(r ORDER BY byte) AS t FROM crc_bits)"""


def _crc_sql(text: str) -> str:
    """SQL of a text's unsigned CRC-32; ``crc_table`` is among the tables that the statement joins."""
    codes = f"list_transform(range(1, 2 * octet_length(encode({text})), 2), lambda k: ('0x' || substr(hex(encode({text})), k, 2))::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


OP11_SQL = (
    "WITH RECURSIVE "
    + _CRC_SQL.strip()
    + r""",
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text, k
  FROM (SELECT *, """
    + _crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
    + r""" % 20 AS k FROM conversations, crc_table)),
o AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)::INT AS i
  FROM (SELECT * FROM d WHERE k <> 0 UNION ALL SELECT * FROM d WHERE k = 3)),
f AS MATERIALIZED (SELECT *, substr(role, 1, 1) AS init, rtrim(text, e' \t\n\x0b\x0c\r') AS words,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
c AS MATERIALIZED (SELECT *, CASE WHEN words = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN NOT regexp_matches(words, '[.!?]$') THEN 'truncated' ELSE 'fine' END AS fault FROM f),
g(state, init, after) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins AS (SELECT state, state AS after, 0 AS n FROM (VALUES (0), (1), (2), (3)) t(state)
  UNION ALL SELECT state, after, 1 FROM g WHERE init <> 's'
  UNION ALL SELECT a.state, b.after, 2 FROM g a JOIN g b ON a.after = b.state WHERE a.init <> 's' AND b.init <> 's'),
p AS (
  SELECT DISTINCT coalesce(conv_id, -1 << 62) AS conv, 0 AS i, ins.after AS state, ins.n AS n, 3 * ins.n AS cost, repeat('I', ins.n) AS audit FROM c, ins WHERE ins.state = 0
  UNION ALL
  SELECT conv, i, state, n, cost, audit FROM (
    SELECT p.conv, p.i + 1 AS i, ins.after AS state, ins.n AS n, p.cost + e.cost + 3 * ins.n AS cost, p.audit || e.label || repeat('I', ins.n) AS audit
    FROM p JOIN c ON coalesce(c.conv_id, -1 << 62) = p.conv AND c.i = p.i + 1
    JOIN (SELECT 'D' AS label, state, '' AS init, state AS after, 4 AS cost FROM (VALUES (0), (1), (2), (3)) t(state)
      UNION ALL SELECT 'K', state, init, after, 0 FROM g UNION ALL SELECT 'R', state, '', after, 3 FROM g WHERE init <> 's') e0
      ON e0.state = p.state AND (e0.label = 'D' OR (c.fault IN ('fine', 'truncated') AND (e0.label = 'R' OR e0.init = c.init)))
    CROSS JOIN LATERAL (SELECT e0.label AS label, e0.after AS after, e0.cost + CASE WHEN e0.label <> 'D' AND c.fault = 'truncated' THEN 3 ELSE 0 END AS cost) e
    JOIN ins ON ins.state = e.after
  ) QUALIFY row_number() OVER (PARTITION BY conv, state, n ORDER BY cost, audit) = 1),
z AS (SELECT conv, max(i) AS i FROM p GROUP BY conv),
best AS (SELECT p.conv, p.cost, p.audit FROM p JOIN z USING (conv, i) WHERE p.state IN (0, 3) QUALIFY row_number() OVER (PARTITION BY p.conv ORDER BY p.cost, p.audit) = 1),
marks AS (SELECT conv, unnest(range(1, length(audit) + 1)) AS k, audit FROM best),
steps AS (SELECT m.conv, m.k, substr(audit, m.k, 1) AS label, length(replace(substr(audit, 1, m.k), 'I', '')) AS i, length(replace(substr(audit, 1, m.k), 'D', '')) AS place FROM marks m),
lines AS (SELECT s.conv, s.k, s.label, s.place, CASE WHEN s.label <> 'I' THEN c.role END AS role, CASE WHEN s.label <> 'I' THEN c.text ELSE '' END AS text,
    max(CASE WHEN s.place = 1 AND s.label = 'K' AND c.init = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv) AS sys
  FROM steps s LEFT JOIN c ON coalesce(c.conv_id, -1 << 62) = s.conv AND c.i = s.i WHERE s.label <> 'D'),
said AS (SELECT conv, sha256(string_agg(CASE WHEN label = 'K' THEN role WHEN (place - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k)) AS h FROM lines GROUP BY conv),
n AS (SELECT coalesce(conv_id, -1 << 62) AS conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND substr(before, 1, 1) || init NOT IN ('su', 'ua', 'au')) AS illegal FROM c GROUP BY 1)
SELECT DISTINCT v.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM conversations v LEFT JOIN n ON n.conv = coalesce(v.conv_id, -1 << 62) LEFT JOIN best ON best.conv = n.conv LEFT JOIN said ON said.conv = n.conv
"""
)

URL_RULES = """SELECT * FROM VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block') AS rules(host, path, verdict)"""


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), spark.sql(URL_RULES))


OP12_SQL = f"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{url_rules._UPPER}', '{url_rules._LOWER}') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(h, t, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT rid, arg_max(h || t, length(h || t)) AS rule, arg_max(v, length(h || t)) AS v FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, t) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m USING (rid)
"""


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


OP13_SQL = (
    "WITH RECURSIVE "
    + _CRC_SQL.strip()
    + r""",
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
dw AS (SELECT rid, w, count(*) AS n FROM (SELECT rid, unnest(ws) AS w FROM d) GROUP BY rid, w),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark) GROUP BY w),
b AS MATERIALIZED (SELECT w, """
    + _crc_sql("w")
    + r""" % 10000 AS k FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc_table),
s AS (SELECT k, sum(n) AS n FROM dw JOIN b USING (w) GROUP BY k),
t AS (SELECT k, sum(n) AS n FROM bw JOIN b USING (w) GROUP BY k),
sums AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS s, coalesce((SELECT sum(n) FROM t), 0) AS t),
g AS (SELECT s.k, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (sums.s + 10000)::DOUBLE / ((s.n + 1)::DOUBLE * (sums.t + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (k), sums),
w AS (SELECT rid, sum(n * gain)::BIGINT AS weight FROM dw JOIN b USING (w) JOIN g USING (k) GROUP BY rid),
c AS (SELECT d.*, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN w USING (rid)),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM c WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * 10 // 100 THEN rank END AS rank FROM c LEFT JOIN r USING (rid)
"""
)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_licences, op3_chat_format, op4_quality_rules, op5_vectors, op6_warc, op7_mixing, op8_token_counts, op9_packing, op10_simhash, op11_repair, op12_url_rules, op13_resampling)}
ORACLES = {"op3_chat_format": OP3_SQL, "op4_quality_rules": OP4_SQL, "op5_vectors": OP5_SQL, "op6_warc": OP6_SQL, "op11_repair": OP11_SQL, "op12_url_rules": OP12_SQL, "op13_resampling": OP13_SQL}
