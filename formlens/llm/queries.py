"""Queries of this subpackage: ``QUERIES`` by name, and ``ORACLE`` for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe as _bpe
from . import chat as _chat
from . import decontaminate as _decontaminate
from . import hard_negatives as _hard_negatives
from . import language as _language
from . import license as _license
from . import near_dedup as _near_dedup
from . import packing as _packing
from . import quality as _quality
from . import resample as _resample
from . import suffix_dedup as _suffix_dedup
from . import toxicity as _toxicity
from . import url_filter as _url_filter
from .common import held_out, table, tokenizer_path


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _decontaminate.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, sizes WHERE len(w) >= k)),
hit AS (SELECT doc_id, dw.k, i, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.s = bw.s),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    apart = held_out(F.col("doc_id"))
    out = _toxicity.score(docs, _toxicity.fit(docs, table(spark, sf_dir, "labels"), ~apart))
    return out.select("doc_id", apart.alias("held_out"), "score", F.when(F.col("score") >= _toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op3_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _license.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.r = link.a),
m AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON d.doc_id = m.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


# two hexadecimal digits stand for a byte; a window's earliest place is the least (doc_id, start)
OP6_SQL = r"""
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(generate_series(0, n - 100)) AS i FROM d WHERE n >= 100)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
e AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM r),
g AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM e),
span AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, g),
piece AS (
  SELECT doc_id, a AS pos, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c, a AS z, b - a AS gone FROM span
  UNION ALL SELECT s.doc_id, 1000000000, max(b), max(n), NULL FROM span s JOIN d ON s.doc_id = d.doc_id GROUP BY s.doc_id),
k AS (
  SELECT p.doc_id, sum(gone) AS n_removed, count(gone) AS n_spans, string_agg(substr(h, 2 * c + 1, 2 * (z - c)), '' ORDER BY pos) AS kept
  FROM piece p JOIN d ON p.doc_id = d.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

# Verdict, host and path of the rules.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

# Hosts that are blocked, with all subdomains, where no rule fits.
BLOCKED_NAMES = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
BLOCKED_HOSTS = [f"{name}.example.{top}" for name in BLOCKED_NAMES for top in ("com", "net", "org")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocked = spark.createDataFrame([(h,) for h in BLOCKED_HOSTS], "key string")
    return _url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, blocked)\
        .select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) t(verdict, rh, rp)),
best AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
         FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(verdict,
         CASE WHEN regexp_matches(host, '(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.example\.(com|net|org)$') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best ON p.page_id = best.page_id
"""


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = _chat.read_back(_chat.windows(turns)).select(
        "conv_id", "window", "chars", F.size("turns").cast("long").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("targets"),
    )
    # a digest over a whole conversation needs its text in one row
    joined = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sum(F.length("targets")).alias("loss_chars"),
        F.array_sort(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"),
    )
    text = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    return joined.select(
        "conv_id", "n_turns", F.sha2(text("turns"), 256).alias("turns_sha256"), "loss_chars", F.sha2(text("targets"), 256).alias("loss_sha256"), "formatted_chars",
    )


OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (
  SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM t),
s AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM n),
w AS (
  SELECT *, start // 256 AS win, n = 1 AND role = 'system' AS lead,
         regexp_replace(regexp_replace(regexp_replace(replace(replace(text, '%', '%25'), '<|', '%3C|'), '<(/?s>)', '%3C\1', 'g'),
           '<(/?SYS>>|</?SYS>>)', '%3C\1', 'g'), '\[(/?INST\])', '%5B\1', 'g') AS body FROM s),
x AS (SELECT conv_id, win, min(start) AS first, lead(min(start)) OVER (PARTITION BY conv_id ORDER BY win) AS next_first FROM w GROUP BY conv_id, win),
y AS (
  SELECT w.*, x.next_first IS NOT NULL AND NOT lead AND x.next_first - start <= 64 AS again,
         count(DISTINCT w.win) OVER (PARTITION BY w.conv_id) AS wins
  FROM w JOIN x ON w.conv_id = x.conv_id AND w.win = x.win)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum((length(role) + length(body) + 24) * (1 + CAST(again AS INT) + CASE WHEN lead THEN wins - 1 ELSE 0 END) + CASE WHEN again THEN 1 WHEN lead THEN wins - 1 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM y GROUP BY conv_id
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = _quality.fit(docs, table(spark, sf_dir, "labels"))
    return _quality.judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = _language.identify(docs, ~held_out(F.col("doc_id")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    ids = _bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).select("doc_id", "ids")
    return _bpe.decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _resample.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


# crc32 by its rule: a table of 256 remainders, then the bytes of a word one by one
OP12_SQL = r"""
WITH tab AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS i)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS w FROM d),
bw AS (SELECT unnest(w) AS w FROM b),
words AS (SELECT w FROM dw UNION SELECT w FROM bw),
h AS (
  SELECT w, xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, len(hex(encode(w))) // 2), lambda k: CAST('0x' || substr(hex(encode(w)), 2 * k + 1, 2) AS BIGINT)),
           lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket FROM words, tab),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN h USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN h USING (w) GROUP BY bucket),
g AS (
  SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
           / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t ON s.bucket = t.bucket),
f AS (SELECT doc_id, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM dw JOIN h USING (w) JOIN g USING (bucket) GROUP BY doc_id),
z AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN f ON d.doc_id = f.doc_id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM z WHERE n_features >= 20)
SELECT z.doc_id, n_features, weight, score, CASE WHEN k <= (SELECT count(*) FROM r) * 10 // 100 THEN k END AS rank
FROM z LEFT JOIN r ON z.doc_id = r.doc_id
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return _hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


OP13_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b AS p, score AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (
  SELECT p.a, p.p, p.ps, s.b AS n, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.b) AS k
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.ps <= 100 * s.score AND 100 * s.score <= 90 * p.ps)
SELECT a AS anchor_id, p AS positive_id, CAST(k AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE k <= 10
"""


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_toxicity": op2_toxicity,
    "op3_license": op3_license,
    "op4_packing": op4_packing,
    "op5_near_dedup": op5_near_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_chat": op8_chat,
    "op9_quality": op9_quality,
    "op10_language": op10_language,
    "op11_bpe": op11_bpe,
    "op12_resample": op12_resample,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE = {
    "op1_decontaminate": OP1_SQL,
    "op5_near_dedup": OP5_SQL,
    "op6_suffix_dedup": OP6_SQL,
    "op7_url_filter": OP7_SQL,
    "op8_chat": OP8_SQL,
    "op12_resample": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
