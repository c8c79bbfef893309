"""The operators of this subpackage on their whole tables, with production parameters, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwork.llm import chat, decontam, filters, jaccard, langid, lines, pieces, quality, runs, suffix, urls, voronoi, warc
from tabwork.plans.base import scratch_path, table


def op1_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality.score(docs, quality.train_on_labels(docs, table(spark, sf, "labels")))


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return langid.predict(docs, langid.train(docs))


def op3_warc_archives(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), path)
    return warc.read_archives(spark, path).drop("n_chunks")


def op4_voronoi_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return voronoi.top_k(voronoi.quantised(table(spark, sf, "embeddings")), F.col("id") % 50 == 0)


def op5_suffix_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return suffix.repeated_spans(table(spark, sf, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.groups(table(spark, sf, "documents"))


def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.sha2("text", 256).alias("text_sha256"))


def op8_chat_windows(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.read_windows(chat.chat_windows(turns.unionByName(extra)))


def op9_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.drop("hit_spans", "items")


def op10_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode_decode(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"), keep_ids=False)


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filters.audit(filters.mask_counts(table(spark, sf, "documents"), table(spark, sf, "labels")))


#: Host, path and action.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op12_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return urls.verdicts(pages, spark.createDataFrame(URL_RULES, urls.RULES), urls.html_links(pages)).drop("url")


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.periodic_runs(runs.with_periodic_tail(table(spark, sf, "documents"))).withColumn("best", runs.highest_run("runs"))
    lines = F.transform("runs", lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: f for name, f in list(globals().items()) if name.startswith("op")}

ORACLE: dict[str, str] = {}

ORACLE["op9_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, list_slice(w, i, i + least(13, len(w)) - 1) AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS names FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""


ORACLE["op3_warc_archives"] = r"""
WITH bits AS (SELECT page_id, html, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
groups AS (
  SELECT page_id, html, hex, unnest(range(0, 8)) AS g FROM bits),
numbers AS (
  SELECT page_id, html, hex, g, list_reduce([strpos('0123456789ABCDEF', substr(hex, 5 * g + j, 1)) - 1 FOR j IN range(1, 6)], lambda a, x: a * 16 + x) AS n
  FROM groups),
digests AS (
  SELECT page_id, octet_length(encode(coalesce(any_value(html), ''))) AS payload_bytes,
         string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(n // 32768 AS INT) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(n // 1024 % 32 AS INT) + 1, 1)
           || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(n // 32 % 32 AS INT) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(n % 32 AS INT) + 1, 1), '' ORDER BY g) AS payload_digest
  FROM numbers GROUP BY page_id)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = max(page_id) OVER same THEN NULL ELSE max(page_id) OVER same END AS refers_to
FROM digests WINDOW same AS (PARTITION BY payload_digest)"""


ORACLE["op8_chat_windows"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (
  SELECT *, row_number() OVER o AS pos, CAST(ceil((length(role) + length(text)) / 4.0) AS BIGINT) AS tokens,
         23 + length(replace(replace(role || text, chr(92), chr(92) || chr(92)), '<', chr(92) || 'l')) AS chars
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
q AS (SELECT *, pos = 1 AND role = 'system' AS sys FROM p),
u AS (SELECT *, sum(CASE WHEN sys THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM q),
w AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY greatest(upto - 1, 0) // 320) AS win FROM u),
x AS (SELECT *, max(upto) OVER (PARTITION BY conv_id, win) AS stop, max(win) OVER (PARTITION BY conv_id) AS wins FROM w)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars * CASE WHEN sys THEN wins WHEN win < wins AND upto > stop - 128 THEN 2 ELSE 1 END) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id"""


ORACLE["op4_voronoi_top_k"] = r"""
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(CAST(q.c AS DOUBLE[]), CAST(d.c AS DOUBLE[])) AS BIGINT) AS score
  FROM v q, v d WHERE q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


ORACLE["op6_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM k JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY node) m ON m.node = d.doc_id"""


ORACLE["op7_line_dedup"] = r"""
WITH l AS (SELECT doc_id, CAST(i AS INT) AS line, parts[i + 1] AS t FROM (SELECT doc_id, parts, unnest(range(0, len(parts))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))),
shown AS (SELECT * FROM l WHERE regexp_replace(t, '[\x09\x0B\x0C\x0D\x20]', '', 'g') <> ''),
u AS (SELECT t, length(t) AS n, min(doc_id * 1000000 + line) AS pos FROM shown GROUP BY t),
k AS (
  SELECT t, n, pos, 0 AS side, n // 2 AS h, left(t, CAST(n // 2 AS INT)) AS part FROM u WHERE n >= 20 UNION SELECT t, n, pos, 1, n // 2, right(t, CAST(n // 2 AS INT)) FROM u WHERE n >= 20
  UNION SELECT t, n, pos, 0, (n - 1) // 2, left(t, CAST((n - 1) // 2 AS INT)) FROM u WHERE n >= 20 UNION SELECT t, n, pos, 1, (n - 1) // 2, right(t, CAST((n - 1) // 2 AS INT)) FROM u WHERE n >= 20),
near AS (SELECT DISTINCT a.t FROM k a JOIN k b ON a.part = b.part AND a.side = b.side AND a.h = b.h AND b.pos < a.pos AND abs(a.n - b.n) <= 1 WHERE levenshtein(a.t, b.t) <= 1),
stay AS (SELECT u.pos FROM u LEFT JOIN near ON u.t = near.t WHERE near.t IS NULL),
marked AS (
  SELECT l.doc_id, l.line, l.t, regexp_replace(l.t, '[\x09\x0B\x0C\x0D\x20]', '', 'g') = '' OR stay.pos IS NOT NULL AS kept
  FROM l LEFT JOIN stay ON stay.pos = l.doc_id * 1000000 + l.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT kept) AS n_removed, sha256(coalesce(string_agg(t, chr(10) ORDER BY line) FILTER (WHERE kept), '')) AS text_sha256
FROM marked GROUP BY doc_id"""


ORACLE["op5_suffix_repeats"] = r"""
WITH w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
i AS (SELECT doc_id, CAST(i AS INT) AS i, md5(array_to_string(list_slice(w, i + 1, i + 50), ' ')) AS g FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM w WHERE len(w) >= 50)),
r AS (SELECT doc_id, i FROM i WHERE g IN (SELECT g FROM i GROUP BY g HAVING count(*) > 1)),
n AS (SELECT *, sum(CASE WHEN i <= p + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM (SELECT *, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -100) AS p FROM r))
SELECT doc_id, min(i) AS start_word, CAST(max(i) + 50 AS INT) AS end_word FROM n GROUP BY doc_id, span"""


ORACLE["op11_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS c, left(filter_order, step - 1) AS before FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INT) AS step FROM o)),
r AS (
  SELECT part, filter_order, step, c, n, good, toxic, contains(fails, c) AS fails, fails = c AS only_this,
         len([y FOR y IN string_split(before, '') IF y <> '' AND contains(fails, y)]) > 0 AS gone
  FROM m, s),
t AS (
  SELECT part, filter_order, step, c, sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant, sum(CASE WHEN only_this THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, c)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM t"""


#: No page of the tables holds a canonical link or a refresh, so what remains are the rules; links are tested on planted pages.
ORACLE["op12_url_filters"] = r"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
r(host, path, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
b AS (
  SELECT page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(action, length(r.host || r.path)) AS action
  FROM h JOIN r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path) GROUP BY page_id)
SELECT h.page_id, h.host, h.path, b.rule, coalesce(b.action, 'allow') AS verdict FROM h LEFT JOIN b ON b.page_id = h.page_id"""


ORACLE["op13_periodic_runs"] = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w,
         xor(list_reduce(list_prepend(4294967295, [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
             lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) AS h
  FROM documents),
e AS (SELECT *, h // 10 AS g, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN h // 10 % len(w) END AS a FROM d),
c AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] FOR i IN range(0, n)] END AS w
  FROM e),
k AS (SELECT doc_id, n, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS gram FROM (SELECT doc_id, n, w, unnest(range(0, n - 2)) AS i FROM c WHERE n >= 6)),
s AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM k x JOIN k y ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
t AS (
  SELECT doc_id, q AS period, min(i) AS start, max(i) + 3 + q - min(i) AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS piece FROM s) GROUP BY doc_id, q, piece),
r AS (
  SELECT doc_id, start, length, period FROM t WHERE length >= greatest(6, 4 * period)
  AND NOT EXISTS (SELECT 1 FROM t u WHERE u.doc_id = t.doc_id AND u.period < t.period AND u.start <= t.start AND u.start + u.length >= t.start + t.length)),
z AS (
  SELECT doc_id, count(*) AS n_runs, arg_max(start, [length / period, -start, -period]) AS start, arg_max(length, [length / period, -start, -period]) AS length,
         arg_max(period, [length / period, -start, -period]) AS period, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS told
  FROM r GROUP BY doc_id),
cut AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
gone AS (SELECT doc_id, list(i) AS i FROM cut GROUP BY doc_id)
SELECT c.doc_id, coalesce(n_runs, 0) AS n_runs, z.start, z.length, z.period, 1000 * z.length // z.period AS exponent_milli, sha256(coalesce(told, '')) AS runs_sha256,
       sha256(array_to_string([w[i + 1] FOR i IN range(0, n) IF gone.i IS NULL OR NOT list_contains(gone.i, i)], ' ')) AS collapsed_sha256
FROM c LEFT JOIN z ON z.doc_id = c.doc_id LEFT JOIN gone ON gone.doc_id = c.doc_id"""
