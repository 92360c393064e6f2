"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.llm.bloom_lm import fold, score_texts
from tidelake.llm.catalog import VOCABULARY, query, table
from tidelake.llm.cws import fingerprints as cws_fingerprints
from tidelake.llm.filter_audit import filter_audit
from tidelake.llm.licenses import scan_licenses
from tidelake.llm.mixing import mix
from tidelake.llm.outliers import quality_rules
from tidelake.llm.packing import pack_documents
from tidelake.llm.quality import score, train, training_part
from tidelake.llm.resampling import importance_resample
from tidelake.llm.secret_scan import scan_secrets
from tidelake.llm.simhash import near_duplicates
from tidelake.llm.tokens import count_tokens
from tidelake.llm.url_rules import judge_urls, rules_sql


@query("op1_token_counts")
def op1_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, VOCABULARY)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf_dir):
    packed = pack_documents(table(spark, sf_dir, "documents"), VOCABULARY, 2048)
    return packed.select(
        "doc_id", F.col("piece").cast("int"), "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, seed=42)


@query("op10_source_mixing", sql="""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
k AS (SELECT *, row_number() OVER (ORDER BY source_size * 2::DOUBLE / w, source NULLS LAST) AS k FROM n),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
             - coalesce(sum(source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2)
             / CAST(sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS v FROM k),
v AS (SELECT arg_min(v, k) AS v FROM l WHERE v <= source_size * 2::DOUBLE / w),
t AS (SELECT n.source, source_size, w, least(source_size * 2::DOUBLE, w * coalesce(v, 0)) AS target FROM n, v),
u AS (SELECT d.*, source_size, target, 6 // w AS step,
             sum(size) OVER (PARTITION BY d.source ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
i AS (SELECT doc_id, turn, source, size, (upto + source_size * p) * step AS finish
      FROM u, (VALUES (0), (1)) AS passes(p) WHERE size > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS sent FROM i),
c AS (SELECT doc_id, source, size, count(*) AS times FROM r
      WHERE sent <= (SELECT floor(sum(size) * 1.5::DOUBLE) FROM d) GROUP BY doc_id, source, size)
SELECT u.doc_id, u.size, u.source_size, u.target, CAST(u.size * coalesce(times, 0) AS BIGINT) AS taken
FROM u LEFT JOIN c ON u.doc_id IS NOT DISTINCT FROM c.doc_id AND u.size = c.size
                  AND u.source IS NOT DISTINCT FROM c.source""")
def op10_source_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, passes=2)


@query("op3_quality_classifier")
def op3_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = train(docs, table(spark, sf_dir, "labels"), sample_rows=20_000)
    return score(docs, forest).select(
        "doc_id", (~training_part("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


@query("op7_url_filters", sql=f"""
WITH r(name, verdict, pattern, rank, reported) AS (VALUES {rules_sql()}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT page_id, host, path, r.*, row_number() OVER (PARTITION BY page_id ORDER BY rank DESC, name) AS k
      FROM p LEFT JOIN r ON regexp_matches(host || chr(9) || path, '(?s)' || pattern))
SELECT page_id, host, path, CASE WHEN reported THEN name END AS rule,
       coalesce(verdict, 'allow') AS verdict, name AS matched
FROM m WHERE k = 1""")
def op7_url_filters(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))


@query("op9_license_scan")
def op9_license_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs).drop("found")


@query("op8_weighted_fingerprints")
def op8_weighted_fingerprints(spark, sf_dir):
    return cws_fingerprints(table(spark, sf_dir, "documents"))


@query("op6_bloom_language_model")
def op6_bloom_language_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id") == 1
    scored = score_texts(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), *[c for c in scored.columns if c != "doc_id"])


# CRC-32 in SQL: a table of 256 steps, then one step for each byte of a feature.
@query("op11_importance_resampling", sql="""
WITH crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
q AS MATERIALIZED (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
df AS MATERIALIZED (
  SELECT doc_id, array_to_string(w[i:i + n], ' ') AS f
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 1)) AS i FROM d, (VALUES (0), (1), (2)) AS runs(n))),
tf AS MATERIALIZED (
  SELECT array_to_string(w[i:i + n], ' ') AS f
  FROM (SELECT w, n, unnest(range(1, len(w) - n + 1)) AS i FROM q, (VALUES (0), (1), (2)) AS runs(n))),
names AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM tf)),
h AS MATERIALIZED (
  SELECT f, xor(list_reduce(
           list_prepend(4294967295, list_transform(range(0, strlen(x), 2),
             lambda i: (instr('0123456789ABCDEF', x[i + 1]) - 1) * 16 + instr('0123456789ABCDEF', x[i + 2]) - 1)),
           lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1])), 4294967295) % 10000 AS b
  FROM names, crc),
s AS (SELECT b, count(*) AS n FROM df JOIN h USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM tf JOIN h USING (f) GROUP BY b),
g AS (SELECT s.b, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM df) + 10000)::DOUBLE
        / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM tf) + 10000)::DOUBLE))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (b)),
w AS (SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM df JOIN h USING (f) JOIN g USING (b) GROUP BY doc_id),
k AS (SELECT d.doc_id, len(d.w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || sha256('42:' || d.doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
      FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM k WHERE words >= 20)
SELECT k.doc_id, n_features, weight, score,
       CASE WHEN rank <= 5 * (SELECT count(*) FROM r) // 100 THEN rank END AS rank
FROM k LEFT JOIN r USING (doc_id)""")
def op11_importance_resampling(spark, sf_dir):
    return importance_resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=5, least_words=20, seed=42)


@query("op12_filter_audit", sql="""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
f AS (
  SELECT doc_id, part, [
           len(words) < 100,
           100 * len(list_distinct(words)) < 80 * len(words),
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
           regexp_matches(text, '[#$%&*|]'),
           coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)] AS fails FROM w),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
      FROM labels GROUP BY doc_id),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
o AS (SELECT a.i || b.i || c.i || d.i || e.i AS filter_order
      FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) a(i), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) b(i),
           (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) c(i), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) d(i),
           (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) e(i)
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (
  SELECT part, filter_order, step, n, good, toxic, len(list_filter(fails, lambda x: x)) AS failed,
         fails[instr('ABCDE', filter_order[step])] AS here,
         len(list_filter(range(1, step), lambda i: fails[instr('ABCDE', filter_order[i])])) > 0 AS gone
  FROM m, o, (VALUES (1), (2), (3), (4), (5)) AS t(step))
SELECT part, filter_order, step,
       coalesce(sum(n) FILTER (NOT here AND NOT gone), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (here AND NOT gone), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (here AND gone), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (here AND failed = 1), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (here AND NOT gone), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (here AND NOT gone), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(failed, 1)) FILTER (here), 0)::BIGINT AS shapley
FROM s GROUP BY part, filter_order, step""")
def op12_filter_audit(spark, sf_dir):
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_secret_scan")
def op13_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_secrets(docs).drop("secrets")
