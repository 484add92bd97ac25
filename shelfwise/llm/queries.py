"""Registered queries of the corpus operators and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import table
from shelfwise.llm.decontaminate import containment
from shelfwise.llm.exact_dedup import exact_dedup
from shelfwise.llm.lexical_search import search
from shelfwise.llm.mixing import mix_report
from shelfwise.llm.quality_lm import quality_report
from shelfwise.llm.html_extract import extract
from shelfwise.llm.warc import warc_report
from shelfwise.llm.token_blocks import token_files
from shelfwise.llm.toxicity import toxicity_report
from shelfwise.llm.language_id import language_report
from shelfwise.llm.near_dedup import near_dedup
from shelfwise.llm.url_filter import judge
from shelfwise.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).drop("text_class")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_report(table(spark, sf_dir, "pages")).drop("complete")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op9_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The rules of the query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in URL_RULES]
    rules = spark.range(1).select(F.inline(F.array(*named)))
    return judge(table(spark, sf_dir, "pages"), rules)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op11_whitening, op12_lexical_search, op13_url_filter, op9_quality_lm, op1_html_extract, op5_warc, op4_token_blocks, op8_toxicity, op3_language_id, op6_near_dedup, op2_exact_dedup, op7_decontaminate, op10_mixing)
}

ORACLE: dict[str, str] = {}

ORACLE["op2_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS kept,
       text_sha256
FROM t
"""

ORACLE["op7_decontaminate"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w
  FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM dw)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM bw)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY 1),
h AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM h JOIN n USING (item_id) WHERE n_shared / n_item >= 0.8
"""

ORACLE["op10_mixing"] = r"""
WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce('0' || source, '1') AS skey, md5(coalesce(doc_id::VARCHAR, '')) AS order_key
  FROM documents),
s0 AS (SELECT skey, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
s1 AS (
  SELECT skey, source_size, [5, 2, 1][((row_number() OVER (ORDER BY skey) - 1) % 3 + 1)::INT] AS weight,
         sum(source_size) OVER ()::BIGINT AS total
  FROM s0),
s2 AS (
  SELECT *, source_size * 2.0::DOUBLE / weight AS full_level,
         coalesce(sum(source_size) OVER w, 0)::BIGINT AS size_before,
         (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::BIGINT AS weight_left
  FROM s1 WINDOW w AS (ORDER BY source_size * 2.0::DOUBLE / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, (total * 1.5::DOUBLE - size_before * 2.0::DOUBLE) / weight_left AS lvl FROM s2),
l AS (SELECT arg_min(lvl, (full_level, skey)) AS lvl FROM s3 WHERE full_level > lvl),
s4 AS (
  SELECT skey, source_size,
         CASE WHEN l.lvl IS NULL OR full_level <= l.lvl THEN source_size * 2.0::DOUBLE ELSE l.lvl * weight END AS target,
         (('0x' || md5(skey)[1:5])::BIGINT + 0.5::DOUBLE) / 1048576.0::DOUBLE AS off
  FROM s3, l),
p AS (
  SELECT d.*, length(size::VARCHAR) * 100 + rpad(size::VARCHAR, 2, '0')[1:2]::INT AS magnitude,
         ('0x' || order_key[1:4])::INT % 8 AS sub
  FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY skey ORDER BY magnitude, sub, order_key, size) AS place FROM p),
c AS (
  SELECT doc_id, size, source_size, target, off, place,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate
  FROM r JOIN s4 USING (skey))
SELECT doc_id, size, source_size, target,
       (least(floor(place * rate + off) - floor((place - 1) * rate + off), ceil(rate)) * size)::BIGINT AS taken
FROM c
"""

ORACLE["op6_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (SELECT doc_id AS node, doc_id AS reach FROM documents UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.reach),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n USING (doc_id)
"""

ORACLE["op5_warc"] = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS sha FROM p),
b AS (
  SELECT *, list_transform(range(32), lambda k:
    ((('0x' || rpad(sha[(k * 5 // 4 + 1)::INT:(k * 5 // 4 + 2)::INT], 2, '0'))::INT >> (3 - (k * 5 - (k * 5 // 4) * 4))::INT) % 32)::INT) AS d,
         max(page_id) OVER (PARTITION BY sha, payload_bytes) AS largest
  FROM h)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(d, lambda v: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[v + 1]), '') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM b
"""

ORACLE["op13_url_filter"] = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host FROM u),
p AS (
  SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest[length(host) + 1:], '^[^?#]*') AS path
  FROM h),
r(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       coalesce(arg_max(verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""

ORACLE["op12_lexical_search"] = r"""
WITH dt AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
it AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
p AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM dt GROUP BY 1, 2),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM p GROUP BY 1),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, n_docs),
m AS (SELECT doc_id, 100 - 90 + ((90 * n * n_docs) // n_terms) AS m FROM d, c),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM it JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
