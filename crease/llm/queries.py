"""Registered queries of the training-data operators, and their DuckDB SQL."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm.bm25 import top_k
from crease.llm.chat import conversation_digests, format_conversations
from crease.llm.common import WORD, read_table, stage
from crease.llm.html_extract import extract
from crease.llm.line_dedup import drop_frequent_lines
from crease.llm.mixing import mix_report
from crease.llm.near_dup import near_classes
from crease.llm.packing import pack_documents
from crease.llm.periodic_runs import periodic_runs
from crease.llm.quality import judge
from crease.llm.shingle_join import similar_components
from crease.llm.token_alignment import align_documents
from crease.llm.url_filter import judge_urls
from crease.llm.warc import archive_and_index


def op1_sainte_lague_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(read_table(spark, sf_dir, "documents"))


def op2_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table has no capture times: a second a page, from a fixed day on
    captured = F.date_format(F.timestamp_seconds(
        F.lit(1704067200) + F.coalesce(F.pmod(F.col("page_id"), F.lit(31536000)), F.lit(0))),
        "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return archive_and_index(read_table(spark, sf_dir, "pages"), captured).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"""SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(col1 AS BIGINT) AS turn, col2 AS role,
                          '{said}' AS text FROM VALUES (0, 'user'), (1, 'assistant')""")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(stage(format_conversations(turns.unionByName(extra)), "chat-windows"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_frequent_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op8_bm25_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"))


def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read_table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def _looped(docs: DataFrame) -> DataFrame:
    """One text in ten, by its id's checksum, goes periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"array(named_struct('w', regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), 'g', g))")
    looped = F.expr("""transform(transform(words, s -> named_struct('w', s.w, 'n', size(s.w), 'g', s.g,
          'a', cast(pmod(s.g, size(s.w)) as int))),
        s -> array_join(transform(sequence(0, s.n - 1), i -> s.w[if(i < s.a, i,
          cast(s.a + (i - s.a) % (1 + (s.n - s.a) div (3 + s.g % 8)) as int))]), ' '))[0]""")
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    mark = (F.col("h") % 10 == 0) & F.regexp_like("text", F.lit(WORD))
    rows = rows.select("doc_id", "text", F.when(mark, words).alias("words"))
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), looped).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(_looped(read_table(spark, sf_dir, "documents")))
    best = F.expr("""aggregate(runs, cast(null as struct<start: long, length: long, period: long>),
        (b, r) -> if(b is null or r.length * b.period > b.length * r.period, r, b))""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return (rows.withColumn("best", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op13_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sainte_lague_mixing": op1_sainte_lague_mixing,
    "op2_warc_index_merge": op2_warc_index_merge,
    "op3_html_extraction": op3_html_extraction,
    "op4_chat_windows": op4_chat_windows,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_line_dedup": op6_line_dedup,
    "op7_bag_minhash": op7_bag_minhash,
    "op8_bm25_block_max_wand": op8_bm25_block_max_wand,
    "op9_url_filters": op9_url_filters,
    "op10_quality_rules": op10_quality_rules,
    "op11_pair_bitmaps": op11_pair_bitmaps,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_grouped_prefix_join": op13_grouped_prefix_join,
}

ORACLE: dict[str, str] = {}

# words, lines and 3-word windows of every whole text, in SQL
ORACLE["op10_quality_rules"] = r"""
WITH D AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
W AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM D),
P AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM W),
G AS (SELECT rid, i, w AS a, lead(w) OVER o AS b, lead(w, 2) OVER o AS c
      FROM P WINDOW o AS (PARTITION BY rid ORDER BY i)),
M AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM G WHERE c IS NOT NULL),
R AS (SELECT rid, count(DISTINCT j) AS n_repeat_words
      FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM M WHERE n > 1) GROUP BY rid),
S AS (SELECT W.rid, doc_id, len(ws) AS n_words, len(ls) AS n_lines,
             cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM W LEFT JOIN R ON R.rid = W.rid),
B AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM S)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT 10 * n_symbols > n_words AND NOT 2 * n_dup_lines > n_lines
       AND word_chars BETWEEN 2 * n_words AND 15 * n_words AS kept
FROM B"""


ORACLE["op6_line_dedup"] = r"""
WITH D AS (SELECT row_number() OVER () AS rid, doc_id,
                  string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
L AS (SELECT rid, doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM D),
K AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM L),
F AS (SELECT k FROM K WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT rid) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE F.k IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE F.k IS NULL), ''))
       AS kept_sha256
FROM K LEFT JOIN F ON F.k = K.k GROUP BY rid, doc_id"""

# host and path as the contract has them; every rule on every url
ORACLE["op9_url_filters"] = r"""
WITH U AS (SELECT page_id, coalesce(url, '') AS u, instr(coalesce(url, ''), '://') AS p0 FROM pages),
P AS (SELECT page_id, CASE WHEN p0 > 0 THEN
        regexp_extract(substr(u, p0 + 3), '^[^/?#]*') ELSE '' END AS raw_host,
        CASE WHEN p0 > 0 THEN regexp_extract(substr(u, p0 + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
        CASE WHEN p0 > 0 THEN translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        ELSE '' END AS low FROM U),
H AS (SELECT *, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
      FROM P),
R(rule, rhost, rpath, action) AS (VALUES ('net/', 'net', '/', 'block'),
  ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
F AS (SELECT page_id, host, path, low, rule, action, row_number() OVER (
        PARTITION BY page_id, host, path, low ORDER BY length(rule) DESC, rule) AS rn
      FROM H LEFT JOIN R ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN regexp_matches(low,
  '(^|[^a-z0-9])(spam[^a-z0-9]+farm|cheap[^a-z0-9]+pills|casino|adult|xxx|porn|viagra|free[^a-z0-9]+download|click[^a-z0-9]+bait|doubleclick)($|[^a-z0-9])')
  THEN 'block' ELSE 'allow' END) AS verdict
FROM F WHERE rn = 1"""


ORACLE["op2_warc_index_merge"] = r"""
WITH P AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
K AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS last, count(*) OVER (PARTITION BY d) AS copies FROM P),
R AS (SELECT *, n >= 1000 AND copies > 1 AND page_id IS DISTINCT FROM last AND last IS NOT NULL AS revisit
      FROM K)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN last END AS refers_to FROM R"""

# every query against every document: all shared words, all scores, then the ten best
ORACLE["op8_bm25_block_max_wand"] = r"""
WITH D AS (SELECT row_number() OVER () AS rid, doc_id, text,
                  regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws FROM documents),
S AS (SELECT count(*) AS n, sum(len(ws)) / count(*) AS mean FROM D),
P AS (SELECT rid, doc_id, w, count(*) AS tf, any_value(len) AS len
      FROM (SELECT rid, doc_id, unnest(ws) AS w, len(ws) AS len FROM D) GROUP BY rid, doc_id, w),
F AS (SELECT w, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM P, S GROUP BY w),
Q AS (SELECT min(rid) AS rid FROM D WHERE doc_id % 20 = 0 GROUP BY doc_id, text),
M AS (SELECT a.doc_id AS query_id, a.rid AS q, b.rid, b.doc_id,
             round(sum(a.tf * idf * b.tf * 2.2 / (b.tf + 1.2 * (0.25 + 0.75 * b.len / mean))), 6) AS score
      FROM Q JOIN P a ON a.rid = Q.rid JOIN F ON F.w = a.w JOIN P b ON b.w = a.w, S
      GROUP BY a.doc_id, a.rid, b.rid, b.doc_id),
R AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
      FROM M)
SELECT query_id, doc_id, score, rank FROM R WHERE rank <= 10"""


# all pairs that share a shingle, all links, then everything that links reach
ORACLE["op13_grouped_prefix_join"] = r"""
WITH RECURSIVE W AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
S AS (SELECT DISTINCT rid, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: concat(ws[i], ' ', ws[i + 1], ' ', ws[i + 2])) END) AS g
    FROM W),
N AS (SELECT rid, count(*) AS n FROM S GROUP BY rid),
P AS (SELECT a.rid AS x, b.rid AS y, count(*) AS i FROM S a JOIN S b ON a.g = b.g AND a.rid < b.rid
    GROUP BY a.rid, b.rid),
L AS (SELECT x, y FROM P JOIN N p ON p.rid = x JOIN N q ON q.rid = y WHERE 100 * i >= 90 * (p.n + q.n - i)),
E AS (SELECT x, y FROM L UNION ALL SELECT y, x FROM L),
R(x, y) AS (SELECT rid, rid FROM W UNION SELECT R.x, E.y FROM R JOIN E ON E.x = R.y)
SELECT any_value(w.doc_id) AS doc_id, any_value(coalesce(N.n, 0)) AS n_shingles, min(v.doc_id) AS component_id
FROM R JOIN W w ON w.rid = R.x JOIN W v ON v.rid = R.y LEFT JOIN N ON N.rid = R.x GROUP BY R.x"""
