"""The registered queries of this folder and their DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.llm.byte_pairs import byte_pair_round_trip
from curbside.llm.decontamination import decontaminate
from curbside.llm.filter_audit import filter_audit
from curbside.llm.fingerprints import edited_fingerprints
from curbside.llm.lines import line_dedup
from curbside.llm.near_copies import near_copies
from curbside.llm.packing import pack_documents
from curbside.llm.resampling import resampled
from curbside.llm.rows import table
from curbside.llm.substrings import substring_dedup
from curbside.llm.suffixes import suffix_dedup
from curbside.llm.token_files import token_round_trip
from curbside.llm.toxicity import toxicity
from curbside.llm.warc import archive_round_trip


def sha256(column: str = "kept"):
    return F.sha2(F.coalesce(F.col(column), F.lit("")), 256).alias("kept_sha256")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", sha256())


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", sha256())


def op4_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"), words=4).drop("doc", "row")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("doc", "row")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "rest.doc_id", "n_lines", "n_dropped", sha256())


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages")).drop("payload")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pair_round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {x.__name__: x for x in (op1_substring_dedup, op2_toxicity, op3_suffix_dedup, op4_near_copies, op5_packing, op6_token_files,
                                     op7_decontamination, op8_fingerprints, op9_line_dedup, op10_warc, op11_resampling,
                                     op12_byte_pairs, op13_filter_audit)}

OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM words WHERE len(w) >= 50),
windows AS (SELECT doc_id, p, sha256(array_to_string(w[p:p + 49], ' ')) AS h FROM places),
first AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
later AS (SELECT doc_id, p FROM windows JOIN first USING (h) WHERE doc_id > first),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM later),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""

OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
    THEN list_transform(range(1, len(w) - 2), lambda p: array_to_string(w[p:p + 3], ' '))
    ELSE [array_to_string(w, ' ')] END) AS s FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b USING (s)
           WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * k >= 80 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  WITH RECURSIVE walk(a, b) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT walk.a, ways.b FROM walk JOIN ways ON walk.b = ways.a)
  SELECT a AS doc_id, min(b) AS component_id FROM walk GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept
FROM reach LEFT JOIN sizes USING (doc_id)"""

OP9_SQL = r"""
WITH each AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS p FROM documents),
keys AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM each),
first AS (SELECT k, min(doc_id) AS first FROM keys WHERE length(k) >= 10 GROUP BY k
          HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT keys.*, coalesce(doc_id > first, false) AS gone FROM keys LEFT JOIN first USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

OP10_SQL = """
WITH each AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
last AS (SELECT html, max(page_id) AS last FROM each WHERE n >= 1000 GROUP BY html),
found AS (SELECT page_id, each.html, n, CASE WHEN page_id < last THEN last END AS refers_to
          FROM each LEFT JOIN last ON each.html = last.html AND n >= 1000)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM found"""

OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM (
    SELECT doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
      100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails FROM words)
  LEFT JOIN marks USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(range(1, 6)) AS x),
orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
states AS (
  SELECT part, o, step, o[step] AS own, n, good, toxic, fails[o[step]] AS failing,
    coalesce(list_bool_or(list_transform(o[1:step - 1], lambda x: fails[x])), false) AS gone,
    len(list_filter(fails, lambda x: x)) = 1 AS alone FROM cells, steps),
sums AS (
  SELECT part, o, step, own, sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failing AND alone THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failing AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN failing AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost FROM states GROUP BY ALL)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, CAST(step AS INT) AS step,
  CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM sums"""

ORACLE_SQL = {"op1_substring_dedup": OP1_SQL, "op3_suffix_dedup": OP1_SQL, "op4_near_copies": OP4_SQL, "op9_line_dedup": OP9_SQL,
              "op10_warc": OP10_SQL, "op13_filter_audit": OP13_SQL}
