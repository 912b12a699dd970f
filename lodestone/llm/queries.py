"""The queries of this subpackage, with their production parameters, and their SQL."""

from pyspark.sql import DataFrame, SparkSession

from .chat import chat_digests
from .classifier import score_quality
from .decontaminate import contaminated
from .licenses import scan_licenses
from .near_dedup import near_duplicates
from .packing import pack
from .prefix_trie import TRIE_SQL, prefix_trie
from .quality_rules import quality_rules
from .shards import assign_shards
from .substring_dedup import repeated_digests
from .tables import table
from .toxicity import score_toxicity
from .url_filters import filter_urls, rule_and_term_sql
from .whitening import whiten


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_digests(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digests(table(spark, sf_dir, "conversations"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_license_scan": op4_license_scan,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_sharding": op6_sharding,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_url_filters": op11_url_filters,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_embedding_whitening": op13_embedding_whitening,
}

# Conversation -1 is the probe; a control string in a text takes two more characters, as does
# a backslash one. Turns are valid if each role may follow the one before it.
CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
said AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER w AS n, coalesce(lag(coalesce(role, '')) OVER w, '') AS before
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
sized AS (
  SELECT *, CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 11 WHEN 'tool' THEN 15
      ELSE 23 + length(role) + length(role) - length(replace(role, '\', ''))
        + 2 * len(regexp_extract_all(role, '<s>|</s>|\[(?:OUT|/?(?:SYS|INST|TOOL|ROLE)|/TURN)\]')) END
    + length(text) + length(text) - length(replace(text, '\', ''))
    + 2 * len(regexp_extract_all(text, '<s>|</s>|\[(?:OUT|/?(?:SYS|INST|TOOL|ROLE)|/TURN)\]')) AS chars,
    CASE before WHEN '' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
      WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role IN ('user', 'tool')
      WHEN 'tool' THEN role = 'assistant' ELSE false END AS allowed
  FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(chars))::BIGINT AS formatted_chars,
  bool_and(allowed) AND last(role ORDER BY n) = 'assistant' AS valid
FROM sized GROUP BY conv_id
"""

REPEATS_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i AS start, array_to_string(words[i:i + 19], ' ') AS run
  FROM docs, LATERAL (SELECT unnest(range(1, greatest(len(words) - 18, 1))) AS i)),
later AS (
  SELECT doc_id, start FROM (
    SELECT doc_id, start, row_number() OVER (PARTITION BY run ORDER BY doc_id, start) AS n FROM windows)
  WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, start + unnest(range(0, 20)) AS place FROM later),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.place) AS text, count(*) AS n
  FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

NEAR_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
  FROM docs, LATERAL (SELECT unnest(range(1, greatest(len(words) - 1, 2))) AS i) WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)),
reached(doc_id, root) AS (
  SELECT doc_id, doc_id FROM docs
  UNION
  SELECT e.b, r.root FROM reached r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) e
    ON r.doc_id = e.a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(root) AS component_id,
  d.doc_id = min(root) AS kept
FROM docs d JOIN reached r ON d.doc_id = r.doc_id LEFT JOIN sizes s ON d.doc_id = s.doc_id
GROUP BY d.doc_id, s.n
"""

SQL = {
    "op1_substring_dedup": REPEATS_SQL,
    "op3_chat_formatting": CHAT_SQL,
    "op5_minhash_near_dedup": NEAR_SQL,
    "op11_url_filters": rule_and_term_sql(),
    "op12_prefix_trie": TRIE_SQL,
}
