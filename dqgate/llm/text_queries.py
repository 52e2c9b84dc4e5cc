"""Queries over single documents."""

from __future__ import annotations

from dqgate.llm import quality_rules, secret_scan, surrogates
from dqgate.llm.common import table
from dqgate.llm.registry import query

_WORDS_SQL = r"[^\x20\x09-\x0D]+"
_MENU = "|".join(quality_rules.NAVIGATION)
_PHRASES = " OR ".join(f"contains(lower(x), '{p}')" for p in quality_rules.BOILERPLATE)
_TERMINAL = quality_rules.TERMINAL.replace("'", "''")

_QUALITY_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '{_WORDS_SQL}') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORDS_SQL}')) AS ls
  FROM d
), good AS (
  SELECT *, list_filter(ls, lambda x:
      regexp_matches(x, '{_TERMINAL}[\x20\x09-\x0D]*\z')
      AND 100 * (length(x) - length(regexp_replace(x, '[#*$%&|<>]+|[!?]{{2,}}', '', 'g'))) <= 5 * length(x)
      AND NOT regexp_matches(x, '^(?i)[\x20\x09-\x0D]*({_MENU})([\x20\x09-\x0D]*[|>/·.]*[\x20\x09-\x0D]*({_MENU}))*[\x20\x09-\x0D.|>/·]*\z')
      AND NOT ({_PHRASES})) AS gs
  FROM w
), win AS (
  SELECT r, i, ws[i:i + 4] AS g FROM w, unnest(range(1, len(ws) - 3)) AS u(i)
), twice AS (
  SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r
), c AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    len(ls)::BIGINT AS n_lines, len(gs)::BIGINT AS n_good_lines,
    length(array_to_string(ls, ''))::BIGINT AS n_line_chars,
    length(array_to_string(gs, ''))::BIGINT AS n_good_chars
  FROM good LEFT JOIN rep USING (r)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND 100 * (n_line_chars - n_good_chars) <= 50 * n_line_chars AS kept
FROM c
"""


@query("op1_quality_rules", _QUALITY_SQL)
def op1_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("clean_text")


@query("op3_secret_scan")
def op3_secret_scan(spark, sf_dir):
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "word_index", "value", "probability", "is_secret")


@query("op7_pii_surrogates")
def op7_pii_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs)
