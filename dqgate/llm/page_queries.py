"""Queries over web pages."""

from __future__ import annotations

from dqgate.llm import url_filter
from dqgate.llm.common import table
from dqgate.llm.registry import query

_LABELS = "|".join(url_filter.LISTED_LABELS)
_RULES = sorted(url_filter.RULES, key=lambda r: -len(r.text))
_FITS = {
    r.text: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in _RULES
}

_URL_SQL = rf"""
WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), j AS (
  SELECT *, CASE {" ".join(f"WHEN {f} THEN '{t}'" for t, f in _FITS.items())} END AS rule,
    regexp_matches(host, '(^|\.)({_LABELS})\.[^.]+\.[^.]+$') AS listed
  FROM p
)
SELECT page_id, host, path, rule, listed,
  CASE {" ".join(f"WHEN rule = '{r.text}' THEN '{r.verdict}'" for r in _RULES)}
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""


@query("op10_url_filter", _URL_SQL)
def op10_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
