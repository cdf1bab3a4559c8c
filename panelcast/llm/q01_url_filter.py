"""op1: verdicts for the urls of ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.bloom_cascade import judge_urls, url_parts
from panelcast.llm.common import read

#: Fixed rules of the contract.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Words that put a host on the stand-in block list (a real job reads a list).
LISTED_WORDS = ("ad", "ads", "track", "tracker", "tracking", "adserver", "casino", "porn")

SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(r, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN list_has_any(string_split_regex(host, '[.-]'), {list(LISTED_WORDS)}) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def listed_hosts(pages: DataFrame) -> DataFrame:
    """Stand-in for a published block list: (key) hosts of ad and tracking services."""
    host, _ = url_parts(F.col("url"))
    words = F.split(host, "[.-]", -1)
    return pages.where(F.arrays_overlap(words, F.array(*map(F.lit, LISTED_WORDS)))).select(host.alias("key")).distinct()


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, RULES, listed_hosts(pages)).select("page_id", "host", "path", "rule", "verdict")
