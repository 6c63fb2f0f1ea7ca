"""URL filters: host rules, and a blocked Bloom filter of listed URLs in front of an exact join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import table

# The rules of the contract as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Blocks of the Bloom filter. One block has WORDS words of 64 bits and a URL sets one bit in each word of its block. The
#: whole filter takes 2 MB at most, whatever the length of the list; a fuller filter only lets more rows reach the join.
BLOCKS = 1 << 15
WORDS = 8

_HOST = r"^.*?://([^/?#]*)"
_PATH = r"^.*?://[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), f"(?s){_HOST}", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), f"(?s){_PATH}", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without leading ``www.``, and path without trailing slashes; null where there is no host."""
    name = F.regexp_replace(host, r"^www\.", "")
    return F.when(host != "", F.concat(name, F.regexp_replace(path, r"/+$", "")))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; both null if none does. Of equally long ones the first wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url, F.lit(-1)), F.lit(blocks)).cast("int")


def _bit(url: Column, word: int) -> Column:
    """One bit of a word, chosen by six bits of the URL's hash that no other word uses."""
    return F.call_function(
        "shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(F.xxhash64(url), 6 * word).bitwiseAND(F.lit(63))).cast("int")
    )


def bloom_filter(listed: DataFrame, url: str, blocks: int = BLOCKS) -> DataFrame:
    """One row for each used block: ``block`` and its words ``w0`` ... ``w7``. ``blocks`` rows at most."""
    bits = listed.select(_block(F.col(url), blocks).alias("block"), *[_bit(F.col(url), i).alias(f"b{i}") for i in range(WORDS)])
    return bits.groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)])


def possible_hits(urls: DataFrame, url: str, bloom: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The rows whose URL may be listed: none that is listed is missing, a few that are not may be among them."""
    found = urls.withColumn("block", _block(F.col(url), blocks)).join(F.broadcast(bloom), "block")  # at most 2 MB
    sets = [F.col(f"w{i}").bitwiseAND(_bit(F.col(url), i)) != 0 for i in range(WORDS)]
    hit = sets[0]
    for one in sets[1:]:
        hit = hit & one
    return found.where(hit).select(*urls.columns)


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, blocks: int = BLOCKS) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of ``pages`` (page_id, url).

    ``listed`` has blocked canonical URLs in its column ``url``; repeats and nulls in it don't matter. The longest rule
    that fits decides; else a listed URL is blocked and any other allowed. A null URL and one without ``://`` have an
    empty host and path, fit no rule and are never listed: allowed. Repeated pages are judged one by one. An empty
    list blocks nothing. Other columns of ``pages`` are not read.
    """
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    judged = judged.withColumn("url", canonical(F.col("host"), F.col("path")))
    listed = listed.select("url").where(F.col("url").isNotNull()).distinct()
    open_urls = judged.where(F.col("by_rule").isNull() & F.col("url").isNotNull()).select("url").distinct()
    blocked = possible_hits(open_urls, "url", bloom_filter(listed, "url", blocks), blocks).join(listed, "url", "left_semi")
    final = judged.join(blocked.withColumn("is_listed", F.lit(True)), "url", "left")
    method = F.when(F.col("is_listed") & F.col("by_rule").isNull(), F.lit("block")).otherwise(F.lit("allow"))
    return final.select("page_id", "host", "path", "rule", F.coalesce(F.col("by_rule"), method).alias("verdict"))


def repeated_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs that were captured on more than one page: the block list of the query."""
    url = canonical(url_host(F.col("url")), url_path(F.col("url")))
    return pages.select(url.alias("url")).where(F.col("url").isNotNull()).groupBy("url").count().where("count > 1").select("url")


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """All pages judged by the fixed rules, and else by the list of URLs that were captured more than once."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages, repeated_urls(pages))


_CASES = "\n".join(
    f"    WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{start}') THEN '{{{i}}}'"
    for i, (_, name, start) in sorted(enumerate(RULES), key=lambda r: -len(r[1][1] + r[1][2]))
)
_ORACLE = f"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
named AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') END AS url,
    CASE
{_CASES.format(*[name + start for _, name, start in RULES])}
    END AS rule,
    CASE
{_CASES.format(*[says for says, _, _ in RULES])}
    END AS by_rule
  FROM parts),
listed AS (SELECT url FROM named WHERE url IS NOT NULL GROUP BY url HAVING count(*) > 1)
SELECT page_id, host, path, rule,
  coalesce(by_rule, CASE WHEN url IN (SELECT url FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM named
"""

QUERIES = {"op6_url_filter": op6_url_filter}
ORACLES = {"op6_url_filter": _ORACLE}
