"""Operator 9: URL filters by host-suffix and path-prefix rules (DataFrame functions only).

Every URL is expanded into expressions ``host suffix + path prefix``; the expressions meet
the rules in an equi-join on the first bytes of their SHA-256 digest, the full digest
confirms, and the longest rule decides.  The verdict depends on (host, path) alone, so each
distinct pair is judged once and joined back to the rows: a URL, host or domain that holds
a third of all rows costs no more than a rare one.

Only host suffixes with as many labels, and path prefixes of the same length, as some rule
are expanded; others cannot equal a rule, so nothing is lost and a very long host or path
stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.common import ascii_lower

ALLOW, BLOCK = "allow", "block"
#: The rules of the registered query: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Hex digits of the digest that the equi-join uses.
SHORT = 8


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + F.lit(3), F.length(url))
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return F.when(url.isNull() | (at == 0), F.lit("")).otherwise(host)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + F.lit(3), F.length(url))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(url.isNull() | (at == 0), F.lit("")).otherwise(path)


def _digest(host: Column, path: Column) -> Column:
    # a host holds no "/", and the separator keeps ("a", "/b") and ("a/b", "") apart
    return F.sha2(F.encode(F.concat(host, F.lit("\n"), path), "UTF-8"), 256)


def _expressions(urls: DataFrame, counts: list[int], lengths: list[int]) -> DataFrame:
    """One row per (host, path) and expression that has the shape of some rule: its host a
    number of labels out of ``counts``, its path a length out of ``lengths``."""
    e = urls.withColumn("_labels", F.split(F.col("host"), "\\.", -1))
    suffixes = F.transform(
        F.filter(F.lit(counts), lambda n: n <= F.size("_labels")),
        lambda n: F.array_join(F.slice(F.col("_labels"), F.size("_labels") - n + 1, n), "."))
    prefixes = F.transform(F.filter(F.lit(lengths), lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    e = e.select("host", "path", F.explode(suffixes).alias("_h"), prefixes.alias("_ps"))
    return e.select("host", "path", "_h", F.explode("_ps").alias("_p"))


def url_verdicts(urls: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """``(host, path, rule, verdict)`` for each distinct ``(host, path)`` of ``urls``.

    Longest rule (host and path characters together) wins; on equal length the longer host,
    then ``block``.  Rules that repeat are one rule; rules with a null part never fit.
    Without a fitting rule the rule is null and the verdict ``default``.
    """
    r = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        ascii_lower(F.col("host")).alias("_rh"), F.col("path").alias("_rp"), "verdict").distinct()
    r = r.withColumn("_rd", _digest(F.col("_rh"), F.col("_rp")))
    # two short lists of small integers, however many rules there are
    counts, lengths = r.agg(F.sort_array(F.collect_set(F.size(F.split("_rh", "\\.", -1)))),
                            F.sort_array(F.collect_set(F.length("_rp")))).first()
    keys = urls.select("host", "path").distinct()
    e = _expressions(keys, list(counts), list(lengths)).withColumn("_d", _digest(F.col("_h"), F.col("_p")))
    hit = (e.withColumn("_short", F.substring("_d", 1, SHORT))
            .join(r.withColumn("_short", F.substring("_rd", 1, SHORT)), "_short")
            .where(F.col("_d") == F.col("_rd")))
    rank = F.struct((F.length("_rh") + F.length("_rp")).alias("n"), F.length("_rh").alias("h"),
                    (F.col("verdict") == BLOCK).alias("b"),
                    F.concat("_rh", "_rp").alias("rule"), F.col("verdict").alias("verdict"))
    best = hit.groupBy("host", "path").agg(F.max(rank).alias("_best"))
    return (keys.join(best, ["host", "path"], "left")
                .select("host", "path", F.col("_best.rule").alias("rule"),
                        F.coalesce("_best.verdict", F.lit(default)).alias("verdict")))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id",
                default: str = ALLOW) -> DataFrame:
    """``(key, host, path, rule, verdict)``, one row per input row.

    A null URL or one without ``://`` has empty host and path and gets ``default``; null
    keys, repeated rows and extra columns of any name do no harm (only ``key`` and ``url``
    are read); an empty table gives an empty result.
    """
    u = pages.select(F.col(key).alias(key), url_host(F.col(url)).alias("host"),
                     url_path(F.col(url)).alias("path"))
    return u.join(url_verdicts(u, rules, default), ["host", "path"], "left").select(
        key, "host", "path", "rule", "verdict")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return filter_urls(pages, rules_frame(spark))


ORACLE_OP9 = """
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN NULL
                       ELSE substr(url, position('://' IN url) + 3) END AS rest
  FROM pages),
p AS (
  SELECT row_number() OVER () AS rid, page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u),
r(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (
  SELECT p.rid, r.rh || r.rp AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.rid ORDER BY length(rh) + length(rp) DESC, length(rh) DESC) AS rk
  FROM p JOIN r ON (p.host = r.rh OR ends_with(p.host, '.' || r.rh)) AND starts_with(p.path, r.rp))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.rid = m.rid AND m.rk = 1
"""
