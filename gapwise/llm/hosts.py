"""URL filtering by rules and by empirical-Bayes reputation of hosts.

Outcomes of labelled pages (good or not) are summed by host. A host's rate of good pages has a
beta prior around its registered domain's, that one around its suffix's, that one around the
whole table's; the strength of each prior is estimated from the table by the moments of the
beta-binomial law. A host is blocked where even the upper bound of its posterior, mean plus
``z`` deviations, is below ``least_good``. Rules come first: the longest that fits decides.

DataFrame functions only. A registered domain is taken as the last two labels of a host, its
suffix as the last. Defined results: null urls and such without ``://`` have an empty host and
path, like any host of their own; pages without labels count only as pages; hosts without
labelled pages get their prior, which is 1 in a table without labels; repeated labels of one page count once, the worse one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bounds of the correlation of outcomes within a group, and its value where the table has none.
LEAST_RHO, MOST_RHO, NO_RHO = 0.0001, 0.5, 0.01


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does.

    A rule is a host and the beginning of a path, like ``example.net/en/``.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, action in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is asked first
        own, slash, begin = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + begin))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame) -> DataFrame:
    """The prior's strength from groups (n, y, parent): one row, kappa."""
    m = F.col("parent")
    above = F.sum((F.col("y") - F.col("n") * m) * (F.col("y") - F.col("n") * m) - F.col("n") * m * (1 - m))
    below = F.sum(F.col("n") * (F.col("n") - 1) * m * (1 - m))
    rho = F.coalesce(F.when(below > 0, above / below), F.lit(NO_RHO))
    return groups.agg((1 / F.least(F.lit(MOST_RHO), F.greatest(F.lit(LEAST_RHO), rho)) - 1).alias("kappa"))


def reputations(outcomes: DataFrame, hosts: DataFrame, least_good: float, z: float) -> DataFrame:
    """(host, good 0/1) and all (host) to host, n, mean, upper, reputation ('allow' or 'block')."""
    counted = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("y"))
    table = hosts.distinct().join(counted, "host", "left").select(
        "host",
        F.substring_index("host", ".", -2).alias("domain"),
        F.substring_index("host", ".", -1).alias("suffix"),
        F.coalesce("n", F.lit(0)).cast("double").alias("n"),
        F.coalesce("y", F.lit(0)).cast("double").alias("y"),
    )
    sums = [F.sum("n").alias("n"), F.sum("y").alias("y")]
    top = table.agg(((F.coalesce(F.sum("y"), F.lit(0.0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 1)).alias("parent"))

    # one row each of overall rate and strength: joined as single-row tables
    def shrunk(groups: DataFrame) -> DataFrame:
        return groups.join(F.broadcast(_strength(groups))).withColumn("a", F.col("y") + F.col("kappa") * F.col("parent")).withColumn("b", F.col("n") - F.col("y") + F.col("kappa") * (1 - F.col("parent")))

    rate = F.col("a") / (F.col("a") + F.col("b"))
    by_suffix = shrunk(table.groupBy("suffix").agg(*sums).join(F.broadcast(top))).select("suffix", rate.alias("parent"))
    by_domain = shrunk(table.groupBy("domain", "suffix").agg(*sums).join(by_suffix, "suffix")).select("domain", "suffix", rate.alias("parent"))
    by_host = shrunk(table.join(by_domain, ["domain", "suffix"]))
    upper = rate + F.lit(float(z)) * F.sqrt(rate * (1 - rate) / (F.col("a") + F.col("b") + 1))
    return by_host.select(
        "host", "n", rate.alias("mean"), upper.alias("upper"), F.when(upper < least_good, F.lit("block")).otherwise(F.lit("allow")).alias("reputation")
    )


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    least_good: float = 0.8,
    z: float = 1.645,
) -> DataFrame:
    """One row for each page: id, host, path, rule, verdict, and the host's rate and bound.

    ``labels`` has doc_id and quality; the number that ends a url's path names the document.
    """
    host, path = split_url(F.col(url_col))
    split = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    named = split.select("host", F.when(number != "", number).cast("long").alias("doc")).filter("doc IS NOT NULL")
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc")).agg(F.min("quality").alias("good"))
    table = reputations(named.join(known, "doc").select("host", "good"), split.select("host"), least_good, z)
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    out = split.join(table, "host").withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, "reputation"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", "verdict", F.col("mean").alias("host_rate"), F.col("upper").alias("host_bound"))


#: The same in DuckDB SQL, for the rules and parameters of the registered query.
ORACLE = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM parts
), split AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM cut
), known AS (
  SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), counted AS (
  SELECT host, count(*) AS n, sum(good) AS y
  FROM split JOIN known ON doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})(?:\.html)?/?$', 1), '') AS bigint)
  GROUP BY host
), tab AS (
  SELECT h.host, array_to_string(list_slice(string_split(h.host, '.'), -2, -1), '.') AS domain,
         list_extract(string_split(h.host, '.'), -1) AS suffix,
         coalesce(n, 0)::double AS n, coalesce(y, 0)::double AS y
  FROM (SELECT DISTINCT host FROM split) h LEFT JOIN counted USING (host)
), s0 AS (
  SELECT suffix, sum(n) AS n, sum(y) AS y, (SELECT (coalesce(sum(y), 0) + 1) / (coalesce(sum(n), 0) + 1) FROM tab) AS parent FROM tab GROUP BY suffix
), sk AS (
  SELECT 1 / least(0.5, greatest(0.0001, coalesce(CASE WHEN sum(n * (n - 1) * parent * (1 - parent)) > 0
    THEN sum((y - n * parent) * (y - n * parent) - n * parent * (1 - parent)) / sum(n * (n - 1) * parent * (1 - parent)) END, 0.01))) - 1 AS kappa FROM s0
), s1 AS (SELECT suffix, (y + kappa * parent) / (n + kappa) AS parent FROM s0, sk
), d0 AS (
  SELECT domain, suffix, sum(n) AS n, sum(y) AS y, any_value(s1.parent) AS parent FROM tab JOIN s1 USING (suffix) GROUP BY domain, suffix
), dk AS (
  SELECT 1 / least(0.5, greatest(0.0001, coalesce(CASE WHEN sum(n * (n - 1) * parent * (1 - parent)) > 0
    THEN sum((y - n * parent) * (y - n * parent) - n * parent * (1 - parent)) / sum(n * (n - 1) * parent * (1 - parent)) END, 0.01))) - 1 AS kappa FROM d0
), d1 AS (SELECT domain, suffix, (y + kappa * parent) / (n + kappa) AS parent FROM d0, dk
), h0 AS (SELECT host, n, y, parent FROM tab JOIN d1 USING (domain, suffix)
), hk AS (
  SELECT 1 / least(0.5, greatest(0.0001, coalesce(CASE WHEN sum(n * (n - 1) * parent * (1 - parent)) > 0
    THEN sum((y - n * parent) * (y - n * parent) - n * parent * (1 - parent)) / sum(n * (n - 1) * parent * (1 - parent)) END, 0.01))) - 1 AS kappa FROM h0
), h1 AS (SELECT host, n + kappa AS strength, (y + kappa * parent) / (n + kappa) AS rate FROM h0, hk
), rep AS (
  SELECT host, CASE WHEN rate + 1.645 * sqrt(rate * (1 - rate) / (strength + 1)) < 0.8 THEN 'block' ELSE 'allow' END AS reputation FROM h1
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM split
)
SELECT page_id, host, path, rule,
  CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'example.com/de/' THEN 'block' WHEN 'org/fr/' THEN 'allow' WHEN 'net/' THEN 'block' ELSE reputation END AS verdict
FROM ruled JOIN rep USING (host)
"""
