"""Operator 11 [native]: url filter by rules and by empirical-Bayes host reputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexigraph.llm.common import LOWER, UPPER
from lexigraph.session import written

#: (verdict, host and path) of the rules; a small fixed list, compiled into one expression.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Suffixes of several labels under which domains are registered; all others have one label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "co.nz", "com.br", "co.in", "com.cn", "com.tr")
#: A host is blocked where the upper posterior bound of its share of good pages is below this.
LEAST_GOOD = 0.5
#: Standard deviations of the bound: one-sided 95 %.
DEVIATIONS = 1.645
#: Pages' worth of evidence that a prior may weigh, and its weight where the level has nothing to estimate it from.
WEIGHTS, USUAL_WEIGHT = (1.0, 200.0), 20.0


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or # (or the end), A-Z in lower case; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The listed suffix of several labels that the host ends in, else its last label; an address of digits is its own suffix."""
    bare = F.regexp_replace(host, r"^.*@|:[0-9]*$|\.$", "")
    out = F.substring_index(bare, ".", -1)
    for s in suffixes:
        out = F.when((bare == s) | bare.endswith(f".{s}"), s).otherwise(out)
    return F.when(bare.rlike(r"^[0-9.]+$|^\["), bare).otherwise(out)


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix with one label before it, or the suffix alone where the host has no more."""
    bare = F.regexp_replace(host, r"^.*@|:[0-9]*$|\.$", "")
    head = bare.substr(F.lit(1), F.char_length(bare) - F.char_length(suffix) - 1)
    return F.when(bare == suffix, suffix).otherwise(F.concat(F.substring_index(head, ".", -1), F.lit("."), suffix))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, the ASCII-least of equally long ones; nulls where none does.

    A rule fits its host and all hosts below it, if the path starts with the rule's.
    """
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _shrunk(children: DataFrame, prior: Column) -> DataFrame:
    """children (n, k, and the prior mean of each) with `weight`, the prior's worth in pages, and the posterior `mean`.

    The weight is one for the level: the correlation of pages of one child, by the method of moments of the
    beta-binomial law, as E n (k/n - m)^2 = m (1 - m) (1 + (n - 1) rho), and weight = 1 / rho - 1. Terms are
    summed as decimals, so the sum does not depend on the order of rows.
    """
    c = children.withColumn("prior", prior)
    spread = F.pow(F.col("k") / F.col("n") - F.col("prior"), F.lit(2.0)) * F.col("n") / (F.col("prior") * (1 - F.col("prior")))
    seen = c.where("n > 0").agg(F.sum(spread.cast("decimal(28,9)")).cast("double").alias("s"), F.count("*").alias("c"), F.sum("n").alias("t"))
    rho = (F.col("s") - F.col("c")) / (F.col("t") - F.col("c"))
    low, high = WEIGHTS
    kept = F.greatest(F.lit(1 / (1 + high)), F.least(F.lit(1 / (1 + low)), rho))
    weight = F.when(F.col("t") > F.col("c"), 1 / kept - 1).otherwise(F.lit(USUAL_WEIGHT))
    c = c.crossJoin(F.broadcast(seen.select(weight.alias("weight"))))  # one row
    return c.withColumn("mean", (F.col("k") + F.col("weight") * F.col("prior")) / (F.col("n") + F.col("weight")))


def host_reputation(hosts: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(host, n, k): labelled pages of each host and the good ones among them -> host, n, k, domain, mean, bound.

    The share of good pages is shrunk from all pages to suffixes, from these to registered domains, from these
    to hosts; `mean` is the posterior mean of the host and `bound` its upper bound. A host without labelled
    pages has the posterior of its domain with the full spread of its prior. Levels above hosts have a row a domain or suffix.
    """
    h = hosts.withColumn("suffix", suffix_of(F.col("host"), suffixes)).withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    total = lambda d, *keys: d.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = total(h, "domain", "suffix")
    tops = total(domains, "suffix")
    whole = tops.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("n"), F.lit(0)) + 2.0)).alias("whole"))
    tops = _shrunk(tops.crossJoin(F.broadcast(whole)), F.col("whole")).select("suffix", F.col("mean").alias("up"))
    domains = _shrunk(domains.join(tops, "suffix"), F.col("up")).select("domain", F.col("mean").alias("up"))
    h = _shrunk(h.join(domains, "domain"), F.col("up"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("weight") + 1))
    return h.select("host", "n", "k", "domain", "mean", F.least(F.lit(1.0), F.col("mean") + DEVIATIONS * deviation).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url", item: Column | None = None, rules: tuple[tuple[str, str], ...] = RULES, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict, domain, n_labelled, posterior, bound for every row of pages.

    outcomes has (item, good boolean), and `item` is the column of pages that names it (its id unless given);
    an item with several outcomes is good if all are. The verdict is the rule's, else "block" where even the upper
    posterior bound of the host's share of good pages is below LEAST_GOOD, and "allow" elsewhere. A host without
    outcomes is judged by those of its domain, a domain without them by its suffix, and that by all pages.

    Only (host, item) with its number of pages is joined to the outcomes, and only (host, counts) to the levels
    above; counts are summed before they move. Hosts are then a written table with one row each, so the join
    back is a broadcast if that table is small, else one of two exchanges, in which adaptive execution splits a host that
    has a third of all pages.

    Null urls and urls without :// have an empty host and path; such pages are one host. Null ids and repeated
    rows are judged like others, null items and null outcomes count for nothing, no other column is read, an empty table gives an
    empty result.
    """
    p = pages.select(pages[id_col].alias("page_id"), host_of(pages[url_col]).alias("host"), path_of(pages[url_col]).alias("path"), (pages[id_col] if item is None else item).alias("item"))
    known = outcomes.where("item IS NOT NULL AND good IS NOT NULL").groupBy("item").agg(F.min(F.col("good").cast("int")).alias("good"))
    seen = p.groupBy("host", "item").agg(F.count("*").alias("pages"))
    labelled = seen.join(known, "item").select("host", F.col("pages").alias("n"), (F.col("pages") * F.col("good")).alias("k"))
    every = seen.select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("k"))
    hosts = labelled.union(every).groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    judged = written(host_reputation(written(hosts, "url-hosts"), suffixes), "url-reputation")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = p.join(judged, "host")
    own = F.when(F.col("bound") < LEAST_GOOD, "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "domain", F.col("n").alias("n_labelled"), F.round("mean", 6).alias("posterior"), F.round("bound", 6).alias("bound"))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
q AS (SELECT *, TRY_CAST(nullif(regexp_extract(path, '/([0-9]{1,18})(?:[./]|$)', 1), '') AS BIGINT) AS item,
        regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\.$', '') AS bare FROM p),
o AS (SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
s AS (SELECT host, bare, count(good) AS n, coalesce(sum(good), 0) AS k,
        CASE WHEN regexp_matches(bare, '^[0-9.]+$|^\[') THEN bare
             ELSE coalesce(nullif(regexp_extract(bare, '(?:^|\.)((?:co|org|ac)\.uk|(?:com|net)\.au|co\.jp|co\.nz|com\.br|co\.in|com\.cn|com\.tr)$', 1), ''), regexp_extract(bare, '[^.]*$')) END AS suffix
      FROM q LEFT JOIN o ON q.item = o.doc_id GROUP BY host, bare),
h AS (SELECT host, CAST(n AS DOUBLE) AS n, CAST(k AS DOUBLE) AS k, suffix,
        CASE WHEN bare = suffix THEN suffix ELSE regexp_extract(bare[1:length(bare) - length(suffix) - 1], '[^.]*$') || '.' || suffix END AS domain FROM s),
w0 AS (SELECT (coalesce(sum(k), 0) + 1.0::DOUBLE) / (coalesce(sum(n), 0) + 2.0::DOUBLE) AS m FROM h),
a1 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM h, w0 GROUP BY suffix),
w1 AS (SELECT CASE WHEN sum(n) > count(*) THEN 1 / greatest(1 / 201.0::DOUBLE, least(0.5::DOUBLE, (CAST(sum(CAST((k / n - m) ** 2 * n / (m * (1 - m)) AS DECIMAL(28, 9))) AS DOUBLE) - count(*)) / (sum(n) - count(*)))) - 1 ELSE 20.0::DOUBLE END AS w FROM a1 WHERE n > 0),
b1 AS (SELECT suffix, (k + w * m) / (n + w) AS m FROM a1, w1),
a2 AS (SELECT h.domain, sum(n) AS n, sum(k) AS k, any_value(b1.m) AS m FROM h JOIN b1 USING (suffix) GROUP BY h.domain),
w2 AS (SELECT CASE WHEN sum(n) > count(*) THEN 1 / greatest(1 / 201.0::DOUBLE, least(0.5::DOUBLE, (CAST(sum(CAST((k / n - m) ** 2 * n / (m * (1 - m)) AS DECIMAL(28, 9))) AS DOUBLE) - count(*)) / (sum(n) - count(*)))) - 1 ELSE 20.0::DOUBLE END AS w FROM a2 WHERE n > 0),
b2 AS (SELECT domain, (k + w * m) / (n + w) AS m FROM a2, w2),
a3 AS (SELECT h.*, b2.m FROM h JOIN b2 USING (domain)),
w3 AS (SELECT CASE WHEN sum(n) > count(*) THEN 1 / greatest(1 / 201.0::DOUBLE, least(0.5::DOUBLE, (CAST(sum(CAST((k / n - m) ** 2 * n / (m * (1 - m)) AS DECIMAL(28, 9))) AS DOUBLE) - count(*)) / (sum(n) - count(*)))) - 1 ELSE 20.0::DOUBLE END AS w FROM a3 WHERE n > 0),
b3 AS (SELECT host, domain, n, w, (k + w * m) / (n + w) AS m FROM a3, w3),
j AS (SELECT *, least(1.0::DOUBLE, m + 1.645 * sqrt(m * (1 - m) / (n + w + 1))) AS bound FROM b3),
r AS (SELECT q.page_id, q.host, q.path, j.*,
        CASE WHEN (q.host = 'www.example.com' OR q.host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
             WHEN (q.host = 'example.com' OR q.host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
             WHEN (q.host = 'net' OR q.host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
             WHEN (q.host = 'net' OR q.host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
             WHEN (q.host = 'com' OR q.host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
      FROM q JOIN j ON q.host = j.host)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN bound < 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       domain, CAST(n AS BIGINT) AS n_labelled, round(m, 6) AS posterior, round(bound, 6) AS bound
FROM r
"""


def op11_url_filter(spark, sf_dir: str) -> DataFrame:
    """Outcomes are the labels of the document that a page's path names: good is quality 1 and not toxic."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    item = F.regexp_extract(path_of(pages["url"]), r"/([0-9]{1,18})(?:[./]|$)", 1).try_cast("long")
    outcomes = labels.select(F.col("doc_id").alias("item"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    return judge_urls(pages, outcomes, item=item)
