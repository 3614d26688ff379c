"""URL filters: allow and block rules first, else an empirical-Bayes reputation of the host.

Labelled page outcomes (bad or not) are counted by host, registered domain and suffix (the last label, or a longer end that
is listed; the domain has one label more). Each level's rate is shrunk to its parent's with a beta-binomial prior whose
strength is estimated by moments from the spread of the level's own rates. A host is blocked if the lower bound of its
posterior is over `limit`; so a host without outcomes is judged by its domain, and that by its suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beta_trials, small, work_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host and path prefix)
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LIMIT, Z = 0.5, 1.645


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; nulls if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest comes last and stands outermost
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, says).otherwise(verdict)
    return text, verdict


def with_domains(hosts: DataFrame, suffixes: DataFrame | None = None, most_suffixes: int = 100_000) -> DataFrame:
    """hosts (host, ...) with `suffix`, the longest listed end of whole labels of the host, or its last label if none is listed,
    and `domain`, the suffix with one label more.

    suffixes: (suffix) such as a list of public suffixes has, `co.uk` for one; without it no end is listed."""
    labels = F.split("host", r"\.")
    end = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n, F.lit(0)) + 1, n), ".")
    length = F.lit(1)
    if suffixes is not None:
        ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.struct(n.alias("length"), end(n).alias("suffix")))
        listed = small(work_table(suffixes.select("suffix").distinct()), most_suffixes)
        found = hosts.select("host", F.explode(ends).alias("end")).select("host", "end.*").join(listed, "suffix").groupBy("host").agg(F.max("length").alias("length"))
        hosts, length = hosts.join(found, "host", "left"), F.coalesce("length", F.lit(1))
    return hosts.withColumns({"suffix": end(length), "domain": end(length + 1)}).drop("length")


def host_reputation(pages: DataFrame, outcomes: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """host, n, k, mean, lower for each host of pages (id, host).

    outcomes: (id, bad) with bad 0 or 1; an id may have none, one or several. Hosts without any outcome have
    their domain's rate. Without outcomes at all every rate is 0. suffixes: see with_domains().
    """
    counted = pages.join(outcomes.filter("id is not null and bad is not null"), "id", "left").groupBy("host")
    counted = work_table(counted.agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k")))  # pages are read once
    hosts = with_domains(counted, suffixes)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()  # one row
    rate = (total["k"] or 0.0) / total["n"] if total["n"] else 0.0
    suffixes = suffixes.withColumn("prior", F.lit(rate))

    def shrunk(rows: DataFrame) -> tuple[DataFrame, float]:
        m = beta_trials(rows)
        return rows.withColumn("mean", (F.col("prior") * m + F.col("k")) / (F.col("n") + m)), m

    suffixes, _ = shrunk(suffixes)
    domains, _ = shrunk(domains.join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix"))
    hosts, m = shrunk(hosts.join(domains.select("domain", F.col("mean").alias("prior")), "domain"))
    trials = F.col("n") + F.lit(m)
    deviation = F.sqrt(F.greatest(F.col("mean") * (1 - F.col("mean")), F.lit(0.0)) / (trials + 1))
    return hosts.select("host", "n", "k", "mean", (F.col("mean") - Z * deviation).alias("lower"))


def filter_urls(pages: DataFrame, id_: str, url: str, outcomes: DataFrame, rules=RULES, limit: float = LIMIT, suffixes: DataFrame | None = None) -> DataFrame:
    """id, host, path, rule, verdict for each row of pages, in one pass over the urls and a join on the host.

    A null url, or one without ://, has an empty host and path, fits no rule and is allowed; very long urls are read whole.
    Repeated ids and rows are judged row by row. Rules of one length that fit one url are the same rule, so no ties arise.
    suffixes: see with_domains(); without it a registered domain is the last two labels. Other columns of pages, of any
    name, don't matter. An empty table gives no rows.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pages.select(F.col(id_).alias("id"), host.alias("host"), path.alias("path"))
    hosts = host_reputation(rows.select("id", "host"), outcomes, suffixes)
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("host") != "") & (F.col("lower") > limit), "block").otherwise("allow")
    return rows.join(hosts.select("host", "lower"), "host", "left").select(
        F.col("id").alias(id_), "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict")
    )


def op9_url_reputation(spark, sf_dir: str) -> DataFrame:
    """Outcomes: the labels of the same id; bad if toxic or of low quality."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url", labels.select(F.col("doc_id").alias("id"), bad.alias("bad")))


def _rule_sql() -> tuple[str, str]:
    text = verdict = "CAST(NULL AS VARCHAR)"
    for says, rule in sorted(RULES, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + rest}')"
        text, verdict = f"CASE WHEN {fits} THEN '{rule}' ELSE {text} END", f"CASE WHEN {fits} THEN '{says}' ELSE {verdict} END"
    return text, verdict


def _level_sql(name: str, of: str) -> str:
    return f"""
{name}_m AS (SELECT CASE WHEN coalesce(sum(n * (n - 1) * prior * (1 - prior)), 0) = 0 THEN 999.0e0 ELSE 1e0 / least(greatest(
  (sum(power(k - n * prior, 2)) - sum(n * prior * (1 - prior))) / sum(n * (n - 1) * prior * (1 - prior)), 0.001e0), 0.5e0) - 1e0 END AS m FROM {of} WHERE n > 0),
{name} AS (SELECT {of}.*, m, (prior * m + k) / (n + m) AS mean FROM {of}, {name}_m)"""


ORACLE = f"""
WITH r AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{URL}', 1), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '{URL}', 2) AS path FROM pages),
o AS (SELECT doc_id, CAST(toxic = 1 OR quality = 0 AS INT) AS bad FROM labels),
h0 AS (SELECT host, regexp_extract(host, '[^.]*$') AS suffix, regexp_extract(host, '([^.]*\\.)?[^.]*$') AS domain,
  CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS k FROM r LEFT JOIN o ON page_id = doc_id GROUP BY ALL),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h0 GROUP BY ALL),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d0 GROUP BY ALL),
s1 AS (SELECT *, (SELECT CASE WHEN sum(n) > 0 THEN sum(k) / sum(n) ELSE 0 END FROM s0) AS prior FROM s0),{_level_sql("s2", "s1")},
d1 AS (SELECT d0.*, s2.mean AS prior FROM d0 JOIN s2 USING (suffix)),{_level_sql("d2", "d1")},
h1 AS (SELECT h0.*, d2.mean AS prior FROM h0 JOIN d2 USING (domain)),{_level_sql("h2", "h1")}
SELECT page_id, r.host, path, {_rule_sql()[0]} AS rule, coalesce({_rule_sql()[1]},
  CASE WHEN host <> '' AND mean - {Z} * sqrt(greatest(mean * (1 - mean), 0) / (n + m + 1)) > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM r JOIN h2 USING (host)
"""
