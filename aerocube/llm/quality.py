"""Quality rules, and verdicts on whole hosts.

Each text has base figures and rules. Failures are counted by host (the column `source`), each host's rate is shrunk by
a beta prior fitted to the spread of all hosts' rates, and a host is rejected if the lower bound of its posterior rate
and its own rate are over `limit`: then more than that share of what it publishes is bad, and its other documents go with it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import all_but, beta_trials, small, work_table

SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
FIGURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
LIMIT, Z = 0.5, 1.645
#: Words of text that are worked on at once.
AT_ONCE = 200_000


def _repeats(docs: list[list[bytes]]) -> np.ndarray:
    """For each list of words: how many lie in a 3-word window that it has more than once."""
    lens = np.array([len(d) for d in docs])
    flat = [w for d in docs for w in d]
    if len(flat) < 3:
        return np.zeros(len(docs), "int64")
    code, words = pd.factorize(np.array(flat, dtype=object))
    doc = np.repeat(np.arange(len(docs)), lens)
    pair, _ = pd.factorize(code[:-1] * len(words) + code[1:])
    window, kinds = pd.factorize(pair[:-1] * len(words) + code[2:])
    starts = np.flatnonzero(doc[:-2] == doc[2:])
    own, _ = pd.factorize(doc[starts] * len(kinds) + window[starts])
    again = starts[np.bincount(own)[own] > 1] if len(own) else starts
    covered = np.zeros(len(flat), bool)
    for k in range(3):
        covered[again + k] = True
    return np.bincount(doc[covered], minlength=len(docs))


@F.arrow_udf(T.StructType([T.StructField(x, T.LongType()) for x in FIGURES]))
def figures(texts: pa.Array) -> pa.Array:
    rows, repeats, held, n_held = [], [], [], 0
    for value in texts:
        text = value.as_py() or ""
        raw = text.encode()
        words = raw.split()  # at ASCII white space
        full = [x for x in raw.split(b"\n") if x.strip()]
        rows.append((len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(full), len(full) - len(set(full))))
        held.append(words)
        n_held += len(words)
        if n_held > AT_ONCE:
            repeats.append(_repeats(held))
            held, n_held = [], 0
    repeats.append(_repeats(held))
    plain = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * (len(FIGURES) - 1)
    return pa.StructArray.from_arrays([*plain, pa.array(np.concatenate(repeats), pa.int64())], list(FIGURES))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_failed() -> Column:
    """What counts against a host: the base rules, over a tenth of symbols, or over 30 % of lines that repeat others."""
    return base_failed() | (10 * F.col("n_symbols") > F.col("word_chars")) | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))


def bad_hosts(judged: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The hosts to reject, from rows (source, failed). A null source is a host of its own.

    Counts are summed where the rows lie before anything is shuffled, so a host of any size is no burden."""
    hosts = work_table(judged.groupBy("source").agg(F.count("*").cast("double").alias("n"), F.sum(F.col("failed").cast("double")).alias("k")))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()  # one row
    hosts = hosts.withColumn("prior", F.lit(total["k"] / total["n"] if total["n"] else 0.0))
    m = beta_trials(hosts)
    mean = (F.col("prior") * m + F.col("k")) / (F.col("n") + m)
    lower = mean - Z * F.sqrt(mean * (1 - mean) / (F.col("n") + m + 1))
    # more must fail than the limit by the host's own count too: where over half of a corpus fails, the prior alone would
    # reject every host, also those of which nothing fails
    return hosts.filter((lower > limit) & (F.col("k") > F.col("n") * limit)).select(F.col("source").alias("of"), F.lit(True).alias("bad"))


def _judged(docs: DataFrame, row: Column, text: str, source: str, limit: float, most_hosts: int) -> DataFrame:
    """(row, judged): for each row of docs what `row` is, and the figures with base_failed and kept as a struct.

    What is asked of a row lies in one column, so no name of the caller's can meet one of these."""
    table = work_table(docs.select(row.alias("row"), F.col(source).alias("source"), figures(F.col(text)).alias("q")).select("row", "source", "q.*"))
    bad = bad_hosts(table.select("source", rule_failed().alias("failed")), limit)
    bad = small(work_table(bad), most_hosts)  # beyond that many rejected hosts both sides are shuffled
    table = table.join(bad, F.col("source").eqNullSafe(F.col("of")), "left")
    return table.select("row", F.struct(*FIGURES, base_failed().alias("base_failed"), (~base_failed() & F.col("bad").isNull()).alias("kept")).alias("judged"))


def judge(docs: DataFrame, text: str = "text", source: str = "source", limit: float = LIMIT, most_hosts: int = 100_000, into: str = "quality") -> DataFrame:
    """docs with the column `into`: a struct of the figures, base_failed and kept.

    A null or empty text has no words and fails. Long texts are counted whole; ties don't arise; repeated rows each
    count. An empty table gives no rows. Columns of docs, of any name, stay; one called `into` is replaced.
    """
    got = _judged(docs, F.struct("*"), text, source, limit, most_hosts)
    at = [c.lower() for c in docs.columns].index(into.lower()) if into.lower() in map(str.lower, docs.columns) else len(docs.columns)
    columns = all_but("row", docs, into)
    return got.select(*columns[:at], F.col("judged").alias(into), *columns[at:])


def keep_good(docs: DataFrame, text: str = "text", source: str = "source", limit: float = LIMIT, most_hosts: int = 100_000) -> DataFrame:
    """The rows of docs that the rules and their hosts' verdicts keep, columns as before."""
    return _judged(docs, F.struct("*"), text, source, limit, most_hosts).filter("judged.kept").select("row.*")


def op7_host_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = _judged(docs, F.col("doc_id"), "text", "source", LIMIT, 100_000)  # the text itself isn't kept for the second look
    return got.select(F.col("row").alias("doc_id"), "judged.*").drop("n_lines")


#: Figures in DuckDB: f has a row per document.
FIGURES_SQL = r"""
d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
p AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1) GROUP BY doc_id),
f AS (SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words
  FROM d LEFT JOIN p ON d.doc_id = p.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(base_failed OR 10 * n_symbols > word_chars OR 10 * n_dup_lines > 3 * n_lines AS INT)) AS DOUBLE) AS k FROM b GROUP BY source),
h1 AS (SELECT *, (SELECT sum(k) / sum(n) FROM h) AS prior FROM h),
m AS (SELECT CASE WHEN coalesce(sum(n * (n - 1) * prior * (1 - prior)), 0) = 0 THEN 999.0e0 ELSE 1e0 / least(greatest(
  (sum(power(k - n * prior, 2)) - sum(n * prior * (1 - prior))) / sum(n * (n - 1) * prior * (1 - prior)), 0.001e0), 0.5e0) - 1e0 END AS m FROM h1),
bad AS (SELECT source FROM (SELECT *, (prior * m + k) / (n + m) AS mean FROM h1, m) WHERE mean - 1.645 * sqrt(mean * (1 - mean) / (n + m + 1)) > 0.5 AND k > n * 0.5)"""

ORACLE = f"""WITH {FIGURES_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM b.source) AS kept FROM b
"""
