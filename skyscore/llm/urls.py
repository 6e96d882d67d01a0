"""URL filters: a trie over reversed host labels, then path segments, with the
longest matching rule deciding between allow and block."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: rules that one trie, shipped to every task, may hold; more go through a join
MAX_TRIE_RULES = 200_000


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in
    lower case. Null or without ``://``: empty."""
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(after, upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Nodes are ``[children, ends]``: host labels from the right, then a mark
    that the host is complete, then whole path segments. ``ends`` holds
    (rest, length, rule, verdict): the rule fits if what is left of the path
    starts with ``rest``, the piece of its path after the last slash."""

    HOST_DONE = object()

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.root: list = [{}, []]
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node[0].setdefault(("h", label), [{}, []])
            *segments, rest = path.split("/")
            for s in segments:
                node = node[0].setdefault(("p", s), [{}, []])
            node[1].append((rest, len(host) + len(path), host + path, verdict))

    def longest(self, host: str, path: str):
        """(rule, verdict) of the longest rule that fits, else None. Equal
        lengths cannot both fit one url unless they are the same rule; then
        block goes before allow."""
        segments, best, node = path.split("/"), None, self.root
        for label in reversed(host.split(".")):
            node = node[0].get(("h", label))
            if node is None:
                break
            below, i = node, 0
            while below is not None:
                for rest, size, rule, verdict in below[1]:
                    if segments[i].startswith(rest):
                        best = max(best or (-1, "", ""), (size, verdict, rule))
                # the last piece has no slash after it, so it is no whole segment
                below = below[0].get(("p", segments[i])) if i < len(segments) - 1 else None
                i += 1
        return best and (best[2], best[1])


def judge(df: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with ``host, path, rule, verdict``.

    ``rules``: (host, path prefix, 'allow' or 'block'). A rule fits its host
    and all subdomains if the url's path starts with the rule's path; the
    longest (host and path together) decides, block before allow between
    repeated rules; none: ``rule`` is null and ``verdict`` is ``default``. A
    null url, or one without ``://``, has empty host and path and takes the
    default. Columns named host, path, rule or verdict are replaced. No rules
    or no rows work. Rules beyond ``MAX_TRIE_RULES`` are joined instead of
    shipped (:func:`judge_by_join`), with the same result.
    """
    if len(rules) > MAX_TRIE_RULES:
        return judge_by_join(df, df.sparkSession.createDataFrame(rules, "host string, path string, verdict string"),
                             url, default)
    d = df.drop("host", "path", "rule", "verdict").withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    trie = df.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def look_up(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        t = trie.value
        for hosts, paths in parts:
            found = [t.longest(h, p) or (None, default) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    out = d.withColumn("_found", look_up("host", "path"))
    return out.withColumns({"rule": F.col("_found.rule"), "verdict": F.col("_found.verdict")}).drop("_found")


def judge_by_join(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The same judgement with the rules as a table of any size: each distinct
    (host, path) meets, over the suffixes of its host, the rules of that host;
    one aggregate keeps the longest that fits. Every row stays."""
    d = df.drop("host", "path", "rule", "verdict").withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    urls = d.select("host", "path").distinct().withColumn("_suffix", F.explode(suffixes))
    r = rules.select(F.col("host").alias("_rh"), F.col("path").alias("_rp"), F.col("verdict").alias("_rv"))
    best = (urls.join(r, (F.col("_suffix") == F.col("_rh")) & F.col("path").startswith(F.col("_rp")))
            .groupBy(F.col("host").alias("_h"), F.col("path").alias("_p"))
            .agg(F.max(F.struct((F.length("_rh") + F.length("_rp")).alias("n"), F.col("_rv").alias("v"),
                                F.concat("_rh", "_rp").alias("r"))).alias("_b")))
    return (d.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
            .withColumns({"rule": F.col("_b.r"), "verdict": F.coalesce(F.col("_b.v"), F.lit(default))})
            .drop("_h", "_p", "_b"))


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select(
        "page_id", "host", "path", "rule", "verdict")


SQL5 = r"""
WITH u AS (SELECT page_id,
  coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE
  WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
