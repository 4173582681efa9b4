"""URL filter: a trie over reversed host labels and path segments, with longest-match precedence.

``UrlTrie`` holds allow and block entries. A rule ``host/path`` fits its host and all subdomains when the url's
path starts with the rule's path. Of the rules that fit, the one with the longest text (host and path) wins; at
equal length the one with the longer host, and of two equal rules the blocking one.

The trie is built on the driver from a rule list whose size is checked (``MAX_RULE_BYTES``) and broadcast, and every url
is judged in one pass over Arrow batches. No shuffle. A url costs time by its length, however long its segments are: of each
only as much is looked up as the longest rule that ends there has.

Null urls and urls without ``://`` have an empty host and path; no rule fits them and they get the default.
Repeated rows are judged alike; an empty table gives an empty result; all columns of the input are kept, and input
columns that carry an output column's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import free_name, prepare, table

#: Lists beyond this many bytes are refused: the trie is broadcast.
MAX_RULE_BYTES = 64 << 20
CONTRACT_RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))


class UrlTrie:
    """Nodes are dicts: ``hosts`` by next host label, and on the way down the path ``segments`` by whole segment
    and ``ends`` by the unfinished last segment of a rule, the longest of them ``most`` characters."""

    def __init__(self, rules: Iterable[tuple[str, str]], default: str = "allow"):
        self.default = default
        self.root: dict = {}
        size = 0
        for verdict, rule in rules:
            size += len(rule.encode())
            if size > MAX_RULE_BYTES:
                raise ValueError(f"the rules exceed {MAX_RULE_BYTES} bytes")
            if verdict not in ("allow", "block"):
                raise ValueError(f"not a verdict: {verdict!r}")
            host, slash, rest = rule.partition("/")
            node = self.root
            for label in reversed(host.lower().split(".")) if host else ():
                node = node.setdefault("hosts", {}).setdefault(label, {})
            node = node.setdefault("paths", {})
            *whole, last = (slash + rest).split("/")
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            old = node.setdefault("ends", {}).get(last)
            if old is None or verdict == "block":
                node["ends"][last] = (verdict, rule, len(host))
                node["most"] = max(len(last), node.get("most", 0))

    def _along(self, node: dict, segments: list[str]) -> Iterator[tuple[str, str, int]]:
        for i, segment in enumerate(segments):
            ends = node.get("ends")
            if ends:
                for j in range(min(len(segment), node["most"]) + 1):
                    if hit := ends.get(segment[:j]):
                        yield hit
            if i + 1 == len(segments) or (node := node.get("segments", {}).get(segment)) is None:
                return

    def judge(self, host: str, path: str) -> tuple[str, str | None]:
        """The verdict and the winning rule (None: the default)."""
        best, segments, node = None, path.split("/"), self.root
        for label in [None, *reversed(host.split("."))] if host else []:
            if label is not None and (node := node.get("hosts", {}).get(label)) is None:
                break
            for hit in self._along(node["paths"], segments) if "paths" in node else ():
                rank = (len(hit[1]), hit[2], hit[0] == "block")
                if best is None or rank > best[0]:
                    best = (rank, hit)
        return (best[1][0], best[1][1]) if best else (self.default, None)


def filter_urls(df: DataFrame, url: str = "url", rules: Iterable[tuple[str, str]] = CONTRACT_RULES, default: str = "allow") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to every row."""
    shared = prepare(df.sparkSession).sparkContext.broadcast(UrlTrie(rules, default))
    given = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    lower = F.translate(F.regexp_extract(given, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(given, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)

    @F.pandas_udf("struct<verdict string, rule string>")
    def judged(host, path):
        import pandas as pd

        judge = shared.value.judge
        seen = [judge(h, p) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame(seen, columns=["verdict", "rule"]).astype(object).where(lambda x: x.notna(), None)

    keep = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    out = df.select(*(F.col(f"`{c}`") for c in keep), lower.alias("host"), path.alias("path"))
    name = free_name(keep, "judged")
    out = out.withColumn(name, judged("host", "path"))
    return out.select(*(F.col(f"`{c}`") for c in keep), "host", "path", F.col(f"`{name}`.rule").alias("rule"), F.col(f"`{name}`.verdict").alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def _contract_sql() -> str:
    cases = []
    for verdict, rule in CONTRACT_RULES:
        host, slash, rest = rule.partition("/")
        cases.append(f"('{verdict}', '{rule}', '{host}', '{slash + rest}')")
    return f"""
WITH rules(v, r, h, p) AS (VALUES {', '.join(cases)}),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM pages),
fit AS (SELECT n, v, r, row_number() OVER (PARTITION BY n ORDER BY length(r) DESC, length(h) DESC, v DESC) AS k
        FROM u JOIN rules ON (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, r AS rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (n)
"""


QUERIES = {"op2_url_filter": op2_url_filter}
ORACLES = {"op2_url_filter": _contract_sql()}
