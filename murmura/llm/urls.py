"""URL filters: allow and block rules in one trie over reversed host labels and path segments.

A rule names a host and the start of a path. It fits its host and all subdomains, if the url's path starts
with the rule's path. Of the rules that fit, the longest decides: the one with most host labels, among these
the one with the longest path; where one host and path is both allowed and blocked, block decides. A url
that no rule fits gets the filter's default verdict.

The trie is a table of numbered nodes, walked once a url, so the time for a url doesn't depend on the number
of rules. It goes to the executors as one broadcast, whose size is checked first; longer rule lists are joined
to the urls by host and by the closed part of the path instead, with the same results.

Cases: a null url, or one without ``://``, has an empty host and path, fits no rule and gets the default.
Rules without host or verdict are dropped, a rule's null path is empty and fits every path; repeated rules count
once. Rows may repeat, and other columns, whatever their names, don't matter. An empty table gives an empty result;
without rules every url gets the default.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
#: The rules of the query: verdict, host, path.
RULES = [
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
]
#: Rule lists of up to so many characters are broadcast as a trie; its memory is about fifteen times that.
TRIE_CHARS = 10_000_000
RULE_SCHEMA = "verdict string, host string, path string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Trie:
    """Rules by reversed host label, then by closed path segment (``en/``), then by the open rest of the path.

    Nodes are numbers and edges one flat table, so a rule of any depth can be sent to the executors.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.labels: dict[tuple[int, str], int] = {}
        self.segments: dict[tuple[int, str], int] = {}
        self.verdicts: dict[int, dict[str, tuple[str, str]]] = {}
        self.lengths: dict[int, list[int]] = {}
        self._nodes = 1
        for verdict, host, path in rules:
            self._add(verdict, host, path)

    def _step(self, edges: dict[tuple[int, str], int], node: int, label: str) -> int:
        below = edges.setdefault((node, label), self._nodes)
        self._nodes += below == self._nodes
        return below

    def _add(self, verdict: str, host: str, path: str) -> None:
        node = 0
        for label in reversed(host.split(".")):
            node = self._step(self.labels, node, label)
        *closed, rest = path.split("/")
        for segment in closed:
            node = self._step(self.segments, node, segment)
        ends = self.verdicts.setdefault(node, {})
        if rest not in ends or verdict == BLOCK:
            ends[rest] = (host + path, verdict)
        self.lengths[node] = sorted({len(x) for x in ends}, reverse=True)

    def _ending(self, node: int, rest: str) -> tuple[str, str] | None:
        """The longest rule that ends at this node, of those whose open rest starts ``rest``."""
        ends = self.verdicts.get(node)
        if ends:
            for n in self.lengths[node]:
                if len(rest) >= n and rest[:n] in ends:
                    return ends[rest[:n]]
        return None

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The deciding rule and its verdict; None if no rule fits."""
        best, node, end = None, 0, len(host)
        while node is not None:
            at = host.rfind(".", 0, end) if end >= 0 else -1
            node = self.labels.get((node, host[at + 1 : end])) if end >= 0 else None
            if node is not None:
                best = self._along(node, path) or best
                end = at
        return best

    def _along(self, node: int, path: str) -> tuple[str, str] | None:
        """The longest rule of this very host whose path starts ``path``."""
        best, start = self._ending(node, path), 0
        while (end := path.find("/", start)) >= 0:
            node = self.segments.get((node, path[start:end]))
            if node is None:
                break
            start = end + 1
            best = self._ending(node, path[start:]) or best
        return best


def host(url: str | Column = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: str | Column = "url") -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)


def _normal(rules: DataFrame) -> DataFrame:
    """Distinct rules, hosts lower-cased; of a host and path that is both blocked and allowed, block."""
    named = rules.where(F.col("host").isNotNull() & F.col("verdict").isin(ALLOW, BLOCK))
    rows = named.select(
        F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    return rows.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def judged(pages: DataFrame, rules: DataFrame, default: str = ALLOW, trie_chars: int = TRIE_CHARS) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``host``, ``path``, the deciding ``rule`` (else null) and the ``verdict``."""
    urls = pages.select(pages["page_id"], host(pages["url"]).alias("host"), path(pages["url"]).alias("path"))
    rules = _normal(rules)
    size = rules.agg(F.sum(F.length("host") + F.length("path") + 1)).first()[0] or 0
    found = _by_trie(urls, rules) if size <= trie_chars else _by_join(urls, rules)
    return found.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", F.lit(default)).alias("verdict")
    )


def _by_trie(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` with ``found``, by a walk through the broadcast trie; no shuffle."""
    trie = Trie((r.verdict, r.host, r.path) for r in rules.collect())
    held = urls.sparkSession.sparkContext.broadcast(trie)

    @F.pandas_udf("rule string, verdict string")
    def find(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in batches:
            found = [held.value.find(h, p) or (None, None) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    return urls.withColumn("found", find("host", "path"))


def _by_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by joins, for rule lists too long to broadcast.

    Every different host and path is looked up once, however many rows it has: under each of its suffixes of
    labels and each closed start of its path, an equal key of a rule whose open rest the path goes on with.
    """
    different = urls.select("host", "path").distinct()
    # No further than the deepest rule goes, so that the keys of a long url stay short.
    rules = rules.withColumns({"labels": F.size(F.split("host", r"\.")), "closed": F.size(F.split("path", "/")) - 1})
    deepest = rules.agg(F.max("labels").alias("labels"), F.max("closed").alias("closed")).first()
    labels, segments = F.split("host", r"\."), F.split("path", "/", (deepest.closed or 0) + 2)
    n = F.least(F.size(labels), F.lit(deepest.labels or 1))
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.call_function("substring_index", F.col("host"), F.lit("."), -i))
    starts = F.transform(F.sequence(F.lit(1), F.least(F.size(segments), F.lit((deepest.closed or 0) + 1))), lambda i: F.array_join(F.slice(segments, F.lit(1), i - 1), "/"))
    looked = different.select("host", "path", F.explode(suffixes).alias("rule_host"))
    looked = looked.select("host", "path", "rule_host", F.posexplode(starts).alias("closed", "start"))
    known = rules.select(
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
        "verdict",
        "closed",
        F.regexp_extract("path", r"(?s)^(.*)/", 1).alias("start"),
    )
    fits = looked.join(known, ["rule_host", "closed", "start"]).where(F.col("path").startswith(F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(
        F.max(
            F.struct(
                F.size(F.split("rule_host", r"\.")).alias("n"),
                F.length("rule_path").alias("m"),
                F.concat("rule_host", "rule_path").alias("rule"),
                "verdict",
            )
        ).alias("found")
    )
    return urls.join(best, ["host", "path"], "left")


_HOST = r"regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)"
_PATH = r"regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"


def _rows(rules: list[tuple[str, str, str]]) -> str:
    return ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in rules)


JUDGED_SQL = f"""
WITH rules(verdict, host, path) AS (VALUES {_rows(RULES)}),
urls AS (
  SELECT row_number() OVER () AS n, page_id, translate(coalesce({_HOST}, ''), '{UPPER}', '{LOWER}') AS host,
         coalesce({_PATH}, '') AS path
  FROM pages
),
fits AS (
  SELECT u.n, r.verdict, r.host || r.path AS rule
  FROM urls u JOIN rules r ON starts_with(u.path, r.path) AND (u.host = r.host OR ends_with(u.host, '.' || r.host))
  QUALIFY row_number() OVER (PARTITION BY u.n ORDER BY len(string_split(r.host, '.')) DESC, len(r.path) DESC, r.verdict DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (n)
"""
