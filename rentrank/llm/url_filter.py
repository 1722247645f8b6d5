"""Allow and block rules for urls, in a trie over reversed host labels and path pieces."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrank.llm.store import table

#: The rules go to every task: more than this many bytes of them are refused.
RULE_BYTES = 32 << 20
ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: Fixed values of the query.
RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)


def pieces(path: str) -> list[str]:
    """A path cut after each slash: '/en/825' is '/', 'en/', '825'."""
    cut = path.split("/")
    return [p + "/" for p in cut[:-1]] + [p for p in cut[-1:] if p]


class Paths:
    """The path part below one host of the trie."""

    def __init__(self):
        self.children: dict[str, Paths] = {}
        self.verdict: str | None = None
        self.starts: dict[str, str] = {}  # last pieces without slash, which any longer piece fits

    def add(self, path: str, verdict: str) -> None:
        node = self
        cut = pieces(path)
        for piece in cut:
            if not piece.endswith("/"):
                node.starts[piece] = _stronger(node.starts.get(piece), verdict)
                return
            node = node.children.setdefault(piece, Paths())
        node.verdict = _stronger(node.verdict, verdict)

    def longest(self, cut: list[str]) -> tuple[str, str] | None:
        node, best, done = self, None, ""
        if node.verdict:
            best = (node.verdict, done)
        for piece in cut:
            fits = [s for s in node.starts if piece.startswith(s)]
            if fits:
                start = max(fits, key=len)
                best = (node.starts[start], done + start)
            node = node.children.get(piece)
            if node is None:
                break
            done += piece
            if node.verdict:
                best = (node.verdict, done)
        return best


def _stronger(old: str | None, new: str) -> str:
    """Of two entries for the same host and path, block wins."""
    return BLOCK if BLOCK in (old, new) else new


class Trie:
    """Longest match: the rule of the most host labels; among these that of the longest path."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for rule in rules:
            if rule.verdict not in (ALLOW, BLOCK):
                raise ValueError(f"verdict {rule.verdict!r}")
            node = self.root
            for label in _labels(rule.host):
                node = node.setdefault(label, {})
            node.setdefault("", Paths()).add(rule.path, rule.verdict)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule as host + path) of the longest rule that fits, or None."""
        cut = pieces(path)
        node, best, depth = self.root, None, 0
        labels = _labels(host)
        while True:
            if "" in node and (found := node[""].longest(cut)):
                best = (found[0], ".".join(reversed(labels[:depth])) + found[1])
            if depth == len(labels) or labels[depth] not in node:
                return best
            node = node[labels[depth]]
            depth += 1


def _labels(host: str) -> list[str]:
    """Host labels from the right. An empty label can't meet the key of a node's paths."""
    return [label or "." for label in reversed(host.split("."))] if host else []


def judged(pages: DataFrame, rules: Iterable[Rule], default: str = ALLOW, key: str = "page_id") -> DataFrame:
    """``key``, host, path, rule, verdict for every row of ``pages``.

    Host: between the first '://' and the next '/', '?', '#' or the end, A-Z lower-cased; path:
    from there up to '?', '#' or the end. Both are empty for a NULL url or one without '://'.
    A rule fits its host and all subdomains if the path starts with the rule's. A url that no
    rule fits gets ``default``, and a NULL rule. Rows come back as often as they are in.
    """
    rules = [Rule(r.verdict, _lower(r.host), r.path) for r in rules]
    size = sum(len(r.host.encode()) + len(r.path.encode()) for r in rules)
    if size > RULE_BYTES:
        raise ValueError(f"{size} bytes of rules; a task can hold {RULE_BYTES}")
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(Trie(rules))
    rest = _after_scheme("url")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    parts = pages.select(
        F.col(key),
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        path.alias("path"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for batch in batches:
            found = [
                trie.match(host, path) or (default, None)
                for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            ]
            columns = [pa.array([f[1] for f in found], pa.string()), pa.array([f[0] for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "rule", "verdict"])

    kind = parts.schema[0].dataType.simpleString()
    return parts.mapInArrow(run, f"{key} {kind}, host string, path string, rule string, verdict string")


def _after_scheme(url: str):
    at = F.instr(F.col(url), "://")
    return F.coalesce(F.when(at > 0, F.col(url).substr(at + 3, F.length(url))), F.lit(""))


def _lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judged(table(spark, sf_dir, "pages"), RULES)


ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0
    THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
found AS (
  SELECT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts)
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN found USING (host, path)
"""
