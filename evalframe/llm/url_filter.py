"""Operator 8: URL filter by a trie over reversed host labels and path segments.

Rules are (verdict, host, path). A rule fits a URL whose host is the rule's or a subdomain
of it and whose path starts with the rule's path (character for character, so the path
``/en/`` does not fit ``/en`` and the path ``/`` does not fit an empty path). Of the rules
that fit, the one with most host labels wins, then the one with the longest path; a rule
named twice counts once, and a block beats an allow of the very same host and path.

The trie is built from the rule list and broadcast; ``max_rules`` bounds it (a
longer list raises). URLs never leave their partition: there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
RESULT = "rule string, verdict string"


class _Node:
    __slots__ = ("children", "paths")

    def __init__(self):
        self.children: dict[str, _Node] = {}
        self.paths: _Node | None = None


class _PathNode:
    """``ends``: for a rule that ends within this segment, the last segment's prefix, the rule and its verdict."""

    __slots__ = ("children", "ends")

    def __init__(self):
        self.children: dict[str, _PathNode] = {}
        self.ends: dict[str, tuple[str, str]] = {}


class UrlTrie:
    """Longest-match lookup of (host, path)."""

    def __init__(self, rules: Iterable[tuple[str, str, str]], max_rules: int = 1_000_000):
        self.root, self.size = _Node(), 0
        for verdict, host, path in rules:
            self.size += 1
            if self.size > max_rules:
                raise ValueError(f"more than {max_rules} URL rules; the trie is broadcast, so raise max_rules only if it fits in an executor")
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict must be allow or block: {verdict!r}")
            host = host.translate(str.maketrans(UPPER, LOWER))
            node = self.root
            for label in reversed(host.split(".")):
                node = node.children.setdefault(label, _Node())
            if node.paths is None:
                node.paths = _PathNode()
            at, (*whole, last) = node.paths, path.split("/")
            for segment in whole:
                at = at.children.setdefault(segment, _PathNode())
            if at.ends.get(last, ("", ""))[1] != "block":
                at.ends[last] = (host + path, verdict)

    @staticmethod
    def _longest(node: _PathNode, path: str) -> tuple[str, str] | None:
        best, segments = None, path.split("/")
        for i, segment in enumerate(segments):
            for prefix in sorted(node.ends, key=len):
                if segment.startswith(prefix):
                    best = node.ends[prefix]
            if i == len(segments) - 1 or segment not in node.children:
                break
            node = node.children[segment]
        return best

    def lookup(self, host: str, path: str) -> tuple[str, str] | None:
        """The winning (rule, verdict), or None."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.children.get(label)
            if node is None:
                break
            if node.paths is not None:
                best = self._longest(node.paths, path) or best
        return best


def url_parts(url):
    """Host and path columns of a URL column: both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.regexp_extract(url, PARTS, 2))


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", max_rules: int = 1_000_000) -> DataFrame:
    """Verdict per row: ``id_col, host, path, rule, verdict``.

    ``rule`` is null and ``verdict`` the default where no rule fits (also for null or
    empty URLs). Repeated rows give repeated results; other columns of the input are not read.
    """
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules, max_rules))

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        find = trie.value.lookup
        for hosts, paths in batches:
            got = [find(h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(got, columns=["rule", "verdict"])

    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    return parts.withColumn("_judged", judge("host", "path")).select(id_col, "host", "path", "_judged.rule", "_judged.verdict")
