"""URL verdicts from a trie over reversed host labels, then path segments.

A rule is (host, path, verdict). It fits its host and all subdomains when the url's path starts with
the rule's path. Of the fitting rules the longest (host and path characters) wins, a longer host first
on ties, so an allow entry can sit inside a block entry and the other way round. Without one, the
verdict is ``default``.

The trie is broadcast; its size is bounded by ``MAX_RULES``, checked before. Rows never move.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule. Repeated rows
stay repeated. Repeated rules: the last one holds. Only the url column is read; other columns pass
through untouched, except that ``host``, ``path``, ``rule`` and ``verdict`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import LOWER, UPPER, free_prefix

Rule = tuple[str, str, str]
MAX_RULES = 1_000_000
_FIELDS = "rule string, verdict string"


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _segments(path: str) -> list[str]:
    """``/en/a`` as ``/``, ``en/``, ``a``: only the last may lack its slash."""
    parts = path.split("/")
    return [p + "/" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


class UrlTrie:
    """Nodes are dictionaries of labels or segments; a rule ends at the node of its last segment."""

    def __init__(self, rules: Sequence[Rule]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; the broadcast trie holds {MAX_RULES} at most")
        self.hosts: dict = {}
        for host, path, verdict in rules:
            node = self.hosts
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault("/paths", {})  # no host label holds a slash
            parts = _segments(path)
            open_end = bool(parts) and not parts[-1].endswith("/")
            for part in parts[:-1] if open_end else parts:
                node = node.setdefault(part, {})
            entry = (len(host) + len(path), len(host), host + path, verdict)
            if open_end:
                node.setdefault("", {})[parts[-1]] = entry
            else:
                node["//"] = entry  # no segment holds two slashes

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        node = self.hosts
        parts = _segments(path)
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            at = node.get("/paths")
            for part in [*parts, None]:
                if at is None:
                    break
                found = [at["//"]] if "//" in at else []
                if part is not None:
                    found += [e for start, e in at.get("", {}).items() if part.startswith(start)]
                best = max([best, *found] if best else found, default=None)
                at = at.get(part) if part is not None else None
        return best and best[2:]


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with host, path, the rule that decides (null if none) and the verdict."""
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf(_FIELDS)
    def decide(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        match = trie.value.match
        return pd.DataFrame(
            [match(h, p) or (None, default) for h, p in zip(host, path, strict=True)],
            columns=["rule", "verdict"],
        )

    out = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    decided = f"{free_prefix(out)}decided"
    out = out.withColumn(decided, decide("host", "path"))
    return out.withColumns({"rule": F.col(f"{decided}.rule"), "verdict": F.col(f"{decided}.verdict")}).drop(decided)
