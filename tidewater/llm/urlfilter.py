"""URL filter: allow and block entries in one trie, the longest matching entry decides.

An entry is (verdict, host, path).  It fits its host and all subdomains, if the URL's path
starts with the entry's path.  The trie branches on host labels from the right, then on
path segments from the left; the last, possibly unfinished, segment of an entry's path is
matched as a prefix.  The longest entry (host plus path, then host) wins; when one entry is
listed as allow and as block, block wins.  URLs that no entry fits get ``default``.

Bound: the entries are an argument, not a table, and are broadcast; more than
``MAX_RULES`` raise ValueError.

Edge cases: a null URL or one without ``://`` has an empty host and path and fits no entry.
Very long URLs are matched whole.  Repeated rows are judged each, extra columns play no part.
Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F

MAX_RULES = 1_000_000
MATCH = "host string, path string, rule string, verdict string"

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HOST_PATH = re.compile(r"([^/?#]*)([^?#]*)")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    host, path = _HOST_PATH.match(rest).groups()
    return host.translate(_UPPER), path


def build_trie(rules) -> dict:
    """Host trie; a node's "paths" is the trie of its path segments, where "ends" maps an
    unfinished last segment to (rule text, verdict) and "rule" is an entry without a path."""
    root: dict = {"next": {}}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block") or not host or (path and path[0] != "/"):
            raise ValueError(f"not a rule: {(verdict, host, path)}")
        node = root
        for label in reversed(host.split(".")):
            node = node["next"].setdefault(label, {"next": {}})
        if path:
            node = node.setdefault("paths", {"next": {}})
            *whole, last = path[1:].split("/")
            for segment in whole:
                node = node["next"].setdefault(segment, {"next": {}})
            slot, key = node.setdefault("ends", {}), last
        else:
            slot, key = node, "rule"
        if key not in slot or verdict == "block":
            slot[key] = (host + path, verdict)
    return root


def path_matches(node: dict, path: str) -> Iterator[tuple[str, str]]:
    for segment in path[1:].split("/"):
        if ends := node.get("ends"):
            for k in range(min(len(segment), ends_length(node)), -1, -1):
                if segment[:k] in ends:
                    yield ends[segment[:k]]
                    break
        node = node["next"].get(segment)
        if node is None:
            return


def ends_length(node: dict) -> int:
    if "longest" not in node:
        node["longest"] = max(map(len, node["ends"]))
    return node["longest"]


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """The longest entry that fits, as (rule text, verdict)."""
    best, node = None, trie
    for label in reversed(host.split(".")):
        node = node["next"].get(label)
        if node is None:
            break
        found = [node["rule"]] if "rule" in node else []
        if path and "paths" in node:
            found += path_matches(node["paths"], path)
        for entry in found:  # longer hosts come later, so >= prefers them
            if best is None or len(entry[0]) >= len(best[0]):
                best = entry
    return best


def url_verdict(spark: SparkSession, url: Column, rules, default: str = "allow") -> Column:
    """A struct per URL: host, path, the deciding rule (null if none) and the verdict."""
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; a broadcast trie takes {MAX_RULES}")
    shared = spark.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf(MATCH)
    def verdicts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trie = shared.value
        for urls in batches:
            rows = []
            for url in urls:
                host, path = split_url(url)
                rows.append((host, path, *(match(trie, host, path) or (None, default))))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    return verdicts(url)
