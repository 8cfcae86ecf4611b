"""URL filters: a trie over reversed host labels and path segments, with the longest fitting entry deciding.

Entries come as a list of the caller or as a table. A table is read in parts of at most ENTRIES_PER_TRIE entries (its
rows dealt by hash), one trie is broadcast per part, and the longest fit over all parts counts, so the entries may be of
any number and no broadcast is larger than its bound.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binoscope.llm.text import free_name

ENTRIES_PER_TRIE = 500_000
# The entries of the registered query.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DEFAULT = "allow"

FIT = "struct<labels:int,length:int,rule:string,verdict:string>"


class Fit(NamedTuple):
    """The order of entries: more host labels first, then the longer path; block before allow on a tie."""
    labels: int
    length: int
    rule: str
    verdict: str


class Node:
    __slots__ = ("below", "paths", "ends")

    def __init__(self):
        self.below: dict[str, Node] = {}
        self.paths: Node | None = None
        self.ends: list[tuple[str, Fit]] = []       # what the next segment must begin with, and the entry


class Trie:
    def __init__(self, entries: Iterable[tuple[str, str, str]]):
        self.root = Node()
        for host, path, verdict in entries:
            node, labels = self.root, host.translate(LOWERED).split(".")
            for label in reversed(labels):
                node = node.below.setdefault(label, Node())
            node.paths = node.paths or Node()
            node, *segments = node.paths, *path.split("/")
            for segment in segments[:-1]:
                node = node.below.setdefault(segment, Node())
            node.ends.append((segments[-1], Fit(len(labels), len(path), host + path, verdict)))

    def fit(self, host: str, path: str) -> Fit | None:
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            place = node.paths
            for segment in segments if place else ():
                for start, entry in place.ends:
                    if segment.startswith(start) and (best is None or _order(entry) > _order(best)):
                        best = entry
                place = place.below.get(segment)
                if place is None:
                    break
        return best


LOWERED = {c: c + 32 for c in range(65, 91)}


def _order(entry: Fit) -> tuple[int, int, bool, str]:
    return entry.labels, entry.length, entry.verdict == "block", entry.rule


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without :// or url."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _parts(entries: DataFrame) -> Iterable[list[tuple[str, str, str]]]:
    """A table's distinct, complete entries in parts of about ENTRIES_PER_TRIE."""
    own = entries.select("host", "path", "verdict").dropna().distinct()
    parts = own.count() // ENTRIES_PER_TRIE + 1
    for part in range(parts):
        yield [tuple(r) for r in own.where(F.pmod(F.xxhash64("host", "path", "verdict"), F.lit(parts)) == part).toLocalIterator()]


def _fitter(shared: Broadcast):
    @F.pandas_udf(FIT)
    def fit(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        trie = shared.value
        found = [(trie.fit(h, p) if h else None) or (None,) * 4 for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=Fit._fields).astype({"labels": "Int32", "length": "Int32", "rule": object, "verdict": object})
    return fit


def filter_urls(pages: DataFrame, entries: DataFrame | list[tuple[str, str, str]] = RULES, id: str = "page_id", url: str = "url",
                default: str = DEFAULT) -> DataFrame:
    """One row per page: id, host, path, rule (like "net/", else null), verdict (of the rule, else `default`).

    An entry (host, path, allow or block) fits its host and all subdomains where the path starts with the entry's. More
    host labels win, then the longer path, then block. Null urls and urls without :// have an empty host and path and
    fit nothing, as an empty host fits no entry; without entries all pages get the default. Repeated rows give repeated
    results; other columns are not read.
    """
    context = pages.sparkSession.sparkContext
    best = free_name(pages, "fit")
    out = pages.select(id, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.lit(None).cast(FIT).alias(best))
    for part in _parts(entries) if isinstance(entries, DataFrame) else [entries]:
        shared = context.broadcast(Trie(part))

        def order(c: Column) -> Column:
            return F.struct(c["labels"], c["length"], c["verdict"] == "block", c["rule"])
        new = free_name(out, "found")
        out = out.withColumn(new, _fitter(shared)("host", "path"))
        better = F.col(new)["rule"].isNotNull() & (F.col(best)["rule"].isNull() | (order(F.col(new)) > order(F.col(best))))
        out = out.withColumn(best, F.when(better, F.col(new)).otherwise(F.col(best))).drop(new)
    return out.select(id, "host", "path", F.col(best)["rule"].alias("rule"), F.coalesce(F.col(best)["verdict"], F.lit(default)).alias("verdict"))


def keep_allowed(pages: DataFrame, entries: DataFrame | list[tuple[str, str, str]] = RULES, id: str = "page_id", url: str = "url") -> DataFrame:
    """The ids of pages that no block entry decides."""
    return filter_urls(pages, entries, id, url).where(F.col("verdict") == "allow").select(id)
