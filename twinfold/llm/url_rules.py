"""Url rules as a sort-merge range join.

A host is keyed by its labels in reverse, each closed by a low separator, so that a rule's
host and all its subdomains are one interval of keys, and the intervals of two rules
are nested or apart.  Pages are range-partitioned and sorted by key, then path, so a host
with a third of all pages is spread over many tasks; a sweep over the sorted keys keeps
the stack of rules whose interval is open.  The path is looked up among the rules on the
stack.

Rules are handed to the tasks in blocks of at most ``BLOCK_RULES``; more rules mean more
sweeps over the sorted pages, each of which keeps the longer of two fitting rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import ascii_lower
from twinfold.llm.urls import host_of, path_of, reversed_host
from twinfold.session import stage

CLOSE = "\x01"
BLOCK_RULES = 100_000

Rule = tuple[str, str, str]  # host, path, verdict


def _key(host: str) -> str:
    return CLOSE.join(reversed(host.split("."))) + CLOSE


class _Host:
    """The rules of one host as an interval of keys."""

    def __init__(self, host: str):
        self.host, self.low = host, _key(host)
        self.high = self.low[:-1] + chr(ord(CLOSE) + 1)
        self.paths: dict[str, str] = {}

    def close(self) -> _Host:
        self.lengths = sorted({len(p) for p in self.paths}, reverse=True)
        return self

    def fits(self, host: str, path: str) -> tuple[int, int, str, str] | None:
        """(length of the rule, of its host, rule, verdict) of its longest path that fits."""
        if host != self.host and not host.endswith("." + self.host):
            return None  # a host with the separator in a label
        for n in self.lengths:
            if n <= len(path) and path[:n] in self.paths:
                return len(self.host) + n, len(self.host), self.host + path[:n], self.paths[path[:n]]
        return None


def _intervals(rules: list[Rule]) -> list[_Host]:
    hosts: dict[str, _Host] = {}
    for host, path, verdict in rules:
        paths = hosts.setdefault(host, _Host(host)).paths
        # Of two verdicts on one rule the stricter counts.
        paths[path] = "block" if "block" in (verdict, paths.get(path)) else verdict
    return sorted((h.close() for h in hosts.values()), key=lambda h: h.low)


def _sweep(rules: list[Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        intervals, at = _intervals(rules), 0
        stack: list[_Host] = []
        last = None
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("url_key", "host", "path", "weight", "rule", "verdict")}
            for i, (key, host, path) in enumerate(zip(columns["url_key"], columns["host"], columns["path"])):
                if key != last:
                    while stack and key >= stack[-1].high:
                        stack.pop()
                    while at < len(intervals) and intervals[at].low <= key:
                        if key < intervals[at].high:
                            stack.append(intervals[at])
                        at += 1
                    last = key
                best = columns["weight"][i]
                for open_host in stack:
                    found = open_host.fits(host, path)
                    if found and (best is None or (found[0] << 32 | found[1]) > best):
                        best = found[0] << 32 | found[1]
                        columns["rule"][i], columns["verdict"][i] = found[2:]
                columns["weight"][i] = best
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("host"),
                    batch.column("path"),
                    batch.column("url_key"),
                    pa.array(columns["weight"], pa.int64()),
                    pa.array(columns["rule"], pa.string()),
                    pa.array(columns["verdict"], pa.string()),
                ],
                names=["page_id", "host", "path", "url_key", "weight", "rule", "verdict"],
            )

    return run


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict`` (allow or block); of hosts, A-Z is lower-cased.  A rule fits its host and all
    subdomains where the path starts with its own; the longest (host and path, then host)
    wins, of two verdicts on one rule ``block``; pages without a rule get ``default``.  Rules
    with a null or an empty host are left out, a null path is empty.  A null url, or one
    without ``://``, has an empty host and path, which no rule fits.  Repeated rows are
    judged each.  Other columns are not read.
    """
    rules = stage(
        rules.where("host <> ''").select(
            ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
        )
    )
    blocks = max(1, -(-rules.count() // BLOCK_RULES))
    columns = "page_id long, host string, path string, url_key string, weight long, rule string, verdict string"
    keyed = (
        pages.select(
            F.col("page_id").cast("long").alias("page_id"),
            host_of(F.col("url")).alias("host"),
            path_of(F.col("url")).alias("path"),
        )
        .withColumn("url_key", reversed_host(F.col("host"), CLOSE))
        .withColumns(
            {n: F.lit(None).cast(t) for n, t in (("weight", "long"), ("rule", "string"), ("verdict", "string"))}
        )
    )
    swept = stage(keyed).repartitionByRange("url_key", "path", "page_id").sortWithinPartitions("url_key")
    block_of = F.pmod(F.xxhash64("host", "path"), F.lit(blocks))
    for block in range(blocks):
        rows = [tuple(r) for r in rules.where(block_of == block).collect()]
        swept = swept.mapInArrow(_sweep(rows), columns)
    return swept.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
