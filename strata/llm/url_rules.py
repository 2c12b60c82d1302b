"""URL filters by a sort-merge range join of reversed-host keys with nested rules.

A host's labels are turned round, ``www.example.org`` -> ``org.example.www.``,
so a rule's host and all its subdomains are one interval of keys: those that
start with the rule's key. URLs are range-partitioned and sorted by (key, path),
so a host with many URLs is spread over partitions. Each partition is swept
once, with the sorted rules beside it: rules whose interval begins are pushed on
a stack, those whose interval ended are popped, and what is on the stack are the
rules of the URL's host, each inside the one below. A rule's path must then begin
the URL's path; the longest rule wins, that is the one of most characters in
host and path (of equally long ones that of the longer host).

Rules are broadcast ``BLOCK_RULES`` at a time; more of them are swept in blocks,
so no broadcast grows with the rules. The match kept from block to block is
compared by the same order (length, host length, block before allow), so the
size of the blocks changes nothing.

Defined results: a null URL or one without ``://`` has empty host and path and no
rule. Without a rule the verdict is ``DEFAULT``. Repeated rows give one row each;
null ids stay null. A rule without host fits nothing; of rules with the same host
and path a block wins over an allow. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import lower_ascii, map_batches

BLOCK_RULES = 200_000
DEFAULT = "allow"
# The contract's rules: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path as the contract cuts them."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, parts, 1)), F.regexp_extract(text, parts, 2)


def reversed_host(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


class Sweep:
    """Rules met in the order of their intervals, for keys that come in ascending order."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        by_host: dict[str, dict[str, str]] = {}
        for host, path, verdict in rules:
            paths = by_host.setdefault(host, {})
            if paths.get(path) != "block":
                paths[path] = verdict
        # one interval a host, sorted by where it starts; of its paths the longest first
        self.intervals = sorted((reversed_host(h), h, sorted(p.items(), key=lambda x: -len(x[0])))
                                for h, p in by_host.items() if h)
        self.starts = [x[0] for x in self.intervals]
        self.next, self.stack = 0, []
        self.key = None

    def _enter(self, key: str) -> None:
        """Seek the intervals around the first key of a partition: its own prefixes."""
        self.next = bisect_right(self.starts, key)
        for end in (i + 1 for i, c in enumerate(key) if c == "."):
            at = bisect_right(self.starts, key[:end]) - 1
            if at >= 0 and self.starts[at] == key[:end]:
                self.stack.append(self.intervals[at])

    def match(self, key: str, path: str) -> tuple[str | None, str | None, int]:
        """The winning rule, its verdict and the length of its host."""
        if self.key is None:
            self._enter(key)
        elif key != self.key:
            while self.stack and not key.startswith(self.stack[-1][0]):
                self.stack.pop()
            while self.next < len(self.starts) and self.starts[self.next] <= key:
                if key.startswith(self.starts[self.next]):
                    self.stack.append(self.intervals[self.next])
                self.next += 1
        self.key = key
        best, verdict, size, length = None, None, -1, 0
        for _, host, paths in reversed(self.stack):
            for rule_path, rule_verdict in paths:
                if len(host) + len(rule_path) <= size:
                    break
                if path.startswith(rule_path):
                    best, verdict, size, length = host + rule_path, rule_verdict, len(host) + len(rule_path), len(host)
                    break
        return best, verdict, length


def _rank(found: tuple[str | None, str | None, int]) -> tuple[int, int, bool]:
    """The order of matches, the winner largest."""
    rule, verdict, host = found
    return (-1, 0, False) if rule is None else (len(rule), host, verdict == "block")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, default: str = DEFAULT,
          block_rules: int = BLOCK_RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    host, path = host_and_path(F.col("url"))
    cut = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    turned = F.concat(F.array_join(F.reverse(F.split("host", r"\.")), "."), F.lit("."))
    keyed = cut.select("page_id", "host", "path", turned.alias("key"),
                       F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("found"), F.lit(0).alias("rule_host"))
    ordered = keyed.repartitionByRange("key", "path", "page_id").sortWithinPartitions("key", "path")
    schema = "page_id long, host string, path string, key string, rule string, found string, rule_host int"
    rules = [(h.lower(), p, v) for h, p, v in rules]
    for start in range(0, max(len(rules), 1), block_rules):
        block = pages.sparkSession.sparkContext.broadcast(rules[start:start + block_rules])

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            sweep = Sweep(block.value)
            for batch in batches:
                paths, keys = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                old = zip(*(batch.column(c).to_pylist() for c in (4, 5, 6)), strict=True)
                found = [max(o, sweep.match(k, p), key=_rank) for k, p, o in zip(keys, paths, old, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:4], *(pa.array([f[c] for f in found], t) for c, t in enumerate((pa.string(), pa.string(), pa.int32())))],
                    names=batch.schema.names)

        ordered = map_batches(ordered, run, schema)  # keeps partitions and their order
    return ordered.select("page_id", "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict"))


ORACLE_SQL = r"""
WITH cut AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
         row_number() OVER () AS rid
  FROM pages),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (SELECT rid, h || p AS rule, v FROM cut JOIN rules
         ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
         QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(h || p) DESC, length(h) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM cut LEFT JOIN fits USING (rid)
"""
