"""URL filters as a sort-merge range join.

A host becomes its labels reversed, each closed by a dot (``a.example.net`` is ``net.example.a.``), so a host and
all its subdomains are one interval of keys: those that start with the rule host's key. Pages and rules are swept in the order of keys; the rules
whose interval is open at a key are nested and lie on a stack. Of the open rules whose path starts the url's path
the longest wins (host plus path; of equal length, the longer host, then ``block`` before ``allow``).

Rules are a list or a table (verdict, host, path). A list, and a table of at most ``SMALL`` rows, reaches every task, and pages are only sorted
within their partition, without a shuffle. A larger table is merged with the pages: both are dealt by range of (key, rule or page, page id), so
a host with many pages lies in several partitions; a partition also gets the rules that are open at its first key, found by a join on
the few prefixes of that key. A task holds the open rules: those of one host and of the domains above it.

Null urls and urls without ``://`` have an empty host and path, which no rule fits. Rules with a null part fit nothing; repeated rules are one.
Repeated pages get equal rows; columns of the pages other than the named ones aren't read.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.scratch import Scratch

SMALL = 100_000
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def key(self) -> str:
        return "".join(f"{x}." for x in reversed(self.host.split(".")))

    @property
    def rank(self) -> tuple:
        return (len(self.name), len(self.host), self.verdict == "block")


def parse_rule(verdict: str, pattern: str) -> UrlRule:
    """``example.net/en/``: the host up to the first slash, the path from there."""
    host, slash, path = pattern.partition("/")
    return UrlRule(verdict, host.translate(str.maketrans(_UP, _LOW)), slash + path)


def with_host_and_path(df: DataFrame, url_col: str) -> DataFrame:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(F.col(url_col), F.lit(""))
    return df.withColumns({"host": F.translate(F.regexp_extract(url, pattern, 1), _UP, _LOW), "path": F.regexp_extract(url, pattern, 2)})


class Open:
    """The rules of one key, by path."""

    def __init__(self, key: str):
        self.key = key
        self.by_path: dict[str, UrlRule] = {}
        self.sizes: list[int] = []

    def add(self, rule: UrlRule) -> None:
        old = self.by_path.get(rule.path)
        if old is None or rule.rank > old.rank:
            self.by_path[rule.path] = rule
        at = bisect_left(self.sizes, len(rule.path))
        if at == len(self.sizes) or self.sizes[at] != len(rule.path):
            self.sizes.insert(at, len(rule.path))

    def best(self, path: str) -> UrlRule | None:
        """That of the longest path which starts ``path``; one look for each length."""
        for n in reversed(self.sizes):
            if n <= len(path) and (r := self.by_path.get(path[:n])):
                return r
        return None


class Sweep:
    """Takes rules and pages in ascending order of keys, a key's rules before its pages."""

    def __init__(self):
        self.stack: list[Open] = []

    def _close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()

    def open(self, key: str, rule: UrlRule) -> None:
        self._close(key)
        if not self.stack or self.stack[-1].key != key:
            self.stack.append(Open(key))
        self.stack[-1].add(rule)

    def best(self, key: str, path: str) -> UrlRule | None:
        self._close(key)
        return max((r for o in self.stack if (r := o.best(path))), key=lambda r: r.rank, default=None)


class Merged:
    """A sweep over a sorted list of rules beside keys that come in ascending order, starting anywhere."""

    def __init__(self, rules: list[UrlRule]):
        self.rules = sorted(((r.key, r) for r in rules), key=lambda x: x[0])
        self.keys = [k for k, _ in self.rules]
        self.at, self.sweep = 0, None

    def best(self, key: str, path: str) -> UrlRule | None:
        if self.sweep is None:
            # Rules that began before the first key and still hold it come first.
            self.sweep = Sweep()
            self.at, i = bisect_left(self.keys, key), 0
            while (i := key.find(".", i) + 1) > 0:
                j = bisect_left(self.keys, key[:i])
                while j < self.at and self.keys[j] == key[:i]:
                    self.sweep.open(*self.rules[j])
                    j += 1
        while self.at < len(self.keys) and self.keys[self.at] <= key:
            # Only what holds this key can matter; later keys are greater.
            if key.startswith(self.keys[self.at]):
                self.sweep.open(*self.rules[self.at])
            self.at += 1
        return self.sweep.best(key, path)


def _key(host: Column) -> Column:
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, "[.]")), "."), F.lit(".")))


def filter_urls(df: DataFrame, rules: list[UrlRule] | DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", small: int = SMALL) -> DataFrame:
    """One row per input row: id, host, path, rule (null where none fits) and verdict."""
    kind = df.schema[id_col].dataType.simpleString()
    pages = with_host_and_path(df.select(F.col(id_col).alias("id"), F.col(url_col).alias("_url")), "_url").drop("_url").withColumn("key", _key(F.col("host")))
    if isinstance(rules, DataFrame):
        rules = rules.select("verdict", F.translate("host", _UP, _LOW).alias("host"), "path").where("verdict is not null and host != '' and path is not null").distinct()
        if rules.count() > small:
            out = _merge(pages, rules, kind, default)
            return out.withColumnRenamed("id", id_col)
        rules = [UrlRule(*r) for r in rules.collect()]
    swept = pages.select("id", "host", "path", "key").sortWithinPartitions("key").mapInArrow(_beside(list(rules), default), f"id {kind}, host string, path string, rule string, verdict string")
    return swept.withColumnRenamed("id", id_col)


def _result(ids: pa.Array, host: list, path: list, found: list[UrlRule | None], default: str) -> pa.RecordBatch:
    rule = pa.array([r.name if r else None for r in found], pa.string())
    verdict = pa.array([r.verdict if r else default for r in found], pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.array(host, pa.string()), pa.array(path, pa.string()), rule, verdict], names=["id", "host", "path", "rule", "verdict"])


def _beside(rules: list[UrlRule], default: str):
    def run(batches):
        merged = Merged(rules)
        for b in batches:
            host, path = b.column("host").to_pylist(), b.column("path").to_pylist()
            yield _result(b.column("id"), host, path, [merged.best(k, p) for k, p in zip(b.column("key").to_pylist(), path)], default)

    return run


def _merge(pages: DataFrame, rules: DataFrame, kind: str, default: str) -> DataFrame:
    """Both sides by range; see the module's text."""
    scratch = Scratch(pages.sparkSession, "urls")
    left = rules.select(F.lit(None).cast(kind).alias("id"), "host", "path", _key(F.col("host")).alias("key"), "verdict", F.lit(0).alias("page"), F.lit(0).cast("long").alias("salt"))
    right = pages.select("id", "host", "path", "key", F.lit(None).cast("string").alias("verdict"), F.lit(1).alias("page"), F.monotonically_increasing_id().alias("salt"))
    order = ["key", "page", "salt"]
    rows = left.unionByName(right).repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    rows = scratch.keep(rows.withColumn("at", F.monotonically_increasing_id()), "rows").withColumn("part", F.shiftright("at", 33))
    # One row a partition, then one for each label of its first key.
    firsts = rows.groupBy("part").agg(F.min(F.struct("at", "key")).alias("f"))
    labels = F.split("f.key", "[.]")
    prefixes = firsts.select(F.col("part").alias("to"), F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.array_join(F.slice(labels, F.lit(1), i), "."), F.lit(".")))).alias("key"))
    carried = rows.where("page = 0").join(prefixes.distinct(), "key").where("part < to")
    carried = carried.select("id", "host", "path", "key", "verdict", "page", F.lit(-1).cast("long").alias("at"), F.col("to").alias("part"))
    both = rows.select("id", "host", "path", "key", "verdict", "page", "at", "part").unionByName(carried)
    swept = both.repartition("part").sortWithinPartitions("part", "at", "key").mapInArrow(_sweep(default), f"id {kind}, host string, path string, rule string, verdict string")
    return swept


def _sweep(default: str):
    def run(batches):
        part, sweep = None, Sweep()
        for b in batches:
            host, path, found, pages = b.column("host").to_pylist(), b.column("path").to_pylist(), [], []
            rows = zip(b.column("part").to_pylist(), b.column("key").to_pylist(), b.column("page").to_pylist(), b.column("verdict").to_pylist())
            for i, (now, key, page, verdict) in enumerate(rows):
                if now != part:
                    part, sweep = now, Sweep()
                if page:
                    pages.append(i)
                    found.append(sweep.best(key, path[i]))
                else:
                    sweep.open(key, UrlRule(verdict, host[i], path[i]))
            yield _result(b.column("id").take(pa.array(pages, pa.int64())), [host[i] for i in pages], [path[i] for i in pages], found, default)

    return run
