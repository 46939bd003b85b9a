"""URL filters as a sort-merge range join of canonical host keys with nested rules.

A host is reversed label by label (``a.example.net`` is ``net.example.a.``), so a rule for a host and all its subdomains is
the interval of keys that start with the rule's key. Urls are sorted by key inside each partition and swept once together with
the sorted hosts of rules; a stack holds the hosts whose interval is open, every one nested in the one below, and lives on from batch to
batch. From the innermost host on, the longest path that begins the url's path decides. The paths of a host are sorted too, and
each knows the longest other one that it starts with, so a search costs a bisection and the nesting depth.

A partition sweeps on its own, so pages are not shuffled and a host that holds a third of them stays spread as it was read.
The rules are broadcast, behind a check of their number and bytes. Beyond it pages are placed in ranges of key, a hot host in several, and each
range gets the sorted rules whose intervals meet it: its own, and those open where it begins. The sweep then reads rules and urls as one
sorted stream and holds the stack alone, that is, the rules of one host and of the hosts above it.

Edge cases: a url that is null or has no ``://`` has empty host and path; it fits a rule only if the rule's host is empty too.
Pages without a fitting rule get the default verdict. Rules with a null host, path or verdict are ignored; of equal rules
the verdict that sorts first holds. Repeated pages each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.scratch import Tables

#: (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DEFAULT = "allow"
MAX_BROADCAST, MAX_BROADCAST_BYTES = 100_000, 32 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: str) -> Column:
    at = F.locate("://", F.col(url))
    return F.when(at > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)"))


def url_host(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: str) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


class HostRules:
    """The rules of one host key: sorted paths, the rules' numbers (or what stands for them), and for each path the longest other one that begins it (or -1)."""

    def __init__(self, key: str, rules: list[tuple[str, int]]) -> None:
        self.key = key
        self.paths = [path for path, _ in rules]
        self.numbers = [number for _, number in rules]
        self.outer, nested = [], []
        for i, path in enumerate(self.paths):
            while nested and not path.startswith(self.paths[nested[-1]]):
                nested.pop()
            self.outer.append(nested[-1] if nested else -1)
            nested.append(i)

    def find(self, path: str) -> int:
        """The number of the rule with the longest path that begins ``path``, or -1."""
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.outer[i]
        return self.numbers[i] if i >= 0 else -1


def by_host(rules: list[tuple[str, str]]) -> list[HostRules]:
    """Host rules in order of key from (key, path) of each rule."""
    placed: dict[str, list[tuple[str, int]]] = {}
    for number, (key, path) in enumerate(rules):
        placed.setdefault(key, []).append((path, number))
    return [HostRules(key, sorted(placed[key])) for key in sorted(placed)]


class Sweep:
    """One pass over sorted url keys and sorted host rules."""

    def __init__(self, hosts: list[HostRules]) -> None:
        self.hosts, self.stack, self.following = hosts, [], 0

    def winners(self, keys: list[str], paths: list[str]) -> list[int]:
        """The number of the winning rule of each url, or -1; keys must not sort before those of earlier calls."""
        out, stack, hosts = [], self.stack, self.hosts
        for key, path in zip(keys, paths, strict=True):
            while self.following < len(hosts) and hosts[self.following].key <= key:
                while stack and not hosts[self.following].key.startswith(stack[-1].key):
                    stack.pop()
                stack.append(hosts[self.following])
                self.following += 1
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            out.append(next((found for host in reversed(stack) if (found := host.find(path)) >= 0), -1))
        return out


class StreamSweep:
    """The same sweep over one sorted stream of a range's rules and urls, rules before urls of the same key."""

    def __init__(self) -> None:
        self.part, self.stack, self.key, self.rules = None, [], None, []

    def start(self, part: int) -> None:
        """Forget the range before, if ``part`` is another."""
        if part != self.part:
            self.part, self.stack, self.key, self.rules = part, [], None, []

    def add(self, key: str, path: str, rule: tuple[str, str]) -> None:
        """A rule; those of one host follow each other, in order of path."""
        if key != self.key:
            self._push()
            self.key = key
        self.rules.append((path, rule))

    def _push(self) -> None:
        if self.rules:
            while self.stack and not self.key.startswith(self.stack[-1].key):
                self.stack.pop()
            self.stack.append(HostRules(self.key, self.rules))
            self.rules = []

    def winner(self, key: str, path: str) -> tuple[str, str] | None:
        """Name and verdict of the winning rule of a url."""
        self._push()
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()
        return next((found for host in reversed(self.stack) if (found := host.find(path)) != -1), None)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """page id, host, path, rule (host and path of the winning rule, else null) and verdict of every page.

    ``rules`` has verdict, host and path. The longest fitting rule wins: the longest host, then the longest path. More than
    ``max_broadcast`` rules, or than ``MAX_BROADCAST_BYTES`` of their text, are swept by ranges; the result is the same.
    """
    usable = rules.where("verdict is not null and host is not null and path is not null").groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    parsed = pages.select(F.col(id_col).alias("page"), url_host(url_col).alias("host"), url_path(url_col).alias("path")).withColumn("key", host_key(F.col("host")))
    size = usable.agg(F.count("*").alias("n"), F.sum(F.octet_length("host") + F.octet_length("path") + F.octet_length("verdict")).alias("bytes")).first()
    swept = _by_ranges(parsed, usable, default) if size.n > max_broadcast or (size["bytes"] or 0) > MAX_BROADCAST_BYTES else _by_partitions(parsed, usable, default)
    return swept.withColumnRenamed("page", id_col)


def _schema(parsed: DataFrame) -> str:
    return f"page {parsed.schema['page'].dataType.simpleString()}, host string, path string, rule string, verdict string"


def _judged(pages: pa.RecordBatch, won: list[tuple[str, str] | None], default: str) -> pa.RecordBatch:
    rule = pa.array([w and w[0] for w in won], pa.string())
    verdict = pa.array([w[1] if w else default for w in won], pa.string())
    return pa.RecordBatch.from_arrays([*(pages.column(c) for c in ("page", "host", "path")), rule, verdict], ["page", "host", "path", "rule", "verdict"])


def _by_partitions(parsed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """All rules swept with each partition of the pages as it was read."""
    found = rules.collect()  # of checked size
    # Python orders text by code point, which is the order of Spark's UTF-8 strings.
    shared = parsed.sparkSession.sparkContext.broadcast((by_host([(_key(r.host), r.path) for r in found]), [(r.host + r.path, r.verdict) for r in found]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts, named = shared.value
        sweep = Sweep(hosts)
        for batch in batches:
            won = sweep.winners(batch.column("key").to_pylist(), batch.column("path").to_pylist())
            yield _judged(batch, [named[i] if i >= 0 else None for i in won], default)

    return parsed.sortWithinPartitions("key").mapInArrow(run, _schema(parsed))


def _by_ranges(parsed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """Pages in ranges of key, each swept with the rules whose intervals meet it."""
    spark = parsed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = parsed.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, "key", "_row").drop("_row")  # a hot key lies in several ranges
    placed = Tables(spark, "urlrules").written(spread.withColumn("part", F.spark_partition_id()), "pages")
    ranges = sorted(tuple(r) for r in placed.groupBy("part").agg(F.min("key"), F.max("key")).collect())  # a row for each range
    shared = spark.sparkContext.broadcast(ranges)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, lows, highs = zip(*shared.value, strict=True) if shared.value else ((), (), ())
        for batch in batches:
            rows, met = [], []
            for row, key in enumerate(batch.column("key").to_pylist()):
                i = bisect_left(highs, key)
                while i < len(lows) and (lows[i] <= key or lows[i].startswith(key)):
                    rows.append(row)
                    met.append(numbers[i])
                    i += 1
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(met, pa.int32())], [*batch.schema.names, "part"])

    keyed = rules.select(host_key(F.col("host")).alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict")
    dealt = keyed.mapInArrow(deal, "key string, path string, rule string, verdict string, part int")
    both = dealt.withColumn("side", F.lit(0)).unionByName(placed.withColumn("side", F.lit(1)), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = StreamSweep()
        for batch in batches:
            won = []
            columns = (batch.column(c).to_pylist() for c in ("part", "side", "key", "path", "rule", "verdict"))
            for part, side, key, path, rule, verdict in zip(*columns, strict=True):
                sweep.start(part)
                if side:
                    won.append(sweep.winner(key, path))
                else:
                    sweep.add(key, path, (rule, verdict))
            yield _judged(batch.filter(pc.equal(batch.column("side"), 1)), won, default)

    return both.repartition(parts, "part").sortWithinPartitions("part", "key", "side", "path").mapInArrow(run, _schema(parsed))
