"""Operator 8, URL filters: a sort-merge range join of hosts with nested prefix rules, in DataFrame functions only.

A host becomes a canonical key, its labels reversed and each ended by a dot (`a.example.org` -> `org.example.a.`), so
the hosts below a rule's host are one interval of keys and such intervals nest or lie apart. Rule hosts and urls are sorted
together by key; the last rule host met on the way down carries the stack of rule hosts it is nested in, and those that
still hold at the url's key are the url's. The same goes on with paths among the rules of each such host: they are
intervals of paths, nested or apart; the last one met carries the stack of those it is nested in, and the longest that
still holds is the host's rule. Of a url's hosts the longest rule wins.

Distinct pairs of host and path are swept, salted over all partitions, each of which sweeps all rules: a host with a
third of all pages is no hot key. A stack is as deep as labels or characters nest, so rules take room in proportion to
their length; they come from the driver as a list and are repeated for each partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host.translate(str.maketrans(UPPER, LOWER)), slash + path)


def host_key(host: str) -> str:
    return "".join(f"{label}." for label in reversed(host.split(".")))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path as columns: both empty for a null url or one without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.translate(authority, UPPER, LOWER)
    path = F.regexp_extract(F.substring(rest, F.length(authority) + F.lit(1), F.length(rest)), r"(?s)^[^?#]*", 0)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def nested(keys: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
    """In the order in which Spark sorts them each of keys and the lengths of those of keys that it begins with, itself last."""
    stack: list[str] = []
    for key in sorted(keys, key=str.encode):
        while stack and not key.startswith(stack[-1]):
            stack.pop()
        stack.append(key)
        yield key, [len(k) for k in stack]


def host_stacks(rules: list[Rule]) -> list[tuple[str, list[int]]]:
    """Each rule host's key and the lengths of the keys of the rule hosts that it is nested in, with its own."""
    return list(nested({host_key(r.host) for r in rules}))


def path_stacks(rules: list[Rule]) -> list[tuple[str, str, list[int]]]:
    """Key of a host, path of one of its rules, and the lengths of the paths of its rules that begin this path."""
    own: dict[str, set[str]] = {}
    for r in rules:
        own.setdefault(host_key(r.host), set()).add(r.path)
    return [(key, path, lengths) for key, paths in own.items() for path, lengths in nested(paths)]


def named(rules: list[Rule]) -> list[tuple[str, str, str, str]]:
    """Key of the host, path, text and verdict of each rule; of rules with the same text the first given stands."""
    found: dict[tuple[str, str], tuple[str, str]] = {}
    for r in rules:
        found.setdefault((host_key(r.host), r.path), (r.text, r.verdict))
    return [(*place, *rule) for place, rule in found.items()]


def swept(points: DataFrame, marks: DataFrame, within: list[str], by: str) -> DataFrame:
    """points with `holding`: the lengths of the marks (by, stack) that begin their `by`, among those of equal `within`.

    In the order of `by` the last mark at or before a point is the only one to ask. marks are repeated for each salt.
    """
    salts = common.parts(points.sparkSession)
    marks = marks.withColumns({"mark": F.struct(F.col(by).alias("key"), "stack"), "point": F.lit(False)}).drop("stack")
    marks = marks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    both = points.withColumn("point", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    w = Window.partitionBy(*within, "salt").orderBy(by, "point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last("mark", ignorenulls=True).over(w)
    rows = both.withColumn("mark", last).filter("point and mark is not null")
    begins = F.filter("mark.stack", lambda n: F.substring(F.col(by), F.lit(1), n) == F.substring(F.col("mark.key"), F.lit(1), n))
    return rows.withColumn("holding", begins).filter(F.size("holding") > 0).drop("mark", "point")


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """Adds host, path, rule (text of the longest that fits, else null) and verdict to every row.

    A url that is null or has no `://` has empty host and path and gets the default. Repeated rows are judged each; with
    no rules all rows get the default. Of rules as long as each other the first in alphabetical order wins. Columns of
    these names that pages already has are replaced.
    """
    spark = pages.sparkSession
    host, path = split_url(F.col("url"))
    rows = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    key = F.concat(F.array_join(F.reverse(F.split("host", r"\.")), "."), F.lit("."))
    salt = F.pmod(F.xxhash64("host", "path"), F.lit(common.parts(spark))).cast("int")
    points = rows.select("host", "path").distinct().select("host", "path", key.alias("key"), salt.alias("salt"))
    points = swept(points, spark.createDataFrame(host_stacks(rules), "key string, stack array<int>"), [], "key")
    points = points.select("host", "path", "key", "salt", F.explode("holding").alias("n"))
    points = points.select("host", "path", "salt", F.substring("key", F.lit(1), F.col("n")).alias("at"))
    points = swept(points, spark.createDataFrame(path_stacks(rules), "at string, path string, stack array<int>"), ["at"], "path")
    best = F.substring("path", F.lit(1), F.array_max("holding")).alias("begin")
    texts = spark.createDataFrame(named(rules), "at string, begin string, text string, verdict string")
    points = points.select("host", "path", "at", best).join(texts, ["at", "begin"])
    longest = F.min(F.struct(-F.length("text"), "text", "verdict")).alias("best")
    found = points.groupBy("host", "path").agg(longest).select("host", "path", "best.text", "best.verdict")
    found = found.toDF("_kindred_host", "_kindred_path", "_kindred_rule", "_kindred_verdict")
    same = (F.col("host") == F.col("_kindred_host")) & (F.col("path") == F.col("_kindred_path"))
    return rows.join(found, same, "left").select(
        *rows.columns, F.col("_kindred_rule").alias("rule"), F.coalesce("_kindred_verdict", F.lit(default)).alias("verdict")
    )
