"""Allow and block rules for URLs, held in cascades of Bloom filters.

A cascade answers exactly, without a join, whether a key is listed, for every key of a known
universe. Level 0 is a Bloom filter of the listed keys. Level 1 holds the keys of the universe
that level 0 takes for listed but are not, level 2 the listed keys that level 1 would take for
those, and so on until no key is mistaken. The first level that does not hold a key settles it.

The universe is every host suffix and path prefix of the corpus' own URLs that has the shape of a
rule; one job collects it. Level 0 is made so sharp that its mistakes are fewer than the listed
keys, and each further level halves what is left: all levels together take a few times
``log2(universe / listed)`` bits per listed key, so their size follows the list, not the corpus.
Lists beyond ``MAX_FILTERED`` rules are joined instead, with the same result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm.text import written

MAX_FILTERED = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    def __post_init__(self):
        if self.path and not self.path.startswith("/"):
            raise ValueError(f"the path of a rule starts with a slash: {self.path!r}")
        if self.verdict not in ("allow", "block"):
            raise ValueError(f"a verdict is allow or block: {self.verdict!r}")


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` are its bits, 64 to a word."""

    bits: int
    hashes: int
    seed: int
    words: tuple[int, ...]

    def places(self, key: Column) -> list[Column]:
        return [
            F.pmod(F.xxhash64(key, F.lit(self.seed + i)), F.lit(self.bits))
            for i in range(self.hashes)
        ]

    def holds(self, key: Column) -> Column:
        words = F.expr(f"cast(split('{','.join(map(str, self.words))}', ',') as array<bigint>)")
        found = F.lit(True)
        for place in self.places(key):
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            found = found & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
        return found


def _level(keys: DataFrame, n_keys: int, false_rate: float, seed: int) -> Level:
    """The filter of the column ``key``; the bits are set by one small aggregation."""
    hashes = max(1, round(-math.log2(false_rate)))
    bits = max(64, math.ceil(n_keys * hashes / math.log(2)))
    empty = Level(bits, hashes, seed, ())
    place = F.explode(F.array(*empty.places(F.col("key")))).alias("place")
    rows = (
        keys.select(place)
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(
            F.expr("bit_or(shiftleft(1L, cast(pmod(place, 64) as int)))").alias("set")
        )
        .collect()
    )
    words = [0] * ((bits + 63) // 64)
    for row in rows:
        words[row["word"]] = row["set"]
    return Level(bits, hashes, seed, tuple(words))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    @staticmethod
    def build(spark: SparkSession, listed: DataFrame, universe: DataFrame) -> "Cascade":
        """Both have distinct keys in a column ``key``; ``universe`` may hold listed keys too."""
        n_listed = listed.count()
        if n_listed == 0:
            return Cascade(())
        others = max(1, universe.count())
        level = _level(listed, n_listed, min(0.5, math.sqrt(0.5) * n_listed / others), seed=0)
        levels = [level]
        inside = written(spark, listed.select("key"), "cascade-listed")
        outside = written(
            spark,
            universe.where(level.holds(F.col("key"))).join(listed, "key", "left_anti"),
            "cascade-mistaken",
        )
        while n_mistaken := outside.count():
            level = _level(outside, n_mistaken, 0.5, seed=1000 * len(levels))
            levels.append(level)
            inside, outside = outside, written(
                spark, inside.where(level.holds(F.col("key"))), "cascade-mistaken"
            )
        return Cascade(tuple(levels))

    def lists(self, key: Column) -> Column:
        """Whether ``key`` is listed, right for every key of the universe."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            answer = F.when(self.levels[depth].holds(key), answer).otherwise(F.lit(depth % 2 == 1))
        return answer


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _shapes(rules: Iterable[UrlRule]) -> list[tuple[int, int]]:
    return sorted({(rule.host.count(".") + 1, len(rule.path)) for rule in rules})


def _key(shape: tuple[int, int]) -> Column:
    """The key of a host and path in the shape of a rule: so many labels, so much of the path."""
    labels, length = shape
    host, path = F.col("host"), F.col("path")
    fits = (F.length(path) >= length) & (
        F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) >= labels - 1
    )
    return F.when(
        fits, F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length))
    )


def rule_table(spark: SparkSession, rules: Iterable[UrlRule]) -> DataFrame:
    """Distinct ``key, verdict``; a key with both verdicts is blocked."""
    rows = {}
    for rule in rules:
        key = rule.host + rule.path
        rows[key] = "block" if "block" in (rows.get(key), rule.verdict) else "allow"
    quoted = [F.struct(F.lit(k).alias("key"), F.lit(v).alias("verdict")) for k, v in rows.items()]
    one = spark.range(1)
    if not quoted:
        return one.select(F.lit("").alias("key"), F.lit("").alias("verdict")).where("false")
    return one.select(F.inline(F.array(*quoted)))


def filter_urls(
    pages: DataFrame,
    rules: Iterable[UrlRule],
    url: str = "url",
    default: str = "allow",
    max_filtered: int = MAX_FILTERED,
) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; columns of those names are replaced.

    A rule fits its host and all subdomains where the path starts with the rule's. The longest
    rule that fits decides, the text of host and path together being its length; without one the
    rule is null and the verdict ``default``: a URL that the cascades do not list. Null URLs and
    texts without ``://`` have an empty host and path, which fit no rule.
    """
    spark, rules = pages.sparkSession, list(rules)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    split = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    table = rule_table(spark, rules)
    shapes = _shapes(rules)
    if not shapes:
        best = F.lit(None).cast("struct<size:int,key:string,verdict:string>")
    elif len(rules) > max_filtered:
        return _by_join(split, table, shapes, default)
    else:
        universe = written(
            spark,
            split.select(F.explode(F.array(*[_key(s) for s in shapes])).alias("key"))
            .where("key is not null")
            .distinct(),
            "url-keys",
        )
        found = []
        for verdict in ("allow", "block"):
            listed = table.where(F.col("verdict") == verdict).select("key")
            cascade = Cascade.build(spark, listed, universe)
            found += [
                F.when(
                    cascade.lists(_key(s)),
                    F.struct(
                        F.length(_key(s)).alias("size"),
                        _key(s).alias("key"),
                        F.lit(verdict).alias("verdict"),
                    ),
                )
                for s in shapes
            ]
        best = F.array_max(F.array(*found))
    return _decided(split.withColumn("_best", best), default)


def _by_join(split: DataFrame, table: DataFrame, shapes, default: str) -> DataFrame:
    found = []
    for i, shape in enumerate(shapes):
        side = table.select(F.col("key").alias(f"_key{i}"), F.col("verdict").alias(f"_verdict{i}"))
        split = split.join(side, _key(shape) == F.col(f"_key{i}"), "left")
        found.append(
            F.when(
                F.col(f"_key{i}").isNotNull(),
                F.struct(
                    F.length(f"_key{i}").alias("size"),
                    F.col(f"_key{i}").alias("key"),
                    F.col(f"_verdict{i}").alias("verdict"),
                ),
            )
        )
    best = F.array_max(F.array(*found))
    drop = [f"_{kind}{i}" for i in range(len(shapes)) for kind in ("key", "verdict")]
    return _decided(split.withColumn("_best", best).drop(*drop), default)


def _decided(df: DataFrame, default: str) -> DataFrame:
    return (
        df.withColumn("rule", F.col("_best")["key"])
        .withColumn("verdict", F.coalesce(F.col("_best")["verdict"], F.lit(default)))
        .drop("_best")
    )
