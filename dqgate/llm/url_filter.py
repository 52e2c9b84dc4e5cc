"""URL verdicts by rules and by a cascade of Bloom filters.

The cascade gives exact membership of hosts in a list, for every key of the universe it is
built over, which is all hosts of the table and their parent domains. Level 0 encodes the
listed keys; each further level encodes the keys of the other kind that pass the level
before it by mistake, until none does. A key's answer is the parity of the first
level that it fails. The levels go to the tasks as a constant of the plan: one scalar
whose size follows from the number of listed keys and is checked against `MAX_BYTES`; a
longer list is matched by a join of the distinct hosts instead.

Defined results: a null url, or one without `://`, has an empty host and path, no rule and
verdict allow. Repeated rows are judged each for itself. An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqgate.llm.common import let, text_or_empty, written

BITS_PER_KEY = 10
HASHES = 4
# Largest cascade that is sent to the tasks.
MAX_BYTES = 16 * 1024 * 1024


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
# Names of advertising and abuse domains; a domain is listed if its last label before
# the registry is one of these.
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(text_or_empty(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(text_or_empty(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    found = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        row = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, row) if found is None else found.when(fits, row)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def parents(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    return let(
        F.split(host, r"\."),
        lambda labels: F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
        ),
    )


# ---- cascade -----------------------------------------------------------------


def _places(key: Column, level: int, n_bits: int) -> list[Column]:
    """Bit numbers of a key, by double hashing."""
    one, two = F.xxhash64(F.lit(2 * level), key), F.xxhash64(F.lit(2 * level + 1), key)
    return [
        F.pmod(F.pmod(one, F.lit(n_bits)) + k * F.pmod(two, F.lit(n_bits)), F.lit(n_bits)) for k in range(HASHES)
    ]


def _filter(keys: DataFrame, level: int, n_bits: int) -> DataFrame:
    """One row with the level's bits as an array of 64-bit words."""
    places = keys.select(F.explode(F.array(*_places(F.col("key"), level, n_bits))).alias("bit"))
    bit = F.expr("shiftleft(CAST(1 AS BIGINT), CAST(bit % 64 AS INT))")
    used = places.select(F.floor(F.col("bit") / 64).alias("word"), bit.alias("bits"))
    # Words without a bit are rows like the others, so the array is one sorted collect.
    every = keys.sparkSession.range(n_bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    whole = used.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))


def _passes(key: Column, level: int, n_bits: int, words: Column) -> Column:
    hit = lambda p: F.get(words, F.floor(p / 64).cast("int")).bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(p, F.lit(64)).cast("int"))
    ) != F.lit(0)
    return reduce(and_, [hit(p) for p in _places(key, level, n_bits)])


@dataclass(frozen=True)
class Level:
    n_bits: int
    words: DataFrame


def build_cascade(universe: DataFrame, listed: DataFrame) -> list[Level] | None:
    """Levels over distinct `key`s, or None if the first would exceed `MAX_BYTES`.

    Keys of `listed` outside the universe need no encoding.
    """
    marked = universe.select("key").distinct().join(
        listed.select("key").distinct().withColumn("is_listed", F.lit(True)), "key", "left"
    )
    marked = written(marked.select("key", F.coalesce("is_listed", F.lit(False)).alias("is_listed")), "keys")
    inside, outside = marked.where("is_listed").select("key"), marked.where("NOT is_listed").select("key")
    levels: list[Level] = []
    while (n := inside.count()) > 0:
        n_bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)
        if n_bits // 8 > MAX_BYTES:
            return None
        level = Level(n_bits, written(_filter(inside, len(levels), n_bits), "level"))
        wrong = outside.where(_passes(F.col("key"), len(levels), n_bits, level.words.scalar()))
        inside, outside = written(wrong, "wrong"), inside
        levels.append(level)
    return levels


def is_listed(key: Column, levels: Sequence[Level], constants: Column) -> Column:
    """Exact for every key of the universe; `constants` holds the words of each level."""
    verdict = F.lit(len(levels) % 2 == 1)
    for k in reversed(range(len(levels))):
        level = levels[k]
        verdict = F.when(_passes(key, k, level.n_bits, F.get(constants, F.lit(k))), verdict).otherwise(F.lit(k % 2 == 1))
    return verdict


def listed_keys(universe: DataFrame, labels: Sequence[str] = LISTED_LABELS) -> DataFrame:
    """The blocked domains among the keys: a listed name followed by exactly two more labels."""
    pattern = rf"^({'|'.join(labels)})\.[^.]+\.[^.]+$"
    return universe.where(F.col("key").rlike(pattern))


def judge(pages: DataFrame, listed: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """`(page_id, host, path, rule, verdict, listed)` per row of `pages`.

    A host is listed if it or one of its parents is. `listed` has the column `key`.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = parsed.select("host").distinct()
    universe = written(hosts.select(F.explode(parents(F.col("host"))).alias("key")).distinct(), "universe")
    wanted = listed_keys(universe) if listed is None else listed
    levels = build_cascade(universe, wanted)
    if levels is not None:
        # Scalars can't stand inside a lambda, so the levels enter it as one variable.
        constants = F.array(*[level.words.scalar() for level in levels]).alias("levels")
        found = let(F.col("levels"), lambda c: F.exists(parents(F.col("host")), lambda key: is_listed(key, levels, c)))
        judged = parsed.select("*", constants).withColumn("listed", found if levels else F.lit(False))
    else:
        bad = hosts.select("host", F.explode(parents(F.col("host"))).alias("key")).join(wanted, "key", "left_semi")
        bad = bad.select("host").distinct().withColumn("listed", F.lit(True))
        judged = parsed.join(bad, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return judged.withColumn("fit", rule).select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "listed",
    )
