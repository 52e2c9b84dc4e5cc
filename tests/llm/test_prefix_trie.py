"""The prefix trie against a brute force over all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from dqgate.llm import prefix_trie
from dqgate.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def own_turns(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            found[c].append((turn is not None, turn or 0, role, digest, text))
    return {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in found.items()}


def brute(sequences):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, ms in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(ms) - 1) * len(p[-1][1]) if p else 0
    sha = lambda cs: hashlib.sha256(",".join(map(str, sorted(cs))).encode()).hexdigest()
    return sorted(
        (min(ms), len(p), min(members[p[:-1]]) if p else -(10**9), len(ms), len(children[p]), leaves[p], saved[p], sha(ends[p]))
        for p, ms in members.items()
    )


def got(df):
    return sorted(tuple(-(10**9) if v is None else v for v in r) for r in df.collect())


def trie(spark, rows, fan=prefix_trie.FAN):
    return prefix_trie.prefix_trie(prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA)), fan)


def conversations(seed, n):
    """Many share first turns, a third are the same, some are long, nested or empty."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-500, 5000), n):
        if rng.random() < 0.33:
            turns = [("user", "hello"), ("assistant", "hi")]
        else:
            turns = [(rng.choice(["user", "bot"]), rng.choice("abçd") * rng.randint(0, 2)) for _ in range(rng.randint(1, 6))]
            if rng.random() < 0.3:
                turns = [("user", "hello")] + turns
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rows += [(9001, i, "user", f"{i % 3}") for i in range(400)] + [(9002, i, "user", f"{i % 3}") for i in range(390)]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_agrees_with_brute_force(spark):
    rows = conversations(1, 150)
    assert got(trie(spark, rows)) == brute(own_turns(rows))


def test_forests_of_many_blocks_are_merged(spark, many_partitions):
    """Thirteen partitions in levels of two: the same conversation and prefix lie in several."""
    rows = conversations(2, 200)
    assert got(trie(spark, rows, fan=2)) == brute(own_turns(rows))


def test_nulls_ties_repeated_rows_clashing_columns_and_no_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, "u", "z"), (1, 0, None, None), (1, 0, None, None), (2, 0, "u", "a"), (2, 0, "a", "u")]
    rows += [(3, None, "u", "z"), (4, 0, "u", "long " * 200_000), (5, 0, "u", "long " * 200_000), (6, 0, "us", "er"), (7, 0, "user", "")]
    assert got(trie(spark, rows)) == brute(own_turns(rows))
    assert got(trie(spark, [])) == []
    clash = spark.createDataFrame([(1, 0, "u", "a", "k", 2, "n")], SCHEMA + ", key string, block int, node string")
    assert len(got(prefix_trie.prefix_trie(prefix_trie.turn_lists(clash)))) == 2


def test_a_conversation_without_turns_ends_at_the_root(spark):
    lists = prefix_trie.turn_lists(spark.createDataFrame([(1, 0, "u", "a")], SCHEMA))
    none = lists.selectExpr("7L AS conv_id", "slice(turns, 1, 0) AS turns")
    assert got(prefix_trie.prefix_trie(none)) == brute({7: []})
    assert got(prefix_trie.prefix_trie(lists.unionByName(none))) == brute({1: [("u", "a")], 7: []})


def test_query_rebuilds_each_conversation_from_its_group(spark, tmp_path):
    rng = random.Random(3)
    rows = [(c, t, rng.choice("ab"), rng.choice("xyz")) for c in [*range(0, 40), *range(200, 260), 305] for t in range(rng.randint(1, 7))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    own = own_turns(rows)
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    assert any(not turns for turns in made.values())
    assert got(QUERIES["op12_prefix_trie"](spark, str(tmp_path))) == brute(made)
