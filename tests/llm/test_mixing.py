"""The mix against a plain reference, its draw over shards, and the blocks it puts out."""

from __future__ import annotations

import math
import random
import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from dqgate.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def h64(*values):
    """Spark's xxhash64 over ints (as `("i", n)`), longs, texts and nulls, signed."""
    seed = 42
    for v in values:
        if v is None:
            continue
        if isinstance(v, tuple):
            raw = struct.pack("<i", v[1])
        else:
            raw = struct.pack("<q", v) if isinstance(v, int) else v.encode()
        seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


SEED = ("i", mixing.SEED)


def slow_permuted(j, n, *key):
    a = math.ceil(math.sqrt(n))
    b = (n + a - 1) // a
    x = j
    while True:
        left, right = x % a, x // a
        for k in (1, 2, 3, 4):
            if k % 2:
                left = (left + h64(SEED, ("i", k), right, *key) % a) % a
            else:
                right = (right + h64(SEED, ("i", k), left, *key) % b) % b
        x = right * a + left
        if x < n:
            return x


def slow_mix(rows):
    """Words taken per row of `rows (doc_id, text, source)`, without shards, tables or sums of sums."""
    docs = []
    for doc_id, text, source in rows:
        digest = h64(text)
        docs.append((doc_id, digest, source, len(WORD.findall(text or ""))))
    buckets = max(1, math.isqrt(len(docs)))
    by_source = defaultdict(list)
    for doc_id, digest, source, size in docs:
        h = h64(SEED, doc_id, digest, ("q", size)[1])
        by_source[source].append((h % buckets, h, (doc_id is not None, doc_id or 0), digest, size))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(d[4] for d in by_source[s]) for s in names]
    targets = mixing.shares(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(names))], mixing.SHARE * sum(sizes))
    taken = Counter()
    for source, size, target in zip(names, sizes, targets, strict=True):
        owner = [(d[2][1] if d[2][0] else None, d[3]) for d in sorted(by_source[source]) for _ in range(d[4])]
        left, n_pass = round(target), 0
        while left > 0 and size:
            now = min(left, size)
            n_full = size // mixing.BLOCK
            for slot in range(-(-now // mixing.BLOCK)):
                block = slow_permuted(slot, n_full, ("i", n_pass), source) if slot < n_full else n_full
                take = min(mixing.BLOCK, now - slot * mixing.BLOCK)
                for word in owner[block * mixing.BLOCK :][:take]:
                    taken[(source, *word)] += 1
            left, n_pass = left - now, n_pass + 1
    return targets, names, taken


def some_rows(seed, n):
    rng = random.Random(seed)
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(rng.choice([0, 1, 5, 70, 400])))
    rows = [(i, text(i), rng.choice("aaaabcé")) for i in range(n)]
    return [*rows, (900, None, "a"), (901, "one", None), (None, "no id here", "b"), (902, "z " * 9_000, "b")]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_is_that_of_the_reference(spark, seed):
    rows = some_rows(seed, 90)
    targets, names, taken = slow_mix(rows)
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    texts = {(i, s): t for i, t, s in rows}
    for r in got:
        assert r.taken == taken[(r.source, r.doc_id, h64(texts[(r.doc_id, r.source)]))], r
        assert r.target == pytest.approx(targets[names.index(r.source)])
        assert (r.first_shard is None) == (r.taken == 0)


def test_counts_per_shard_are_a_multinomial_draw(spark):
    sizes = [("a", 640_000, 900_000.0), ("b", 64_000, 128_000.0), (None, 6_400, 5_000.0), ("none", 0, 0.0)]
    targets = spark.createDataFrame(sizes, "source string, source_size long, target double")
    per_source = mixing.wanted(targets)
    n_slots = {r.source: r.n_slots for r in per_source.collect()}
    assert n_slots == {"a": 14_063, "b": 2_000, None: 79}
    rows = mixing.shard_counts(per_source, 1_024).collect()
    n_shards = -(-sum(n_slots.values()) // 1_024)
    for source, total in n_slots.items():
        mine = sorted((r.shard, r.first, r.n) for r in rows if r.source == source)
        assert sum(n for *_, n in mine) == total and all(0 <= s < n_shards for s, *_ in mine)
        at = 0
        for _, first, n in mine:
            assert first == at and n > 0
            at += n
        # Pearson's statistic has as many degrees of freedom as there are shards, less one.
        counts = {s: n for s, _, n in mine}
        mean = total / n_shards
        chi = sum((counts.get(s, 0) - mean) ** 2 / mean for s in range(n_shards))
        assert 1 < chi < 50
    # The weights hold in each shard, not only over all of them.
    for shard in range(n_shards):
        n = {r.source: r.n for r in rows if r.shard == shard}
        assert abs(n["a"] / sum(n.values()) - n_slots["a"] / sum(n_slots.values())) < 0.06


def test_slots_are_dealt_to_shards_without_loss(spark):
    targets = spark.createDataFrame([("a", 1_000, 1_530.0), ("b", 130, 260.0)], "source string, source_size long, target double")
    for shard_slots in (4, 1_000):
        rows = mixing.slots(targets, shard_slots=shard_slots).collect()
        assert len({(r.source, r["pass"], r.block) for r in rows}) == len(rows)
        assert Counter(r.source for r in rows) == {"a": 16 + 9, "b": 6}
        words = Counter()
        for r in rows:
            words[r.source] += r.take
        assert words == {"a": 1_530, "b": 260}
        assert len({r.shard for r in rows}) == (1 if shard_slots == 1_000 else 8)


def test_shard_is_in_the_plan_of_the_query(spark):
    plan = mixing.mix(spark.createDataFrame(some_rows(1, 10), SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert "shard" in plan


def test_blocks_hold_the_words_of_their_stream(spark):
    rows = some_rows(4, 60)
    rows += [rows[3], rows[3]]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("mine"))
    got = mixing.mixed_blocks(docs).collect()
    mixed = mixing.mix(docs).collect()
    words, targets = Counter(), {}
    for r in mixed:
        targets[r.source] = round(r.target)
        words[r.source] += r.taken
    assert {s: n for s, n in targets.items() if n} == dict(+words)
    blocks, places = defaultdict(dict), defaultdict(list)
    total = Counter()
    for r in got:
        assert len(r.text.split(" ")) == r.n_words <= mixing.BLOCK
        assert r["pass"] not in blocks[r.source, r.block]
        blocks[r.source, r.block][r["pass"]] = r.text.split(" ")
        places[r.shard].append(r.place)
        total[r.source] += r.n_words
    assert total == +words
    for taken in places.values():
        assert sorted(taken) == list(range(len(taken)))
    # A block taken again holds the same words, up to where it is cut.
    for passes in blocks.values():
        longest = max(passes.values(), key=len)
        assert all(longest[: len(p)] == p for p in passes.values())
    # Side by side, the blocks are the documents, whole and in one piece each.
    for source in {"a", "b", "é", None}:
        last = max(b for s, b in blocks if s == source)
        if source != "b" and all((source, b) in blocks for b in range(last + 1)):
            stream = " ".join(" ".join(max(blocks[source, b].values(), key=len)) for b in range(last + 1))
            if len(stream.split(" ")) == sum(len(WORD.findall(t or "")) for _, t, s in rows if s == source):
                for _, text, s in rows:
                    if s == source and text:
                        assert f" {text} " in f" {stream} "
    assert mixing.mixed_blocks(docs.limit(0)).count() == 0
