"""The stage that keeps one of each group of near copies: brute force over all pairs by Jaccard similarity."""

from __future__ import annotations

import random

import corpus_pipeline
from dqgate.llm import jaccard_join, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w) or text or ''}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def corpus():
    """Texts with copies at many similarities about 0.8, a large group and a line that many share."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(4000)}"
    line = " ".join(word() for _ in range(12))
    texts = []
    for _ in range(40):
        base = [word() for _ in range(rng.choice([6, 30, 60, 200]))]
        texts.append(" ".join(base) + " " + line)
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy) + " " + line)
    base = [word() for _ in range(150)]
    for _ in range(120):
        copy = list(base)
        copy[rng.randrange(150)] = word()
        texts.append(" ".join(copy))
    texts += ["", None, " \t", "a b", "A  b", "a b c", "The " * 40, "the " * 70, texts[0].upper()]
    rng.shuffle(texts)
    return texts


def kept_by_brute_force(texts):
    sets = [grams(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if find(i) != find(j) and jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i in range(len(texts)) if find(i) == i}


def test_groups_are_those_of_all_pairs(spark):
    texts = corpus()
    docs = documents(spark, list(enumerate(texts))).repartition(3)
    got = {r.doc_id for r in jaccard_join.keep_one(docs).collect()}
    assert got == kept_by_brute_force(texts)


def test_stage_finds_near_copies_whose_fingerprints_are_far(spark):
    base = [f"w{i}" for i in range(120)]
    changed = [f"x{i}" if i in (30, 70) else w for i, w in enumerate(base)]
    a, b = " ".join(base), " ".join(changed)
    assert jaccard(grams(a), grams(b)) >= 0.8
    assert (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() > simhash.RADIUS
    docs = documents(spark, [(4, a), (2, b), (9, "quite another text")])
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [2, 9]


def test_rows_with_one_id_and_unlike_texts_both_stay(spark):
    rows = [(1, "one text of its own here"), (1, "and one quite unlike it today"), (1, "one text of its own here"), (None, "x y"), (None, "x y")]
    kept = jaccard_join.keep_one(documents(spark, rows))
    assert sorted(r.text for r in kept.collect()) == ["and one quite unlike it today", "one text of its own here", "x y"]
    assert jaccard_join.keep_one(documents(spark, rows).limit(0)).count() == 0


def test_stage_takes_pairs_from_the_trees(spark, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base), " ".join(base).upper(), "quite another text", None]
    docs = documents(spark, [(4, texts[0]), (2, texts[1]), (9, texts[2]), (7, texts[3])])
    asked, pairs = [], simhash.near_pairs

    def told(found):
        asked.append(pairs(found).count())
        return pairs(found)

    monkeypatch.setattr(simhash, "near_pairs", told)
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert asked == [1] and sorted(r.doc_id for r in kept) == [2, 7, 9]


def test_trees_lose_no_alike_pair_behind_unlike_ones(spark, monkeypatch):
    """A run that texts repeat makes their fingerprints near, whatever else they say: most links there don't hold."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = []
    for run in (200, 12):
        for _ in range(25):
            tail = [word() for _ in range(40)]
            texts += [" ".join(["the"] * run + tail[:-1] + [word()]) for _ in range(3)]
    prints, sets = [simhash.fingerprint(t) for t in texts], [grams(t) for t in texts]
    near = lambda i, j: (prints[i] ^ prints[j]).bit_count() <= simhash.RADIUS
    found = [(i, j) for i in range(len(texts)) for j in range(i) if near(i, j)]
    links = [(i, j) for i, j in found if jaccard(sets[i], sets[j]) >= 0.8]
    assert len(found) > 20 * len(links) > 1000 and any(prints[i] != prints[j] for i, j in links)
    root = list(range(len(texts)))
    for _ in texts:
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])

    def none_in_order(batches):
        for batch in batches:
            yield batch.select(["node", "node"]).rename_columns(["a", "b"]).slice(0, 0)

    # Trees alone: what the join would add is left out here.
    monkeypatch.setattr(jaccard_join, "_in_order", none_in_order)
    monkeypatch.setattr(jaccard_join, "_candidate_table", lambda *_: spark.createDataFrame([], jaccard_join._MET_DDL))
    docs = documents(spark, list(enumerate(texts))).repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == {i for i in range(len(texts)) if root[i] == i}


def test_links_of_the_trees_are_within_the_radius():
    rng = random.Random(5)
    prints = {rng.getrandbits(64)}
    for _ in range(300):  # a chain: its ends are far apart
        prints.add(rng.choice(sorted(prints)) ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    pairs = simhash.near_members(sorted(prints))
    assert len(pairs) < len(prints) and all((a ^ b).bit_count() <= simhash.RADIUS for a, b, _ in pairs)
    least = dict(simhash.linked(sorted(prints)))
    assert {(x, r) for a, b, r in pairs for x in (a, b) if x != r} == set(least.items())
