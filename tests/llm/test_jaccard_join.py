"""The Jaccard join against all pairs compared by sets of word tuples."""

from __future__ import annotations

import random

import numpy as np
import pytest

from dqgate.llm import jaccard_join
from dqgate.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            least[find(i)] = min(least.get(find(i), id_), id_)
    return sorted(((id_, len(s), least.get(find(i))) for i, ((id_, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def joined(spark, rows, **options):
    found = jaccard_join.linked_documents(spark.createDataFrame(rows, SCHEMA), **options)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def copies(rng, base, n, most):
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, most)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(9000)}"
        if rng.random() < 0.5:
            copy = copy[: len(copy) - rng.randint(0, len(copy) // 5)]
        yield " ".join(copy)


def corpus(seed):
    """Copies on both sides of 0.8, sizes on both sides of band ends, shared lines, a hub and its copies."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    line = " ".join(word() for _ in range(14))
    texts = []
    for _ in range(35):
        base = [word() for _ in range(rng.choice([5, 6, 9, 12, 20, 31, 60, 130, 260]))]
        texts += [f"{t} {line}" if rng.random() < 0.5 else t for t in copies(rng, base, 5, max(1, len(base) // 25))]
    texts += list(copies(rng, [word() for _ in range(160)], 90, 4))
    texts += [f"{line} {line} {word()} {word()} {word()}" for _ in range(30)]
    texts += ["", None, " \t", "a b", "A  b", "a b c", "The " * 40, "the " * 70, texts[0].upper(), "a b c d É", "a b c d é"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("wide", [16, 2])
def test_join_agrees_with_all_pairs(spark, wide):
    rows = corpus(wide)
    assert joined(spark, rows, wide=wide, parts=3) == brute(rows)


def test_segments_lose_no_pair_at_the_limit():
    """Every pair that is alike meets under some key, at all sizes, with the cheapest units taken."""
    rng = np.random.default_rng(4)
    for n in [*range(1, 40), 77, 150, 400]:
        for _ in range(6):
            a = np.unique(rng.integers(1, 1 << 63, n, dtype=np.uint64))
            s = int(rng.integers(-(-4 * n // 5), n + 1))
            shared = -(-4 * (n + s) // 9)
            if shared > s:
                continue
            b = np.unique(np.concatenate([rng.choice(a, shared, replace=False), rng.integers(1, 1 << 63, s - shared, dtype=np.uint64)]))
            assert jaccard_join.alike(a, b)
            crowd = [np.unique(np.append(a[: n // 2], rng.integers(1, 1 << 63, 3, dtype=np.uint64))) for _ in range(20)]
            key, of, flags = jaccard_join.entries([a, b, *crowd])
            mine = {k: f for k, o, f in zip(key.tolist(), of.tolist(), flags.tolist(), strict=True) if o == 0}
            met = [jaccard_join._asks(np.array(mine[k]), np.array(f)) for k, o, f in zip(key.tolist(), of.tolist(), flags.tolist(), strict=True) if o == 1 and k in mine]
            assert any(met), (n, s)


def test_large_group_that_hangs_together_by_its_hub(spark):
    """Copies are alike to the hub but seldom to each other, and stand often in one batch."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 2000):
        copy = list(base)
        for k in rng.sample(range(0, 115, 6), 2):
            copy[k] = f"x{i}"
        rows.append((i, " ".join(copy)))
    hub = grams(rows[0][1])
    assert all(100 * len(hub & grams(t)) >= 80 * len(hub | grams(t)) for _, t in rows)
    assert joined(spark, rows, parts=2) == sorted(((i, len(grams(t)), 0) for i, t in rows), key=repr)


def test_nulls_copies_long_texts_and_clashing_columns(spark):
    long = " ".join(str(i) for i in range(60_000))
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (3, "A B\tC d e f"), (9, None), (None, None), (8, long), (7, long + " x")]
    found = joined(spark, rows)
    assert found == brute(rows)
    assert (8, 59_996, 7) in found and (None, 2, 3) in found
    clash = spark.createDataFrame([(1, "a b", "x", 1, 2), (2, "A b", "y", 3, 4)], SCHEMA + ", node string, root int, n_shingles int")
    assert sorted(map(tuple, jaccard_join.linked_documents(clash).collect())) == [(1, 1, 1), (2, 1, 1)]
    assert jaccard_join.linked_documents(clash.limit(0)).count() == 0


def test_query_gives_every_row(spark, sf_dir):
    got = QUERIES["op13_jaccard_join"](spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_entries_beyond_the_packed_ones_meet_other_batches():
    """A subset that stands often in one batch and seldom in another: all of its entries are there as rows."""
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(1, 1 << 63, 400, dtype=np.uint64))
    copy = lambda: np.unique(np.append(base[:-1], rng.integers(1, 1 << 63, 1, dtype=np.uint64)))
    often, seldom = [copy() for _ in range(jaccard_join.OFTEN + 40)], [copy() for _ in range(3)]
    name = lambda k: k.to_bytes(16, "big")
    batches = [list(jaccard_join._packed([name(k) for k in ks], sets, 1)) for ks, sets in ((range(104), often), (range(200, 203), seldom))]
    met = list(jaccard_join._met(jaccard_join.WIDE)(batch for some in batches for batch in some))
    in_bucket, asked = {}, {}
    for row in (r for batch in met for r in batch.to_pylist() if r["bucket"] is not None):
        in_bucket.setdefault(row["bucket"], set()).add(int.from_bytes(row["node"], "big"))
        asked[row["bucket"]] = asked.get(row["bucket"], 0) | row["flag"]
    crowded = [nodes for k, nodes in in_bucket.items() if len(nodes & set(range(104))) > jaccard_join.OFTEN and asked[k] & jaccard_join._ASKING]
    assert crowded and all(nodes & {200, 201, 202} for nodes in crowded)


def test_rows_of_a_large_group_grow_with_its_size():
    """Four times the near copies in a bucket give about four times the rows, not sixteen times."""
    rng = np.random.default_rng(9)
    base = np.unique(rng.integers(1, 1 << 63, 300, dtype=np.uint64))
    rows = []
    for n in (60, 240):
        sets = [np.unique(np.append(base[:-1], rng.integers(1, 1 << 63, 1, dtype=np.uint64))) for _ in range(n)]
        packed = [b for k in range(0, n, 60) for b in jaccard_join._packed([i.to_bytes(16, "big") for i in range(k, k + 60)], sets[k : k + 60], 1)]
        rows.append(sum(b.num_rows for b in jaccard_join._met(jaccard_join.WIDE)(iter(packed))))
    assert rows[1] < 6 * rows[0]
