"""Periodic runs against a brute force over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

from dqgate.llm import periodic_runs
from dqgate.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def brute(words):
    found = []
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(24, 3 * q):
                own = words[s:e]
                if not any(q % d == 0 and own[d:] == own[:-d] for d in range(1, q)):
                    found.append((s, e - s, q))
            i = max(j, i + 1)
    return sorted(found)


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def repetitive(rng):
    """Words of a small alphabet, repeated with breaks, repetitions within repetitions."""
    letters = "abcd"[: rng.choice([1, 2, 3, 4])]
    out = []
    for _ in range(rng.randint(1, 6)):
        base = [rng.choice(letters) for _ in range(rng.randint(1, 60))]
        if rng.random() < 0.4:
            base = ["a"] * rng.randint(1, 40) + ["b"] * rng.randint(1, 3) + ["c"] * rng.randint(0, 30)
        out += base * rng.randint(1, 6) + base[: rng.randint(0, len(base))]
    return out[: rng.randint(1, 500)]


def found(spark, rows):
    got = periodic_runs.periodic_runs(spark.createDataFrame(rows, SCHEMA)).collect()
    return [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got]


def test_runs_agree_with_brute_force(spark):
    rng = random.Random(5)
    texts = [repetitive(rng) for _ in range(120)]
    got = {i: rest for i, *rest in found(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])}
    for i, words in enumerate(texts):
        runs = brute(words)
        assert got[i] == [len(words), runs, " ".join(collapse(words, runs))], words
    assert sum(len(r[1]) for r in got.values()) > 100


def test_long_periods_and_very_long_texts(spark):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**6)}"
    part = [word() for _ in range(9000)]
    long = [word() for _ in range(500)] + part * 3 + part[:17] + [word() for _ in range(70_000)]
    same = ["the"] * 300_000
    nested = (["x"] * 400 + ["y"]) * 5
    got = {i: rest for i, *rest in found(spark, [(1, " ".join(long)), (2, " ".join(same)), (3, " ".join(nested))])}
    assert got[1][:2] == [len(long), [(500, 27_017, 9000)]]
    assert got[1][2] == " ".join(long[:9500] + long[500 + 27_017 :])
    assert got[2] == [300_000, [(0, 300_000, 1)], "the"]
    assert got[3][1] == sorted([(0, 2005, 401)] + [(401 * k, 400, 1) for k in range(5)])
    assert got[3][2] == "x y"


def test_nulls_empty_texts_repeated_rows_and_clashing_columns(spark):
    rows = [(None, "a b " * 20), (1, None), (1, None), (2, " \t\n"), (3, "a\x0bb\x0ca b\ra b" + " a b" * 20), (4, "a\u00a0b " * 30)]
    got = sorted(found(spark, rows), key=repr)
    run = [(0, 40, 2)]
    assert got == sorted(
        [(None, 40, run, "a b"), (1, 0, [], ""), (1, 0, [], ""), (2, 0, [], ""), (3, 46, [(0, 46, 2)], "a b"), (4, 30, [(0, 30, 1)], "a\u00a0b")],
        key=repr,
    )
    clash = spark.createDataFrame([(7, "a b " * 20, "x", [1], "y", 3)], "doc_id long, text string, collapsed string, runs array<int>, best string, start long")
    assert [tuple(r.runs[0]) for r in periodic_runs.periodic_runs(clash).collect()] == run
    assert periodic_runs.periodic_runs(clash.limit(0)).count() == 0


def test_hash_that_agrees_by_chance_is_found_out():
    import numpy as np

    x = np.array([1, 2, 3] * 10 + [4] + [1, 2, 3] * 10 + [5])
    assert periodic_runs._compared(x, 0, 61, 3, 6) == (0, 30)


def rebuilt(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_agrees_with_brute_force(spark, tmp_path):
    rng = random.Random(8)
    docs = [(i, " ".join(repetitive(rng))) for i in range(60)]
    docs += [(i, " ".join(f"v{rng.randrange(50)}" for _ in range(rng.randint(0, 300)))) for i in range(60, 160)]
    docs += [(200, None), (201, ""), (None, "z " * 30)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for i, text in docs:
        words = (text or "").split()
        words = words if i is None else rebuilt(i, words)
        runs = brute(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected.append((i, len(runs), *best, milli, sha(told), sha(" ".join(collapse(words, runs)))))
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
