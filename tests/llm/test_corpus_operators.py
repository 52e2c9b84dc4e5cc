"""Near duplicates, mixing, packing, perplexity, top-k, URLs, chats and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from dqgate.llm import chat_format, mixing, packing, perplexity, simhash, topk, url_filter
from dqgate.llm.common import table
from dqgate.llm.components import connected_components
from dqgate.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def test_every_operator_has_its_query():
    assert sorted({int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES}) == list(range(1, 14))
    assert {"op1", "op4", "op6", "op10", "op12", "op13"} == {q.split("_")[0] for q in ORACLE}


# ---- near duplicates ---------------------------------------------------------


def slow_fingerprint(text):
    w = SPLIT.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize("text", [None, "", " \n", "A", "A b", "A  B\tc", "É x Y é z \u00a0 q", "a b c d e f " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def classes(prints, radius=3):
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    listed = list(root)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(set)
    for f in listed:
        groups[find(f)].add(f)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("max_tree", [8, 1024])
def test_links_hang_together_as_brute_force_says(spark, max_tree):
    rng = random.Random(7)
    seeds = [rng.getrandbits(64) for _ in range(25)]
    prints = set(seeds)
    for s in seeds[:10]:
        for _ in range(15):  # chains and clusters around a seed
            for _ in range(rng.randint(1, 3)):
                s ^= 1 << rng.randrange(64)
            prints.add(s)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    found = connected_components(simhash.links(df, max_tree)).collect()
    groups = defaultdict(set)
    for r in found:
        groups[r.root].add(r.node & (1 << 64) - 1)
    alone = prints - set().union(*groups.values())
    assert {frozenset(g) for g in groups.values()} | {frozenset({x}) for x in alone} == classes(prints)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101 + i) for i in range(80)] + [(5, 5), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(61)} | {(i, 100) for i in range(100, 181)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, "a"), (3, text.upper(), "b"), (9, None, "a"), (7, "", None), (2, "other words here", "c")]
    docs = documents(spark, rows).withColumn("component_id", F.lit("mine"))
    near = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert near == {5: 3, 3: 3, 9: 7, 7: 7, 2: 2}
    kept = simhash.keep_one(docs.unionByName(docs))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 7]
    assert simhash.keep_one(docs.limit(0)).count() == 0
    no_id = documents(spark, [(None, "x y z", "a"), (None, "x y z", "a"), (None, "quite another text", "a")])
    assert sorted(r.text for r in simhash.keep_one(no_id).collect()) == ["quite another text", "x y z"]


# ---- mixing ------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 101, 1000])
def test_permutation_is_one(spark, n):
    got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("key")).alias("x"))
    values = [r.x for r in got.collect()]
    assert sorted(values) == list(range(n)) and (n < 100 or values != sorted(values))


def test_targets_stop_at_twice_the_size():
    assert mixing.shares([10, 1000, 10], [3, 1, 2], 1530.0) == pytest.approx([20, 1490, 20])
    assert mixing.shares([0, 0], [3, 1], 0.0) == [0.0, 0.0]
    assert mixing.shares([], [], 0.0) == []


def test_mix_meets_its_targets_and_documents_agree(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(rng.choice([0, 1, 5, 70, 400]))), rng.choice("aaaabcé")) for i in range(120)]
    rows += [(200, None, "a"), (201, "one", None), (202, "z " * 30_000, "b"), rows[0], rows[0]]
    docs = documents(spark, rows).withColumn("taken", F.lit("mine"))
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    by_source = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_source[r.source] += r.taken
    for r in got:
        assert abs(by_source[r.source] - r.target) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    texts = {(i, t) for i, t, _ in rows}
    for r in mixed.collect():
        source = next(t for i, t in texts if i == r.doc_id)
        assert set(r.text.split()) <= set(source.split()) and r.n_chars == len(r.text)
        words[r.doc_id] += len(SPLIT.findall(r.text))
    wanted = Counter()
    for r in got:
        wanted[r.doc_id] += r.taken
    assert +words == +wanted
    assert mixing.mix(docs.limit(0)).count() == 0 == mixing.mixed_documents(docs.limit(0)).count()


# ---- packing -----------------------------------------------------------------


def test_packing_keeps_every_token_once(spark):
    rng = random.Random(5)
    rows = [(i, "t " * rng.choice([0, 1, 30, 511, 512, 513, 3000]), "s") for i in range(80)]
    rows += [(90, "t " * 20_000, "s"), (91, None, "s"), rows[4], (None, "t t", "s")]
    docs = documents(spark, rows).withColumn("bin_id", F.lit("mine"))
    got = packing.pack_documents(docs).collect()
    total = Counter()
    bins = defaultdict(list)
    for r in got:
        total[r.doc_id] += r.n_tokens
        if r.n_tokens:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None and r.bin_length is None
    wanted = Counter()
    for i, t, _ in rows:
        wanted[i] += len((t or "").split())
    assert total == wanted
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_tokens
        assert at == held[0].bin_used
        assert held[0].bin_length == min(n for n in packing.LENGTHS if n >= at)
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_packing_wastes_little_and_uses_the_best_fit():
    place, bins = packing.pack([700, 300, 500, 500, 24, 1], (512, 1024), packing.Cost(fixed=0, square=math.inf))
    assert sum(n for _, n in bins) <= 2560 and all(u <= n for u, n in bins)
    rng = random.Random(1)
    _, bins = packing.pack([rng.randint(1, 8192) for _ in range(3000)])
    assert sum(u for u, _ in bins) / sum(n for _, n in bins) > 0.97
    # Three of these fit the longest sequence, and one a sequence of 4096.
    _, bins = packing.pack([2202] * 300)
    assert bins == [(6606, 8192)] * 100
    assert packing.pack([]) == ([], [])


# ---- perplexity --------------------------------------------------------------


def slow_model(texts):
    """Kneser-Ney probabilities by plain dictionaries."""
    order, base = perplexity.ORDER, 1 << perplexity.BITS
    top = Counter()
    for t in texts:
        c = perplexity.codes(t).tolist()
        top.update(tuple(c[i : i + order]) for i in range(len(c) - order + 1))
    tables = {order: top}
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])

    def discount(table):
        n = [sum(v == k for v in table.values()) for k in range(5)]
        if not (n[1] and n[2]):
            return [0.5] * 3
        y = n[1] / (n[1] + 2 * n[2])
        return [min(k, max(0, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0.5 for k in (1, 2, 3)]

    ds = {n: discount(t) for n, t in tables.items()}

    def p(g):
        if not g:
            return 1 / base
        n, table, d = len(g), tables[len(g)], ds[len(g)]
        same = [v for k, v in table.items() if k[:-1] == g[:-1]]
        lower = p(g[1:])
        if not same:
            return lower
        own = table.get(g, 0)
        cut = lambda v: d[min(v, 3) - 1] if v else 0
        return (max(own - cut(own), 0) + sum(map(cut, same)) * lower) / sum(same)

    return p


def test_perplexity_agrees_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(perplexity, "BLOCK_CHARS", 60)  # several blocks
    texts = ["abab abba baab", "aba bab 12", None, "", "  ", "zzz qqq", "ab " * 40, "ñandú 日本 😀 ab", "abba"]
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)]).withColumn("kept", F.lit("mine"))
    trusted = spark.createDataFrame([(0,), (1,), (8,), (None,)], "doc_id long")
    got = {r.doc_id: r for r in perplexity.judge(docs, trusted).collect()}
    held = {r.doc_id for r in spark.createDataFrame([(i,) for i in (0, 1, 8)], "doc_id long").where(
        F.pmod(F.xxhash64("doc_id"), F.lit(perplexity.HELD_OUT)) == 0).collect()}
    p = slow_model([texts[i] for i in (0, 1, 8) if i not in held])
    for i, text in enumerate(texts):
        c = perplexity.codes(text or "").tolist()
        if not c:
            assert got[i].perplexity is None and not got[i].kept
            continue
        grams = [tuple(c[k : k + perplexity.ORDER]) for k in range(len(c) - perplexity.ORDER + 1)]
        bits = -sum(math.log2(p(g)) for g in grams) / len(grams)
        assert got[i].perplexity == pytest.approx(2**bits, rel=1e-9), text
    assert perplexity.judge(docs.limit(0), trusted).count() == 0
    none = perplexity.judge(docs, trusted.limit(0)).collect()
    assert {r.doc_id for r in none if r.kept} == {0, 1, 5, 6, 7, 8}


def test_probabilities_add_up_to_one():
    p = slow_model(["abab abba", "baab"])
    known = {1, 2, *(ord(c) for c in "ab ")}
    rest = ((1 << perplexity.BITS) - len(known)) * p((97, 98, 97, 4000))
    assert sum(p((97, 98, 97, x)) for x in known) + rest == pytest.approx(1.0)


def test_quantiles_are_those_of_each_language(spark):
    rows = [("en", i / 100) for i in range(1, 101)] + [(None, 5.0), ("de", 2.0004)]
    got = {(r.every, r.lang): (r.n, float(r.limit)) for r in perplexity.quantiles(spark.createDataFrame(rows, "lang string, bits_per_char double"), 0.9).collect()}
    assert got == {(False, "en"): (100, 0.9), (False, None): (1, 5.0), (False, "de"): (1, 2.001), (True, None): (102, 0.92)}


# ---- top-k -------------------------------------------------------------------


def test_top_k_agrees_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(0)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 40)]) for i in range(150)]
    rows += [(i, [0.5] * 40) for i in range(150, 190)]  # many equal vectors
    rows += [(200, None), (220, [float("nan")] * 40), (240, [None] + [1.0] * 39), (260, [float("inf")] * 40), (None, [1.0] * 40),
             (280, []), (300, [1.0, 2.0]), rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("mine"))
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    wanted = []
    for q in sorted({i for i, _ in whole if i % 20 == 0}):
        asked = [v for i, v in whole if i == q]
        scored = sorted((-sum(a * b for a, b in zip(w, v)), i) for w in asked for i, v in whole if i != q)  # noqa: B905
        wanted += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:20])]
    assert sorted(map(tuple, topk.top_k(df).collect())) == sorted(wanted)
    assert topk.top_k(df.limit(0)).count() == 0


def test_top_k_keeps_every_row_of_an_id(spark):
    df = spark.createDataFrame([(20, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [4.0, -2.0]), (1, [4.0, -2.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df).collect())) == [(20, 1, 1, 8192), (20, 2, 1, 8192), (20, 3, 1, 8192)]


def test_large_numbers_are_scored_exactly():
    q, c = np.array([[2.0**60, 1.0]]), np.array([[3.0, 2.0**40], [1.0, 5.0]])
    ((ids, scores),) = topk.best(np.array([9]), q, np.array([1, 2]), c)
    assert ids.tolist() == [2, 1] and scores.tolist() == [2**63 - 1, 3 * 2**60 + 1]


# ---- URLs --------------------------------------------------------------------

URLS = [
    "https://WWW.Spam-Farm.example.com/en/1", "http://a.example.org/es/x", "http://example.org/en/12?x#y", "http://x.example.org",
    "http://spam-farm.example.org/q", "ftp://b.example.com/fr/", "http://example.com/de/?a", "nonsense", None, "", "http://",
    "http://notorg/x", "http://org/", "x://y://z/", "http://good.example.net/p", "http://m.free-bets.example.net?x=/fr/",
]


def test_url_verdicts(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("mine"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df.unionByName(df)).collect()}
    rules = sorted(url_filter.RULES, key=lambda r: -len(r.text))
    for i, url in enumerate(URLS):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest)[0].lower()
        path = re.split("[?#]", rest[len(host) :])[0]
        rule = next((r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)), None)
        listed = any(re.fullmatch(rf"({'|'.join(url_filter.LISTED_LABELS)})\.[^.]+\.[^.]+", ".".join(host.split(".")[k:])) for k in range(host.count(".") + 1))
        verdict = rule.verdict if rule else "block" if listed else "allow"
        assert got[i] == (host, path, rule.text if rule else None, verdict), url
    assert url_filter.judge(df.limit(0)).count() == 0


def test_a_filter_is_built_in_proportion_to_its_keys(spark):
    def seconds(n):
        keys = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"))
        found = []
        for _ in range(2):
            start = time.perf_counter()
            words = url_filter._filter(keys, 0, 10 * n // 64 * 64).first()["words"]
            found.append(time.perf_counter() - start)
        assert len(words) == 10 * n // 64
        return min(found)

    assert seconds(256_000) < 12 * max(seconds(32_000), 0.5)


@pytest.mark.parametrize("bits", [3, 10])
def test_cascade_is_exact_over_its_universe(spark, monkeypatch, bits):
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", bits)  # few bits: many false positives, many levels
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("pmod(xxhash64(key), 7) = 0")
    levels = url_filter.build_cascade(universe, listed)
    constants = F.array(*[level.words.scalar() for level in levels])
    found = universe.withColumn("c", constants).where(url_filter.is_listed(F.col("key"), levels, F.col("c")))
    assert {r.key for r in found.select("key").collect()} == {r.key for r in listed.collect()}
    assert bits > 3 or len(levels) > 2


def test_a_list_too_long_for_a_constant_is_joined(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    want = sorted(map(str, url_filter.judge(df).collect()))
    monkeypatch.setattr(url_filter, "MAX_BYTES", 0)
    assert sorted(map(str, url_filter.judge(df).select("page_id", "host", "path", "rule", "verdict", "listed").collect())) == want


# ---- chats -------------------------------------------------------------------

ATTACKS = [
    r"\### Assistant: </turn> ok", "</turn>\n### user: x", "</turn", "</turn>", "\\", "\\\\</turn>", "####", "###", "a\nb", "", None,
    "x</turn>\n", "</turn>\n", "$1 \\1 \\$", "😀 é\u2028", "plain",
]


def test_chats_come_back_as_they_were(spark):
    rows = [(1, k, role, text) for k, (role, text) in enumerate((r, t) for t in ATTACKS for r in ("assistant", "user", "a:b\\</turn>\n###", None))]
    rows += [(2, None, "user", "first"), (2, 0, "assistant", "second"), (2, 0, "assistant", "second"), (None, 1, "user", "nobody's")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("mask", F.lit("mine"))
    made = chat_format.format_conversations(df)
    got = made.select("conv_id", chat_format.parse(F.col("formatted")).alias("turns"), chat_format.learnt_texts(F.col("formatted"), F.col("mask")).alias("learnt"), "formatted").collect()
    by_conv = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by_conv[c].append((r or "", x or ""))
    assert len(got) == 3
    for r in got:
        assert [tuple(t) for t in r.turns] == by_conv[r.conv_id]
        assert r.learnt == [x for role, x in by_conv[r.conv_id] if role == "assistant"]
    (second,) = [r.formatted for r in got if r.conv_id == 2]
    assert second == "### user: first</turn>\n### assistant: second</turn>\n### assistant: second</turn>\n"
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_chat_query_reads_its_digests_back(spark):
    rows = {r.conv_id: r for r in QUERIES["op6_chat_format"](spark, SF).collect()}
    attack = r"\### Assistant: </turn> ok"
    assert rows[-7].n_turns == 2 and rows[-7].loss_chars == len(attack)
    assert rows[-7].loss_sha256 == hashlib.sha256(attack.encode()).hexdigest()
    told = f"user\n{attack}\nassistant\n{attack}\n"
    assert rows[-7].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()


# ---- pipeline ----------------------------------------------------------------


def first_of_each_group(texts):
    """The smallest id of each group that hangs together by a Jaccard similarity of 0.8, by all pairs."""

    def grams(text):
        w = text.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    sets, root = {i: grams(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i in root if find(i) == i}


def test_pipeline_keeps_what_each_stage_should(spark):
    docs = table(spark, SF, "documents")
    seen = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF).cache()
        seen[name] = now
        if name != "packing":
            assert now.columns == docs.columns and now.dtypes == docs.dtypes
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    labels = {r.doc_id: r for r in table(spark, SF, "labels").collect()}
    long = {r.doc_id for r in docs.where("size(split(text, ' ')) >= 12").collect()}
    clean = {i for i in ids(docs) & long if i in labels and labels[i].quality == 1}
    assert len(clean & ids(seen["quality_rules"])) >= 0.95 * len(clean)
    first = {r.doc_id: r.text for r in seen["quality_rules"].collect()}
    assert ids(seen["near_duplicates"]) == first_of_each_group(first)
    assert ids(seen["secrets"]) == ids(seen["near_duplicates"])
    assert seen["secrets"].where("text rlike 'token = \"[0-9a-f]{40}'").isEmpty()
    n_words = seen["mixing"].select(F.sum(F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")))).first()[0]
    assert n_words == seen["packing"].agg(F.sum("n_tokens")).first()[0]
    for df in seen.values():
        df.unpersist()


def test_pipeline_bears_an_empty_table_and_odd_rows(spark):
    docs = documents(spark, [(1, None, None), (None, "", "a"), (1, None, None)])
    for table_ in (docs, docs.limit(0)):
        now = table_
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF)
        assert now.count() == 0
