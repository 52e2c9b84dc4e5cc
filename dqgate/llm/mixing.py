"""Mixing sources to target weights by drawing fixed-length blocks.

The words of each source, document after document, form a stream that is cut into blocks
of `BLOCK` words. A source's target, a number of words, gives its number of slots, each to
be filled with one block. The mix is dealt to output shards of about `SHARD_SLOTS` slots: a
source's counts over the shards are one multinomial draw with its slots as total, so a
shard's mixture differs from the weights by chance only and each target is still met. With
the counts the source's slots are numbered through, shard after shard. Slot j takes the
block that a pseudorandom permutation of the source's block indices gives for j, one
permutation per pass over the source: no block is taken twice within a pass, and the last
slot is cut to the words still wanted. Blocks are joined to their slots by index.

`mix` counts what is taken of each document, `mixed_blocks` gives the shards with their
texts, `mixed_documents` sets what is taken back into documents.

Running sums over a source are made in two steps over buckets, so that a hot source is
spread over many tasks.

Defined results: a null text has size 0. Targets of sources without words are 0.
Repeated rows are documents of their own. Documents of size 0 are never taken. A null
`doc_id` or source is a value like any other, the null source being the last. Long texts
fill as many blocks as they need. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqgate.functions.sizes import broadcast_if_small
from dqgate.llm.common import SPACE, let, words, written

WEIGHTS = (3, 1, 2)
# Words that the mix takes, per word of the sources together.
SHARE = 1.5
# Most times that a source, and with it any document, is taken.
MOST = 2
BLOCK = 64
# Slots of an output shard on average; more slots make more shards.
SHARD_SLOTS = 1 << 12
# Slots that one row stands for until they are dealt, and shards summed up together.
RUN = 1 << 16
SHARD_BUCKET = 1 << 12
# Most tasks that make slots.
_MOST_TASKS = 20_000
SEED = 20_240_131


# ---- targets -----------------------------------------------------------------


def shares(sizes: list[int], weights: list[float], total: float) -> list[float]:
    """Targets by weight; what a source can't take is shared among the others by weight."""
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        scale = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * scale > MOST * sizes[i]}
        for i in full or open_:
            target[i] = float(MOST * sizes[i]) if full else weights[i] * scale
        left -= sum(target[i] for i in full)
        if not full:
            break
        open_ -= full
    return target


def source_targets(sizes: DataFrame) -> DataFrame:
    """`(source, source_size, target)`; `sizes` has `(source, size)` per document.

    One row per source reaches the driver: a mix names its sources, so they are few.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    # UTF-8 sorts like code points.
    rows = sorted(per_source, key=lambda r: (r.source is None, (r.source or "").encode("utf-8", "surrogatepass")))
    known = [r.source_size for r in rows]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))]
    targets = shares(known, weights, SHARE * sum(known))
    spark = sizes.sparkSession
    if not rows:
        return spark.range(0).select(
            F.lit(None).cast("string").alias("source"), F.col("id").alias("source_size"), F.lit(0.0).alias("target")
        )
    each = [
        F.struct(
            F.lit(r.source).cast("string").alias("source"),
            F.lit(n).cast("long").alias("source_size"),
            F.lit(t).alias("target"),
        )
        for r, n, t in zip(rows, known, targets, strict=True)
    ]
    return spark.range(1).select(F.inline(F.array(*each)))


# ---- stream positions --------------------------------------------------------


def _running(keyed: DataFrame, amount: str, *order: str) -> DataFrame:
    """`keyed (source, bucket, ...)` with `before`: what precedes a row in its source.

    Buckets follow each other in order, and rows of a bucket by `order`.
    """
    so_far = lambda w: F.coalesce(F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = keyed.groupBy("source", "bucket").agg(F.sum(amount).alias(amount))
    starts = totals.select(
        F.col("source").alias("s"),
        F.col("bucket").alias("b"),
        so_far(Window.partitionBy("source").orderBy("bucket")).alias("start"),
    )
    within = keyed.withColumn("inner", so_far(Window.partitionBy("source", "bucket").orderBy(*order)))
    same = within["source"].eqNullSafe(starts["s"]) & (within["bucket"] == starts["b"])
    return within.join(starts, same).withColumn("before", F.col("start") + F.col("inner")).drop("inner", "start", "s", "b")


def placed(docs: DataFrame, n_docs: int) -> DataFrame:
    """`docs (row, source, size)` with `at`, the words of the source before the document.

    The order within a source is that of a keyed hash. Documents that agree in it and in
    everything else can change places without a difference.
    """
    buckets = max(1, math.isqrt(n_docs))
    order = F.xxhash64(F.lit(SEED), "row", "size")
    keyed = docs.withColumn("h", order).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    return _running(keyed, "size", "h", "row").withColumnRenamed("before", "at").drop("h", "bucket")


# ---- permutations ------------------------------------------------------------


def permuted(j: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1, by key, applied to j.

    A Feistel network over a grid of a columns and at least n cells, fewer than n + a. A
    value that falls outside 0 .. n-1 is sent round again; there are fewer than a such
    cells, so a further rounds always end inside.
    """

    def network(x: Column, a: Column, b: Column) -> Column:
        turn = lambda s, k, m: F.pmod(F.xxhash64(F.lit(SEED), F.lit(k), s, *key), m)
        half = lambda s, k: F.struct(
            F.pmod(s["l"] + turn(s["r"], k, a), a).alias("l"), s["r"].alias("r")
        )
        other = lambda s, k: F.struct(
            s["l"].alias("l"), F.pmod(s["r"] + turn(s["l"], k, b), b).alias("r")
        )
        start = F.struct(F.pmod(x, a).alias("l"), F.floor(x / a).cast("long").alias("r"))
        s1 = lambda s: let(half(s, 1), lambda t: let(other(t, 2), lambda u: let(half(u, 3), lambda v: other(v, 4))))
        return let(let(start, s1), lambda s: s["r"] * a + s["l"])

    def inside(g: Column) -> Column:
        a, b = g["a"], g["b"]
        first = network(j, a, b)
        again = lambda x: F.aggregate(
            F.sequence(F.lit(1).cast("long"), a), x, lambda y, _: F.when(y < n, y).otherwise(network(y, a, b))
        )
        return let(first, lambda x: F.when(x < n, x).otherwise(again(x)))

    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    grid = let(a, lambda v: F.struct(v.alias("a"), F.floor((n + v - 1) / v).cast("long").alias("b")))
    return let(grid, inside)


# ---- shards, slots and blocks ------------------------------------------------


def wanted(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Sources that are taken of: `(source, source_size, wanted, per_pass, n_slots)`.

    `wanted` is in words, `per_pass` the slots of a pass over the whole source.
    """
    up = lambda n: F.floor((n + block - 1) / block).cast("long")
    size, all_ = F.col("source_size"), F.round("target").cast("long")
    return targets.where("source_size > 0 AND target > 0").select(
        "source",
        "source_size",
        all_.alias("wanted"),
        up(size).alias("per_pass"),
        (F.floor(all_ / size).cast("long") * up(size) + up(F.pmod(all_, size))).alias("n_slots"),
    )


def shard_counts(per_source: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """`per_source` by shard, with `n`, how many slots the shard gets of the source, and `first`.

    Each slot falls to a shard by a keyed hash, so the counts of a source are a multinomial
    draw. They are summed before they are shuffled. `first` numbers the source's slots
    through its shards.
    """
    total = per_source.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    n_shards = max(1, -(-total // shard_slots))
    runs = per_source.withColumn(
        "run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / RUN).cast("long")))
    ).repartition(_tasks(total, RUN), "source", "run")
    ball = runs.withColumn(
        "ball", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("run") * RUN + RUN, F.col("n_slots")) - 1))
    )
    shard = F.pmod(F.xxhash64(F.lit(SEED), F.col("ball"), F.col("source")), F.lit(n_shards))
    counts = ball.withColumn("shard", shard).groupBy(*per_source.columns, "shard").agg(F.count("*").alias("n"))
    keyed = written(counts.withColumn("bucket", F.floor(F.col("shard") / SHARD_BUCKET)), "shards")
    return _running(keyed, "n", "shard").withColumnRenamed("before", "first").drop("bucket")


def _tasks(slots: int, each: int) -> int:
    return min(_MOST_TASKS, 1 + slots // each)


def slots(targets: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """`(source, shard, pass, slot, block, take)`: which words of which block a shard takes.

    Full blocks are permuted; the short block at the end of a stream comes last in a pass.
    """
    per_source = wanted(targets, block)
    n_slots = per_source.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    counts = shard_counts(per_source, shard_slots).repartition(_tasks(n_slots, shard_slots), "source", "shard")
    each = counts.withColumn("j", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
    size, n_full = F.col("source_size"), F.floor(F.col("source_size") / block).cast("long")
    numbered = each.select(
        "source",
        "shard",
        F.floor(F.col("j") / F.col("per_pass")).cast("int").alias("pass"),
        F.pmod("j", "per_pass").alias("slot"),
        size,
        "wanted",
        n_full.alias("n_full"),
    )
    left = F.least(F.col("wanted") - F.col("pass") * size, size)
    full = F.col("n_full")
    block_of = F.when(F.col("slot") < full, permuted(F.col("slot"), full, F.col("pass"), F.col("source"))).otherwise(full)
    return numbered.select(
        "source",
        "shard",
        "pass",
        "slot",
        block_of.alias("block"),
        F.least(F.lit(block), left - F.col("slot") * block).alias("take"),
    )


def pieces(positions: DataFrame, block: int = BLOCK) -> DataFrame:
    """`(source, at, block, start, first, n)`: the words `first ..` of the document at `at` that
    lie in a block, there from `start` on."""
    at, end = F.col("at"), F.col("at") + F.col("size")
    cut = positions.where("size > 0").select(
        "source",
        "at",
        "size",
        F.explode(F.sequence(F.floor(at / block).cast("long"), F.floor((end - 1) / block).cast("long"))).alias("block"),
    )
    lo, hi = F.greatest(at, F.col("block") * block), F.least(end, (F.col("block") + 1) * block)
    return cut.select(
        "source",
        "at",
        "block",
        (lo - F.col("block") * block).alias("start"),
        (lo - at).alias("first"),
        (hi - lo).alias("n"),
    )


def drawn(positions: DataFrame, targets: DataFrame) -> DataFrame:
    """`(source, at, shard, pass, slot, block, start, first, n)`: every run of a document's words
    that the mix takes, with its shard and its place in the block.

    `(source, at)` names a document: no two with words begin at one place.
    """
    part = pieces(positions).withColumnRenamed("n", "has")
    # The rows that slots are made from are few and small, which says nothing about the slots:
    # without the hint they would be broadcast.
    slot = slots(targets).withColumnsRenamed({"source": "s", "block": "b"}).hint("merge")
    same = part["source"].eqNullSafe(slot["s"]) & (part["block"] == slot["b"])
    n = F.least("has", F.col("take") - F.col("start")).alias("n")
    return part.join(slot, same).select("source", "at", "shard", "pass", "slot", "block", "start", "first", n).where("n > 0")


def _row(docs: DataFrame) -> Column:
    return F.struct(F.col("doc_id"), F.xxhash64("text").alias("digest"))


def _name(row: str = "row") -> Column:
    """Row and source as one text that is never null: rows alike in both can stand for each other."""
    parts = (f"{row}.doc_id", f"{row}.digest", "source")
    return F.to_json(F.struct(*[F.col(p).cast("string").alias(f"k{i}") for i, p in enumerate(parts)]))


def sized(docs: DataFrame) -> DataFrame:
    """`(row, source, size)` per document; the text isn't carried along."""
    return docs.select(
        _row(docs).alias("row"),
        F.col("source").cast("string").alias("source"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
    )


def _plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    measured = written(sized(docs), "sizes")
    targets = source_targets(measured)
    return written(placed(measured, measured.count()), "positions"), targets


def _to_document(positions: DataFrame, found: DataFrame, how: str) -> DataFrame:
    found = found.withColumnsRenamed({"source": "s", "at": "a"})
    same = positions["source"].eqNullSafe(found["s"]) & (positions["at"] == found["a"]) & (positions["size"] > 0)
    return positions.join(found, same, how).drop("s", "a")


def mix(docs: DataFrame) -> DataFrame:
    """`(doc_id, size, source, source_size, target, taken, first_shard, last_shard)` per row of `docs`.

    The shards are the lowest and the highest that hold words of the document, null if none does.
    """
    positions, targets = _plan(docs)
    taken = drawn(positions, targets).groupBy("source", "at").agg(
        F.sum("n").alias("taken"), F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard")
    )
    small = broadcast_if_small(targets.withColumnRenamed("source", "s"))
    return (
        _to_document(positions, taken, "left")
        .join(small, F.col("source").eqNullSafe(F.col("s")))
        .select(
            "row.doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
            "first_shard", "last_shard",
        )
    )


def _with_texts(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """`(doc, size, taken)` for the documents that `marked (name, at, size, taken)` takes words of."""
    marked = written(marked, "wanted")
    packed = docs.select(
        F.struct("*").alias("doc"), _row(docs).alias("row"), F.col("source").cast("string").alias("source")
    ).select("doc", _name().alias("name"))
    several = written(marked.groupBy("name").count().where("count > 1").select("name"), "several")
    if several.isEmpty():
        marked = marked.where("size(taken) > 0")
        both = packed.join(marked.withColumnRenamed("name", "n").hint("merge"), F.col("name") == F.col("n"))
    else:
        # Repeated rows are numbered on both sides.
        number = lambda by: F.row_number().over(Window.partitionBy("name").orderBy(by))
        mine, theirs = packed.withColumn("copy", number("name")), marked.withColumn("c", number("at"))
        theirs = theirs.withColumnRenamed("name", "n")
        both = mine.join(theirs.hint("merge"), (F.col("name") == F.col("n")) & (F.col("copy") == F.col("c")))
    return both.select("doc", "size", "taken")


def _marked(positions: DataFrame, taken: DataFrame) -> DataFrame:
    return _to_document(positions, taken, "left").select(
        _name().alias("name"), "at", "size", F.coalesce("taken", F.array()).alias("taken")
    )


def _tokens(text: Column) -> Column:
    """The words of a text, each with the separators behind it."""
    return F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+[{SPACE}]*"), F.lit(0))


def _words_of(tokens: Column, run: Column) -> Column:
    return F.array_join(F.slice(tokens, (run["first"] + 1).cast("int"), run["n"].cast("int")), "")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents, columns as given: one row per document and pass that takes words of it.

    A document taken whole keeps its text. Of others the text is what is taken, in order.
    """
    positions, targets = _plan(docs)
    run = F.struct("first", "n")
    passes = drawn(positions, targets).groupBy("source", "at", "pass").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    taken = passes.groupBy("source", "at").agg(F.collect_list("runs").alias("taken"))
    each = _with_texts(docs, _marked(positions, taken)).select("doc", "size", F.explode("taken").alias("runs"))
    whole = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["n"]) == F.col("size")
    part = let(_tokens(F.col("doc.text")), lambda t: F.array_join(F.transform("runs", lambda r: _words_of(t, r)), ""))
    made = each.select("doc", F.when(whole, F.col("doc.text")).otherwise(part).alias("mixed"))
    fresh = {"text": F.col("mixed"), "n_chars": F.length("mixed").cast("long")}
    return made.select(*[fresh.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def mixed_blocks(docs: DataFrame) -> DataFrame:
    """The mix as shards: `(shard, place, source, pass, block, n_words, text)`, a row per slot.

    `place` numbers a shard's slots, sources in random order. Words are joined by one space.
    """
    positions, targets = _plan(docs)
    run = F.struct("shard", "pass", "slot", "block", "start", "first", "n")
    runs = drawn(positions, targets).groupBy("source", "at").agg(F.collect_list(run).alias("taken"))
    each = _with_texts(docs, _marked(positions, runs)).select(
        F.col("doc.source").cast("string").alias("source"), "taken", words(F.col("doc.text")).alias("tokens")
    )
    cut = lambda r: F.array_join(F.slice("tokens", (r["first"] + 1).cast("int"), r["n"].cast("int")), " ")
    # Runs are cut out before they are exploded: no row holds a whole text beside its run.
    parts = each.select("source", F.explode(F.transform("taken", lambda r: F.struct(r.alias("run"), cut(r).alias("words")))).alias("p"))
    blocks = parts.groupBy("p.run.shard", "source", "p.run.pass", "p.run.slot", "p.run.block").agg(
        F.sum("p.run.n").alias("n_words"),
        F.array_join(F.sort_array(F.collect_list(F.struct("p.run.start", "p.words")))["words"], " ").alias("text"),
    )
    order = F.xxhash64(F.lit(SEED), "shard", "pass", "slot", "source")
    place = F.row_number().over(Window.partitionBy("shard").orderBy(order, "source", "pass", "slot")) - 1
    return blocks.select("shard", place.alias("place"), "source", "pass", "block", "n_words", "text")
