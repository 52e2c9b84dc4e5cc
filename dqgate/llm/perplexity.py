"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model is over characters, `ORDER` at a time, so unknown words and all languages are
covered by one set of counts. It is trained on all trusted text but a tenth of the
documents, which set the thresholds: per language the quantile `QUANTILE` of their
perplexities. Documents above their language's threshold are not kept.

Counts are tables sharded by n-gram. Documents are dealt to blocks of about `BLOCK_CHARS`
characters; a block asks for the probabilities of the distinct n-grams it holds, so the
joins see each n-gram once per block and not once per occurrence, and the texts move once.

Text is taken in lower case, digits as 0, blanks as single spaces. Characters are folded to
12 bits: those below 4096 stay, others share the upper half.

Defined results: a null text, or one of blanks only, has no perplexity and is not kept. A
language with fewer than `MIN_HELD_OUT` held-out documents takes the threshold of all
languages together; where there is no trusted text at all everything with text is kept.
Null is a language. Repeated rows are judged each for itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqgate.functions.sizes import broadcast_if_small
from dqgate.llm.common import written

ORDER = 4
BITS = 12
BLOCK_CHARS = 16_000_000
HELD_OUT = 10
QUANTILE = 0.995
MIN_HELD_OUT = 20
_BOS, _EOS, _FIRST = 1, 2, 3
_CHUNK = 1 << 20
_DIGITS = re.compile(r"\d")


# ---- n-grams of texts --------------------------------------------------------


def codes(text: str) -> np.ndarray:
    """A normalized text between its marks, as folded characters."""
    plain = _DIGITS.sub("0", " ".join(text.lower().split()))
    raw = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    raw = np.where(raw < 1 << BITS, np.maximum(raw, _FIRST), (1 << BITS - 1) + raw % (1 << BITS - 1))
    return np.concatenate([np.full(ORDER - 1, _BOS), raw, [_EOS]]) if len(raw) else np.empty(0, np.int64)


def grams(c: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each predicted character."""
    n = max(0, len(c) - ORDER + 1)
    out = np.zeros(n, dtype=np.int64)
    for k in range(ORDER):
        out = (out << BITS) | c[k : k + n]
    return out


def _counted(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct n-grams and their counts, some millions of characters at a time."""
    held, n = [], 0
    for text in texts:
        found = grams(codes(text or ""))
        held.append(found)
        n += len(found)
        if n >= _CHUNK:
            yield np.unique(np.concatenate(held), return_counts=True)
            held, n = [], 0
    if n:
        yield np.unique(np.concatenate(held), return_counts=True)


def _train_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = (t.as_py() for batch in batches for t in batch.column("text"))
    for found, n in _counted(texts):
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["g", "c"])


# ---- counts ------------------------------------------------------------------


def _tail(g: Column, order: int) -> Column:
    """The last `order` characters of an n-gram."""
    return g.bitwiseAND(F.lit((1 << BITS * order) - 1))


def _head(g: Column) -> Column:
    """All but the last character."""
    return F.shiftright(g, BITS)


def counts(texts: DataFrame) -> dict[int, DataFrame]:
    """`(g, c)` per order: occurrences at the top, below that the number of different characters before."""
    top = texts.mapInArrow(_train_batches, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))
    tables = {ORDER: written(top, "counts")}
    for order in range(ORDER - 1, 0, -1):
        lower = tables[order + 1].groupBy(_tail(F.col("g"), order).alias("g")).agg(F.count("*").alias("c"))
        tables[order] = written(lower, "counts")
    return tables


def discounts(table: DataFrame) -> list[float]:
    """D1, D2, D3+ of modified Kneser-Ney, from the numbers of n-grams that occur 1 to 4 times."""
    n = table.agg(*[F.coalesce(F.sum((F.col("c") == k).cast("long")), F.lit(0)).alias(f"n{k}") for k in range(1, 5)]).first()
    n1, n2, n3, n4 = n
    if not (n1 and n2):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    above = [(1, n1, n2), (2, n2, n3), (3, n3, n4)]
    return [min(float(k), max(0.0, k - (k + 1) * y * b / a)) if a else 0.5 for k, a, b in above]


def _discount(c: Column, d: list[float]) -> Column:
    return F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def log_probabilities(wanted: DataFrame, tables: dict[int, DataFrame]) -> DataFrame:
    """`(g, lp)`: log2 of the last character's probability after the others, for distinct `g`."""
    found = wanted.select("g")
    p: Column = F.lit(1.0 / (1 << BITS))
    for order in range(1, ORDER + 1):
        table, d = tables[order], discounts(tables[order])
        weight = F.sum(_discount(F.col("c"), d))  # what the discounts leave for the lower order
        context = table.groupBy(_head(F.col("g")).alias("ctx")).agg(F.sum("c").alias("total"), weight.alias("rest"))
        own = _tail(F.col("g"), order)
        found = found.withColumns({"own": own, "ctx": _head(own), "p": p})
        found = found.join(table.withColumnRenamed("g", "own"), "own", "left").join(context, "ctx", "left")
        kept = F.greatest(F.coalesce(F.col("c") - _discount(F.col("c"), d), F.lit(0.0)), F.lit(0.0))
        p = F.when(F.col("total").isNull(), F.col("p")).otherwise((kept + F.col("rest") * F.col("p")) / F.col("total"))
        found = found.select("g", p.alias("p"))
        p = F.col("p")
    return found.select("g", F.log2("p").alias("lp"))


# ---- scores ------------------------------------------------------------------


def _block_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each block in a partition's rows."""
    held: dict[int, list[np.ndarray]] = {}
    n = 0

    def out() -> Iterator[pa.RecordBatch]:
        for block, parts in held.items():
            found = np.unique(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block)), pa.array(found)], names=["block", "g"])

    for batch in batches:
        for block, text in zip(batch.column("block").to_pylist(), batch.column("text"), strict=True):
            found = np.unique(grams(codes(text.as_py() or "")))
            held.setdefault(block, []).append(found)
            n += len(found)
            if n >= 8 * _CHUNK:
                yield from out()
                held, n = {}, 0
    yield from out()


def _scored(key: tuple, texts: pa.Table, model: pa.Table) -> pa.Table:
    g, lp = model.column("g").to_numpy(), model.column("lp").to_numpy()
    order = np.argsort(g)
    g, lp = g[order], lp[order]
    n, total = [], []
    for text in texts.column("text"):
        found = grams(codes(text.as_py() or ""))
        n.append(len(found))
        total.append(float(lp[np.searchsorted(g, found)].sum()) if len(found) else 0.0)
    return pa.table(
        {
            "doc_id": texts.column("doc_id"),
            "lang": texts.column("lang"),
            "trusted": texts.column("trusted"),
            "n_predicted": pa.array(n, pa.int64()),
            "bits": pa.array(total, pa.float64()),
        }
    )


def score(docs: DataFrame, tables: dict[int, DataFrame]) -> DataFrame:
    """`(doc_id, lang, trusted, n_predicted, bits)` per row of `docs (doc_id, lang, text, trusted)`."""
    n_chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-n_chars // BLOCK_CHARS))
    # Both uses of the dealt texts are in one query and take all their columns, so Spark moves
    # the texts once for both.
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).repartition("block")
    asked = dealt.mapInArrow(_block_batches, "block long, g long").distinct()
    known = log_probabilities(asked.select("g").distinct(), tables)
    told = asked.join(known, "g")
    return dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _scored, "doc_id long, lang string, trusted boolean, n_predicted long, bits double"
    )


def quantiles(held_out: DataFrame, q: float = QUANTILE) -> DataFrame:
    """`(lang, n, limit)` of `(lang, bits_per_char)`, and a row for all with `every` set.

    Exact to a thousandth of a bit: values are counted per thousandth.
    """
    steps = held_out.select("lang", F.ceil(F.col("bits_per_char") * 1000).alias("step"))
    both = steps.withColumn("every", F.lit(False)).unionByName(
        steps.select(F.lit(None).cast("string").alias("lang"), "step").withColumn("every", F.lit(True))
    )
    tally = both.groupBy("every", "lang", "step").agg(F.count("*").alias("k"))
    up_to = Window.partitionBy("every", "lang").orderBy("step")
    summed = tally.withColumns({"up": F.sum("k").over(up_to), "n": F.sum("k").over(Window.partitionBy("every", "lang"))})
    reached = summed.where(F.col("up") >= F.ceil(F.col("n") * q))
    return reached.groupBy("every", "lang").agg(F.first("n").alias("n"), (F.min("step") / 1000).alias("limit"))


def judge(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """`(doc_id, lang, n_predicted, perplexity, threshold, kept)` per row of `docs`; `trusted` has `doc_id`."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("t")).where("t IS NOT NULL").distinct()
    ids = broadcast_if_small(written(ids, "trusted"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    marked = rows.join(ids, F.col("doc_id") == F.col("t"), "left").select(
        "doc_id", "lang", "text", F.col("t").isNotNull().alias("trusted")
    )
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    tables = counts(marked.where(F.col("trusted") & ~held).select("text"))
    scored = written(score(marked, tables), "scores")
    per_char = F.when(F.col("n_predicted") > 0, -F.col("bits") / F.col("n_predicted"))
    scored = scored.withColumn("bits_per_char", per_char)
    limits = written(quantiles(scored.where(F.col("trusted") & held & F.col("bits_per_char").isNotNull())), "limits")
    own = limits.where(~F.col("every") & (F.col("n") >= MIN_HELD_OUT)).select(F.col("lang").alias("l"), F.col("limit").alias("own"))
    every = limits.where("every").select("limit")
    judged = scored.join(broadcast_if_small(own), F.col("lang").eqNullSafe(F.col("l")), "left")
    threshold = F.coalesce(F.col("own"), every.scalar())
    return judged.select(
        "doc_id",
        "lang",
        "n_predicted",
        F.pow(F.lit(2.0), "bits_per_char").alias("perplexity"),
        F.pow(F.lit(2.0), threshold).alias("threshold"),
        (F.col("bits_per_char").isNotNull() & F.coalesce(F.col("bits_per_char") <= threshold, F.lit(True))).alias("kept"),
    )
