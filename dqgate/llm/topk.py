"""Exact top-k by inner product: columnar branch and bound.

Candidates are kept in blocks of vertical layout: one array per group of dimensions. A
block of queries is scored against a block of candidates one group of dimensions at a
time. After each, what is left of a vector bounds what it can still add (Cauchy-Schwarz:
the product of the remaining lengths); candidates whose best possible score stays below
the k-th best certain score are dropped and the others moved together. Each pair of
blocks is one bounded task row; only its k best per query are shuffled on.

Defined results: vectors that are null or hold a null or a value that isn't finite take
no part, nor do rows without `vec_id`. Rows with one `vec_id` are all candidates of other
ids, each with its own score; as queries they have one ranking together. A shorter vector has zeros where the other has components.
Scores beyond 64 bits are held at the largest or smallest long.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dqgate.llm.common import written

K = 20
SCALE = 64
QUERY_STEP = 20
# Rows of a block of candidates and of queries, and dimensions scored at a time.
CANDIDATES = 2048
QUERIES = 1024
DIMS = 16
_EXACT = 1 << 53


def valid(vectors: DataFrame) -> DataFrame:
    """`(vec_id, v, row)`: components as whole numbers, floor(64 * x), in doubles; `row` tells rows apart."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    # From 2 ** 53 on every double is whole.
    whole = lambda y: F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)
    scaled = F.transform("embedding", lambda x: whole(SCALE * x.cast("double")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"), F.monotonically_increasing_id().alias("row"))


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of equal length; shorter ones are filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(int(lengths.max(initial=0)), width or 0)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _block(part: pa.Table) -> pa.Table:
    """The vectors of one block as one row: ascending ids, and components in vertical layout."""
    ids, rows = part.column("vec_id").to_numpy(), _matrix(part.column("v").combine_chunks())
    order = np.argsort(ids, kind="stable")
    small = np.abs(rows).max(initial=0) < 1 << 15
    columns = np.ascontiguousarray(rows[order].T).astype("<i2" if small else "<f8")
    return pa.table(
        {
            "block": part.column("block").slice(0, 1),
            "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
            "columns": pa.array([columns.tobytes()], pa.binary()),
            "width": pa.array([rows.shape[1]], pa.int32()),
        }
    )


def _read(ids: bytes, columns: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    kind = "<i2" if len(columns) == 2 * len(ids) * width else "<f8"
    return ids, np.frombuffer(columns, kind).astype(float).reshape(width, len(ids))


def in_blocks(rows: DataFrame, n: int) -> DataFrame:
    """`(block, ids, columns, width)`: the rows dealt by hash to n blocks."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n)))
    return dealt.groupBy("block").applyInArrow(_block, "block long, ids binary, columns binary, width int")


def _exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers too large for doubles, held within 64 bits."""
    whole = np.array([[int(x) for x in row] for row in q], dtype=object).reshape(q.shape)
    other = np.array([[int(x) for x in row] for row in c], dtype=object).reshape(c.shape)
    scores = whole.dot(other) if q.shape[1] else np.zeros((len(q), c.shape[1]), dtype=object)
    return np.clip(scores, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int = K) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the ids and scores of its k best candidates; `c` is (dimensions, candidates), ids ascending."""
    width = max(q.shape[1], c.shape[0])
    q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
    c = np.pad(c, ((0, width - c.shape[0]), (0, 0)))
    with np.errstate(over="ignore", invalid="ignore"):
        limit = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(width, 1)
    if not limit < _EXACT:
        scores = _exact_scores(q, c)
        return [_top(cid[keep], row[keep], k) for row, keep in ((s, cid != i) for s, i in zip(scores, qid, strict=True))]
    starts = range(0, width, DIMS)
    # Lengths of what is left from each group of dimensions on.
    left_q = [np.sqrt((q[:, s:] ** 2).sum(axis=1)) for s in starts]
    left_c = [np.sqrt((c[s:] ** 2).sum(axis=0)) for s in starts]
    # The first group is scored for all queries at once, the rest for each one's survivors.
    first = q[:, :DIMS] @ c[:DIMS]
    out = []
    for r in range(len(q)):
        alive = np.flatnonzero(cid != qid[r])
        part = first[r, alive]
        for g, s in enumerate(starts):
            if g:
                part = part + q[r, s : s + DIMS] @ c[s : s + DIMS, alive]
            if g + 1 < len(starts) and len(alive) > k:
                more = left_q[g + 1][r] * left_c[g + 1][alive] * (1 + 1e-9) + 1e-9
                certain = np.partition(part - more, len(alive) - k)[len(alive) - k]
                stay = part + more >= certain
                if not stay.all():
                    alive, part = alive[stay], part[stay]
        out.append(_top(cid[alive], part.astype(np.int64), k))
    return out


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest scores first, ties by smaller id; ids come ascending."""
    if len(ids) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, level = np.flatnonzero(scores > floor), np.flatnonzero(scores == floor)
        pick = np.concatenate([above, level[: k - len(above)]])
        ids, scores = ids[pick], scores[pick]
    order = np.lexsort((ids, -scores.astype(object) if scores.min(initial=0) == -(1 << 63) else -scores))[:k]
    return ids[order], scores[order]


def _score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            cid, c = _read(row["ids"], row["columns"], row["width"])
            qid, q = _read(row["q_ids"], row["q_columns"], row["q_width"])
            found = best(qid, q.T, cid, c)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(qid, [len(ids) for ids, _ in found])),
                    pa.array(np.concatenate([ids for ids, _ in found])),
                    pa.array(np.concatenate([scores for _, scores in found])),
                ],
                names=["query_id", "vec_id", "score"],
            )


def top_k(vectors: DataFrame, step: int = QUERY_STEP) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: the best `K` other rows of every row whose id is divisible by `step`."""
    rows = written(valid(vectors), "vectors")
    asked = rows.where(F.col("vec_id") % step == 0)
    n, n_asked = max(1, -(-rows.count() // CANDIDATES)), max(1, -(-asked.count() // QUERIES))
    blocks = in_blocks(rows, n)
    # Each block of queries goes to every block of candidates: the stated set against all rows.
    questions = in_blocks(asked, n_asked).select(
        *[F.col(c).alias(f"q_{c}") for c in ("ids", "columns", "width")],
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("block"),
    )
    scored = blocks.join(questions, "block").mapInArrow(_score, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K)
    return ranked.select("query_id", "rank", "vec_id", "score")
