"""Best-fit packing into sequences of several permitted lengths.

Documents are dealt by hash to groups of about `GROUP` rows, each packed by one task, so the
work is spread whatever the data. Within a group pieces are placed longest first into the
open bin that they leave the least room in. A piece that fits nowhere opens a bin: of the
permitted lengths that hold it, the one that costs least per token when filled with
what is left of the group, longest first. At the end each bin shrinks to the shortest permitted
length that holds its contents. A sequence costs a fixed part, its length, and a part
that grows with the square of its length, as attention does.

Documents longer than the longest sequence are cut into pieces of that length and a rest.

Defined results: a document without tokens (also null or empty) has one row with 0 tokens
and no bin. Repeated rows are packed each for itself. A null `doc_id` is kept.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqgate.llm.common import words, written

LENGTHS = (512, 1024, 2048, 4096, 8192)
GROUP = 4096
SCHEMA = (
    "doc_id long, piece int, first_token long, n_tokens long, bin_id string, bin_offset long, "
    "bin_used long, bin_length long"
)


@dataclass(frozen=True)
class Cost:
    fixed: float = 64.0
    # Length at which the square part is as large as the length itself.
    square: float = 32_768.0

    def of(self, length: int) -> float:
        return self.fixed + length + length * length / self.square


def pack(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, cost: Cost = Cost()) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:  # noqa: B008
    """`(bin, offset)` per piece, none longer than the longest length, and `(used, length)` per bin."""
    lengths = tuple(sorted(lengths))
    place: list[tuple[int, int]] = [(-1, 0)] * len(sizes)
    used: list[int] = []
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    falling = [-sizes[i] for i in order]

    def filled(at: int, length: int) -> int:
        """Contents of a bin of this length that takes the piece at `at` and then, longest first, what fits."""
        free, at = length + falling[at], at + 1
        while free > 0 and (at := bisect_left(falling, -free, at)) < len(falling):
            free += falling[at]
            at += 1
        return length - free

    for k, i in enumerate(order):
        size = sizes[i]
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free = min((n for n in lengths if n >= size), key=lambda n: (cost.of(n) / filled(k, n), n))
            b = len(used)
            used.append(0)
        place[i] = (b, used[b])
        used[b] += size
        if free > size:
            insort(room, (free - size, b))
    return place, [(n, next(x for x in lengths if x >= n)) for n in used]


def _packed(rows: pa.Table) -> pa.Table:
    most = max(LENGTHS)
    rows = rows.sort_by([("row", "ascending")])
    group, total = rows.column("group")[0].as_py(), rows.column("n_tokens").to_numpy()
    n_pieces = np.maximum(1, -(-total // most))
    of = np.repeat(np.arange(len(total)), n_pieces)
    piece = np.arange(len(of)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
    first = piece * most
    size = np.minimum(total[of] - first, most)
    some = np.flatnonzero(size > 0)
    place, bins = pack(size[some].tolist())
    bin_of, offset = np.zeros(len(of), dtype=np.int64), np.zeros(len(of), dtype=np.int64)
    if len(some):
        bin_of[some], offset[some] = np.array(place, dtype=np.int64).T
    table = np.array(bins or [(0, 0)], dtype=np.int64)
    none = size == 0
    return pa.table(
        {
            "doc_id": rows.column("doc_id").take(pa.array(of)),
            "piece": pa.array(piece.astype(np.int32)),
            "first_token": pa.array(first),
            "n_tokens": pa.array(size),
            "bin_id": pa.array([None if n else f"{group}-{b}" for b, n in zip(bin_of.tolist(), none, strict=True)], pa.string()),
            "bin_offset": pa.array(offset, mask=none),
            "bin_used": pa.array(table[bin_of, 0], mask=none),
            "bin_length": pa.array(table[bin_of, 1], mask=none),
        }
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    """One row per piece: its tokens (words), bin, place in it, and the bin's length."""
    sized = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.size(words(F.col("text"))).cast("long").alias("n_tokens"),
        ),
        "sizes",
    )
    groups = max(1, -(-sized.count() // GROUP))
    dealt = sized.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(_packed, SCHEMA)
