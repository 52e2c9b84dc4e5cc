"""The trie of all conversations' prefixes, with what shared prefixes would save.

Every distinct sequence of a conversation's first `d` turns is a node of depth `d`. The
conversations are sorted by their sequences of turn digests, so the members of a node are
neighbours, and the turns that two neighbours share (their LCP) are the edges of a forest:

* in each sorted partition, union-find takes the edges in descending depth. A component is
  raised to the depth of the edge, which closes the nodes on its way, and then merged with its
  neighbour: every merge makes or widens a branching node;
* nodes on the way to the first or last row of a partition may go on in the next one. They are
  left open: the forest is contracted to those two paths, which carry at each depth what hangs
  there already;
* the paths of up to `FAN` neighbouring partitions are merged in the same way, whose outermost
  paths stay open in turn, until one block is left and the root is closed.

So a task holds one sorted partition or `2 * FAN` paths, however many conversations share a
prefix. What is shuffled are digests of 16 bytes and a size per turn, not texts. The ids of a node
that lies in several partitions come in a text per partition and are hashed as they stream by.

Defined results: rows without `conv_id` belong to no conversation and are left out; null roles
and texts are empty. Turns are ordered by `turn` (null first), then role, then text digest, so
repeated rows are repeated turns. Empty texts make nodes like others. Very long texts are only
digested; a very long conversation is one row of 20 bytes per turn. Conversations without turns
end at the root. Only the four columns named are read, so further ones may have any name. No
conversations, no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqgate.llm.common import text_or_empty, written

FAN = 64
DIGEST = 16
NO_IDS = hashlib.sha256(b"").hexdigest()

_NODE, _PATH, _IDS = 0, 1, 2
_OUT = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64())]
    # a closed node; `node` names it if it was open, `up` its parent if that was
    + [("node", pa.string()), ("up", pa.string()), ("ends_sha256", pa.string())]
    + [(c, pa.int64()) for c in ("conv_id", "parent_conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    # a path: what hangs at its depths
    + [("key", pa.binary()), ("sizes", pa.list_(pa.int32()))]
    + [(c, pa.list_(pa.int64())) for c in ("at", "n", "low", "kids", "leaves", "saved")]
    # ids that end at a node, in order from `first`
    + [("first", pa.int64()), ("ids", pa.string())]
)
_DDL = (
    "kind int, block long, node string, up string, ends_sha256 string, conv_id long, parent_conv_id long, depth long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, key binary, sizes array<int>, at array<long>, "
    "n array<long>, low array<long>, kids array<long>, leaves array<long>, saved array<long>, first long, ids string"
)


# ---- sequences ---------------------------------------------------------------


def turn_lists(conversations: DataFrame) -> DataFrame:
    """`(conv_id, turns)`: each conversation's turns in order, as `(digest, size)`."""
    role, text = text_or_empty("role"), text_or_empty("text")
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct("turn", role.alias("role"), F.unhex(F.substring(F.sha2(told, 256), 1, 2 * DIGEST)).alias("digest"), F.length(text).alias("size"))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


# ---- forests -----------------------------------------------------------------


@dataclass
class _Hanging:
    """What hangs at a node: members, closed children and their sums."""

    n: int = 0
    low: int | None = None
    kids: int = 0
    leaves: int = 0
    saved: int = 0

    def add(self, other: _Hanging) -> None:
        self.n += other.n
        if other.low is not None:
            self.low = other.low if self.low is None else min(self.low, other.low)
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved


@dataclass
class _Row:
    """A sorted sequence and what hangs at depths on its way."""

    key: bytes
    sizes: list[int]
    at: dict[int, _Hanging]
    ids: list[int] = field(default_factory=list)


@dataclass
class _Component:
    """Neighbouring rows that share their first `depth` turns."""

    first: int
    last: int
    depth: int
    here: _Hanging
    rows: list[_Row]
    ids: list[int]
    children: list[int] = field(default_factory=list)


def shared_turns(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * DIGEST : mid * DIGEST] == b[low * DIGEST : mid * DIGEST]:
            low = mid
        else:
            high = mid - 1
    return low


def _name(key: bytes, depth: int) -> str:
    return hashlib.sha256(key[: depth * DIGEST]).hexdigest()[:32]


class _Forest:
    """Union-find over the edges between sorted rows; `final` leaves nothing open."""

    def __init__(self, rows: list[_Row], block: int, level: int, final: bool) -> None:
        self.rows, self.block, self.level, self.final = rows, block, level, final
        self.nodes: list[dict] = []
        self.ids: list[dict] = []
        self.paths: tuple[dict[int, _Hanging], dict[int, _Hanging]] = ({}, {})

    def run(self) -> None:
        rows = self.rows
        lcp = np.array([shared_turns(a.key, b.key) for a, b in zip(rows, rows[1:], strict=False)], np.int64)
        root = list(range(len(rows)))
        of: list[_Component | None] = []
        for i, row in enumerate(rows):
            depth = len(row.key) // DIGEST
            here = _Hanging()
            if depth in row.at:
                here.add(row.at[depth])
            of.append(_Component(i, i, depth, here, [row] if len(row.at) > (depth in row.at) else [], row.ids))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for edge in np.argsort(-lcp, kind="stable").tolist():
            depth = int(lcp[edge])
            i, j = find(edge), find(edge + 1)
            a, b = of[i], of[j]
            self.raise_to(a, depth)
            self.raise_to(b, depth)
            a.last = b.last
            a.here.add(b.here)
            a.ids.extend(b.ids)
            a.rows += b.rows
            small, large = sorted((a.children, b.children), key=len)
            large.extend(small)
            a.children = large
            of[j] = None
            root[j] = i
        whole = of[find(0)]
        self.raise_to(whole, -1)

    def raise_to(self, c: _Component, depth: int) -> None:
        """Closes the component's nodes below `depth`, or hangs what they have on the open paths."""
        while c.depth > depth:
            left, right = c.first == 0, c.last == len(self.rows) - 1
            if (left or right) and not self.final:
                self.leave_open(c, 0 if left else 1)
            else:
                self.close(c)
            c.depth -= 1
            for row in c.rows:
                if c.depth in row.at:
                    c.here.add(row.at[c.depth])

    def close(self, c: _Component) -> None:
        h = c.here
        key = self.rows[c.first].key
        leaves = h.leaves if h.kids else 1
        saved = h.saved + (h.n - 1) * self.rows[c.first].sizes[c.depth - 1] if c.depth else h.saved
        node = {"conv_id": h.low, "depth": c.depth, "n_convs": h.n, "n_children": h.kids, "n_leaves": leaves, "saved_tokens": saved}
        if self.level:
            node["node"] = _name(key, c.depth)
        else:
            node["ends_sha256"] = hashlib.sha256(",".join(map(str, c.ids)).encode()).hexdigest() if c.ids else NO_IDS
        for child in c.children:
            self.nodes[child]["parent_conv_id"] = h.low
        self.nodes.append(node)
        c.children, c.ids = [len(self.nodes) - 1], []
        c.here = _Hanging(h.n, h.low, 1, leaves, saved)

    def leave_open(self, c: _Component, side: int) -> None:
        self.paths[side][c.depth] = c.here
        name = _name(self.rows[c.first if side == 0 else c.last].key, c.depth) if c.children or c.ids else None
        for child in c.children:
            self.nodes[child]["up"] = name
        if c.ids:
            self.ids.append({"node": name, "first": c.ids[0], "ids": ",".join(map(str, c.ids))})
        c.children, c.ids, c.here = [], [], _Hanging()

    def out(self) -> Iterator[pa.RecordBatch]:
        self.run()
        # A block's name is unlike those of other levels.
        name = self.level * (1 << 40) + self.block
        paths = []
        for side, row in ((0, self.rows[0]), (1, self.rows[-1])):
            if at := sorted(self.paths[side].items()):
                parts = {c: [getattr(h, c) for _, h in at] for c in ("n", "low", "kids", "leaves", "saved")}
                paths.append({"key": row.key, "sizes": row.sizes, "at": [d for d, _ in at]} | parts)
        rows = [{"kind": kind, "block": self.block if kind == _PATH else name} | r for kind, rs in ((_NODE, self.nodes), (_PATH, paths), (_IDS, self.ids)) for r in rs]
        for k in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_pylist(rows[k : k + 10_000], schema=_OUT)


def _leaves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of one sorted partition of `(conv_id, key, sizes)`."""
    rows = []
    for batch in batches:
        for id_, key, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "sizes")), strict=True):
            rows.append(_Row(key, sizes, {len(key) // DIGEST: _Hanging(1, id_)}, [id_]))
    if rows:
        yield from _Forest(rows, TaskContext.get().partitionId(), 0, False).out()


def _merged(level: int, final: bool, fan: int):
    """The forest of neighbouring blocks' paths."""

    def run(table: pa.Table) -> pa.Table:
        rows = []
        for r in table.to_pylist():
            hanging = [_Hanging(*v) for v in zip(r["n"], r["low"], r["kids"], r["leaves"], r["saved"], strict=True)]
            rows.append(_Row(r["key"], r["sizes"], dict(zip(r["at"], hanging, strict=True))))
        rows.sort(key=lambda r: r.key)
        block = table.column("block")[0].as_py() // fan
        return pa.Table.from_batches(list(_Forest(rows, block, level, final).out()), _OUT)

    return run


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids, whose texts follow one another."""
    last, state = None, hashlib.sha256()
    done: list[tuple[str, str]] = []
    for batch in batches:
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids"), strict=True):
            if node != last:
                if last is not None:
                    done.append((last, state.hexdigest()))
                last, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_py().encode())
    if last is not None:
        done.append((last, state.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["node", "ends"])


def prefix_trie(sequences: DataFrame, fan: int = FAN) -> DataFrame:
    """The nodes of the trie of `sequences (conv_id, turns)`, ids being distinct.

    `(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`:
    the smallest member and the parent's, the members, the children, the childless nodes of the
    subtree, the sum over the subtree of each node's members but one times the size of its last
    turn, and the digest of the ids that end there (ascending, comma-joined).
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    rows = sequences.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    ordered = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    made = written(ordered.mapInArrow(_leaves, _DDL), "trie")
    found, level = made, 1
    while True:
        paths = made.where(F.col("kind") == _PATH)
        final = (paths.agg(F.max("block")).first()[0] or 0) < fan
        grouped = paths.groupBy(F.floor(F.col("block") / fan).alias("group"))
        made = written(grouped.applyInArrow(_merged(level, final, fan), _DDL), "trie")
        found = found.unionByName(made)
        if final:
            return _joined(found)
        level += 1


def _joined(found: DataFrame) -> DataFrame:
    """Nodes with what was only known once their parent or they themselves were closed."""
    nodes = found.where(F.col("kind") == _NODE)
    ids = found.where(F.col("kind") == _IDS).select("node", "first", "ids")
    hashed = ids.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node string, ends string")
    tops = nodes.where("node IS NOT NULL").select(F.col("node").alias("up"), F.col("conv_id").alias("top"))
    # One row per block and open parent, so the root's children are joined block by block.
    parents = nodes.where("up IS NOT NULL").select("block", "up").distinct().join(tops.hint("merge"), "up")
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    within = nodes.where("up IS NULL AND node IS NULL").select(*columns)
    below = nodes.where("up IS NOT NULL").join(parents.hint("merge"), ["block", "up"])
    below = below.withColumn("parent_conv_id", F.col("top")).drop("top").unionByName(nodes.where("up IS NULL AND node IS NOT NULL"))
    named = below.where("node IS NOT NULL").join(hashed.hint("merge"), "node", "left")
    named = named.withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_IDS))).select(*columns)
    return within.unionByName(below.where("node IS NULL").select(*columns)).unionByName(named)
