"""Near duplicates by SimHash fingerprints, found with BK-trees.

A fingerprint is 64 bits over the hashed 3-word shingles of a text. Two that differ in at
most 3 bits agree on at least one of four 16-bit parts, so fingerprints are dealt to
shards by part and value, and a BK-tree per shard finds the links. A shard that holds
too many fingerprints is dealt again by four parts of its remaining bits, until none
does: nothing is capped, and no tree exceeds `MAX_TREE` nodes. Trees stay in the task that
holds the shard, since all trees together grow with the documents and have no bound that
would allow a broadcast.

Equal fingerprints are one node, so large groups of copies cost one row each. A tree
gives each member's link to the smallest member it hangs together with instead of
all pairs.

Defined results: a text without words (also null or empty) has fingerprint zero and is
linked like any other. Rows are kept as they are: repeated rows appear repeatedly. A null
`doc_id` takes part; the class id is the smallest `doc_id` that is not null, or null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqgate.llm.common import written
from dqgate.llm.components import connected_components

RADIUS = 3
SHINGLE = 3
SEED = 42
PARTS = RADIUS + 1
# Most nodes of a tree.
MAX_TREE = 1024
_CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """Bits set in over half of the shingle hashes."""
    found = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not found:
        return 0
    if len(found) < SHINGLE:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[k:] for k in range(SHINGLE)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t.as_py()) for t in batch.column("text")], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """`(doc_id, fp)` per row, fp as the signed form of the 64 bits."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")


# ---- shards ------------------------------------------------------------------
#
# A shard is a path (which part was fixed at each level, as digits to base PARTS behind
# a leading 1) and the value of all bits fixed so far.


def _fixed_bits(path: int) -> int:
    """Mask of the bits that a path has fixed."""
    digits = []
    while path > 1:
        path, digit = divmod(path, PARTS)
        digits.append(digit)
    free, mask = list(range(64)), 0
    for digit in reversed(digits):
        at = [round(k * len(free) / PARTS) for k in (digit, digit + 1)]
        for bit in free[slice(*at)]:
            mask |= 1 << bit
        free = free[: at[0]] + free[at[1] :]
    return mask


def _dealt(fps: DataFrame, paths: list[int]) -> DataFrame:
    """Each `(path, fp)` once for every part of the path's remaining bits."""
    masks = {p * PARTS + k: _fixed_bits(p * PARTS + k) for p in paths for k in range(PARTS)}
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    lookup = F.create_map(*[F.lit(x) for p, m in masks.items() for x in (p, signed(m))])
    dealt = fps.select(F.explode(F.array(*[F.col("path") * PARTS + k for k in range(PARTS)])).alias("path"), "fp")
    return dealt.select("path", F.col("fp").bitwiseAND(F.element_at(lookup, F.col("path"))).alias("bits"), "fp")


def shards(fps: DataFrame, max_tree: int = MAX_TREE) -> DataFrame:
    """`(path, bits, fp)`: every pair within the radius shares a shard of at most `max_tree`."""
    paths, here = [1], fps.select(F.lit(1).cast("long").alias("path"), "fp")
    ready: DataFrame | None = None
    while True:
        level = written(_dealt(here, paths), "shards")
        hot = written(level.groupBy("path", "bits").count().where(F.col("count") > max_tree).drop("count"), "hot")
        some = not hot.isEmpty()
        small = level.join(hot, ["path", "bits"], "left_anti") if some else level
        ready = small if ready is None else ready.unionByName(small)
        if not some:
            return ready
        paths = [p * PARTS + k for p in paths for k in range(PARTS)]
        # A fingerprint may lie in several hot shards of one path's children; each is dealt on.
        here = level.join(hot, ["path", "bits"], "left_semi").select("path", "fp")


# ---- trees -------------------------------------------------------------------


class BKTree:
    """Fingerprints, children keyed by their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def near(self, fp: int, radius: int) -> list[int]:
        """All members within the radius; only edges that can lead to one are followed."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            node, children = todo.pop()
            d = (node ^ fp).bit_count()
            if d <= radius:
                found.append(node)
            if len(children) <= 2 * radius:
                todo.extend(child for at, child in children.items() if -radius <= at - d <= radius)
            else:
                todo.extend(children[at] for at in range(d - radius, d + radius + 1) if at in children)
        return found

    def add(self, fp: int) -> None:
        if self.root is None:
            self.root = (fp, {})
            return
        node, children = self.root
        while d := (node ^ fp).bit_count():
            if d not in children:
                children[d] = (fp, {})
                return
            node, children = children[d]


def _hung_together(members: list[int], radius: int) -> tuple[Callable[[int], int], list[tuple[int, int]]]:
    """What gives a member's smallest one, and the links that made them hang together."""
    root, taken = {}, []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    tree = BKTree()
    for fp in members:
        root[fp] = fp
        for other in tree.near(fp, radius):
            a, b = find(fp), find(other)
            if a != b:
                root[max(a, b)] = min(a, b)
                taken.append((fp, other))
        tree.add(fp)
    return find, taken


def linked(members: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """`(member, smallest member it hangs together with)` for all but the smallest ones."""
    find, _ = _hung_together(members, radius)
    return [(x, r) for x in members if (r := find(x)) != x]


def near_members(members: list[int], radius: int = RADIUS) -> list[tuple[int, int, int]]:
    """Pairs of members within the radius, as many as make all hang together that do by some, and their smallest one."""
    find, taken = _hung_together(members, radius)
    return [(a, b, find(a)) for a, b in taken]


def _tree_links(of: Callable[[list[int]], list[tuple]], names: list[str]):
    """Links within each shard; the rows of a shard follow one another."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if len(members) > 1 and (pairs := of([m & (1 << 64) - 1 for m in members])):
                found = np.array(pairs, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.T], names=names)

        for batch in batches:
            path, bits, fp = (batch.column(k).to_numpy() for k in ("path", "bits", "fp"))
            if not len(fp):
                continue
            cuts = np.flatnonzero((path[1:] != path[:-1]) | (bits[1:] != bits[:-1])) + 1
            starts, ends = np.append(0, cuts), np.append(cuts, len(fp))
            for k, (i, j) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
                if k or key != (path[i], bits[i]):
                    yield from out()
                    key, members = (path[i], bits[i]), []
                members.extend(fp[i:j].tolist())
        yield from out()

    return run


def _in_trees(fps: DataFrame, max_tree: int, of: Callable[[list[int]], list[tuple]], names: list[str]) -> DataFrame:
    dealt = shards(fps, max_tree)
    together = dealt.repartition("path", "bits").sortWithinPartitions("path", "bits", "fp")
    return together.mapInArrow(_tree_links(of, names), ", ".join(f"{c} long" for c in names))


def links(fps: DataFrame, max_tree: int = MAX_TREE) -> DataFrame:
    """`(a, b)` such that fingerprints hang together by links exactly if they do by these."""
    return _in_trees(fps, max_tree, linked, ["a", "b"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`(doc_id, fp, component_id)` per row of `docs`."""
    prints = written(fingerprints(docs), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = connected_components(links(nodes.select("fp"))).select(F.col("node").alias("fp"), "root")
    placed = written(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "placed")
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = placed.join(least, "root").select("fp", "component_id")
    return prints.join(written(classes, "classes"), "fp").select("doc_id", "fp", "component_id")


def near_pairs(texts: DataFrame) -> DataFrame:
    """Distinct links `(a, b, fa, fb, bucket)` of `texts (node, text)` with equal fingerprints or such within `RADIUS`.

    Texts hang together by these exactly if they do by all such links, so a large group gives
    rows in proportion to its size. Where a link must pass a check too, alike texts may hang together
    by unlike ones only, so the other pairs count as well: any two texts within the radius have
    their fingerprints, `fa` or `fb`, in rows of one bucket, as `jaccard_join.groups` looks for them.
    """
    prints = texts.select(F.col("node").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id binary, fp long")
    prints = written(prints.distinct(), "fingerprints")
    firsts = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    alone = [F.col("fp").alias(c) for c in ("fa", "fb", "bucket")]
    equal = prints.join(firsts.hint("merge"), "fp").select(F.col("first").alias("a"), F.col("doc_id").alias("b"), *alone)
    of = lambda end: firsts.select(F.col("fp").alias(f"f{end}"), F.col("first").alias(end)).hint("merge")
    found = _in_trees(firsts.select("fp"), MAX_TREE, near_members, ["fa", "fb", "bucket"]).join(of("a"), "fa").join(of("b"), "fb")
    both = equal.unionByName(found).where("a <> b")
    ends = [F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("fa", "fb"), ("fb", "fa"))]
    return both.select(*ends, "bucket").distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group stays: that with the smallest `doc_id`; columns as given.

    Of rows that repeat a `doc_id` and stay, one does. Rows without `doc_id` stay if their
    group has no id at all; of those with one text, one stays.
    """
    found = near_duplicates(docs)
    winners = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id"))
    # A merge at every size, so that the plan that large inputs need is the one that always runs.
    ids = written(winners.distinct(), "winners").hint("merge")
    own = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("own")
    packed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), own)
    kept = packed.join(ids, packed["id"].eqNullSafe(ids["id"]), "left_semi")
    several = written(kept.groupBy("id", "own").count().where("count > 1").select("id", "own"), "several")
    if not several.isEmpty():
        repeated = kept["id"].eqNullSafe(several["id"]) & kept["own"].eqNullSafe(several["own"])
        digest = F.struct(F.xxhash64("doc.text"), F.to_json("doc"))
        first = kept.join(several, repeated, "left_semi").groupBy("id", "own").agg(F.min_by("doc", digest).alias("doc"))
        kept = kept.join(several, repeated, "left_anti").select("doc").unionByName(first.select("doc"))
    return kept.select("doc.*")
