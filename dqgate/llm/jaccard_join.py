"""Documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more: exact join.

The universe of shingles is dealt to segments by hash, so each set falls into one subset per
segment. Sets of sizes `r >= s` that are alike enough differ in at most `(r + s) / 9` shingles,
so with more segments than that they agree in one of them (pigeonhole). Sizes are dealt to bands
of ratio 5/4; a band has one segment more than any of its pairs can differ in, and a set meets
its own band and the one below.

* Index: every set gives each of its segments' subsets, and of a few segments in each band (one
  in `DELETING`) also the subsets less one shingle (one-deletion neighbourhood).
* Probe: a set needs as many units as a partner of its size may differ in, and one more. A
  segment met by its subset is one unit; met also by one-deletion neighbourhoods, that is with one
  difference allowed, two. The cheapest units are taken; the cost of a segment is how often its
  subset stands in the rows that the task reads together. So segments that many texts share
  (common passages, empty subsets) are left to the others wherever that is possible.
* Texts that meet are candidates unless their sketches (counts of shingles by hash, which differ by
  no more than the sets do) rule the similarity out. They are verified on their whole texts, in rounds: first
  neighbours that share their least shingle, then one pair for each text and group that hangs
  together so far, then all pairs not yet together. So a large group of copies costs rows in
  proportion to its size. Buckets of more than `WIDE` texts give their entries and neighbours by
  size, and are only looked at as a whole once that is done, in blocks of `BLOCK`: first the
  closest partner of each text by its sketch, then all pairs that still don't hang together.

Texts stay where they are, but for those that a candidate pair asks for (a Bloom filter of fixed
size picks these from the scan). Signatures are shuffled packed, about eight bytes each. A task
holds `PART_ENTRIES` of them; of a subset that one batch of texts shares often, only `OFTEN` go
that way and all go as rows, so no bucket is held as a whole. Those `OFTEN` say so, and such a
bucket is a wide one however few of its entries came packed: nothing is lost.

A text is named by 128 bits of its SHA-256, a shingle by 64 bits; hashes of subsets only make
candidates, which are then compared.

Defined results: words are separated by the six ASCII blanks, A-Z count as a-z. A text of fewer
than five words has one shingle, all its words; null texts and texts without words have an
empty set and are alone. Rows that repeat are linked and all returned. Rows without `doc_id`
count as texts; a component's id is the smallest `doc_id` in it, null if it has none. Only
`doc_id` and the text are read, so other columns may have any name. No rows give no rows.
Long texts are held one batch at a time (`CHUNK_SHINGLES`, or one text that alone has more).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqgate.llm.common import written
from dqgate.llm.components import connected_components

SHINGLE = 5
# Similarity from which texts are linked: 4 / 5; then sets differ in a ninth of their sizes' sum.
PART, WHOLE = 4, 5
NINTH = PART + WHOLE
# One segment in so many has its one-deletion neighbourhoods indexed.
DELETING = 32
# Shingles that a segment must hold to be met with one difference allowed.
LEAST = 3
CHUNK_SHINGLES, CHUNK_TEXTS = 1 << 20, 1 << 12
PART_ENTRIES = 1 << 22
OFTEN, WIDE = 64, 32
# Shingles for each counter of a sketch that is sent along, and of one kept for later, at most;
# and the least number of counters.
COUNTED, FINE, COUNTERS = 4, 2, 16
BLOOM_BITS = 1 << 26
BLOCK = 1 << 13
# Times that one pair for each group is verified before all that are left.
ROUNDS = 1

_U = np.uint64
_M = tuple(_U(v) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
# What an entry does under its key: stands there with its subset, asks for such, asks for
# subsets less one, stands there with its subset less one, asks for whole ones with it.
_IS, _ASKS, _ASKS_LESS, _IS_LESS, _LESS_ASKS = 1, 2, 4, 8, 16
_ASKING = _ASKS | _ASKS_LESS | _LESS_ASKS
# Of its key more entries went as rows than came packed; one of those rows asks.
_CROWD, _CROWD_ASKS = 32, 64


# What it costs to meet a subset of 0, 1, 2, ... shingles that no other text here holds: small
# ones are the likelier to stand in others.
_RARE = np.array([1 << 20, 64, 8, 2, 1])


def _bands() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low, lows, highs = 1, [], []
    while low < 1 << 31:
        lows.append(low)
        highs.append(low * WHOLE // PART)
        low = highs[-1] + 1
    high = np.array(highs)
    return np.array(lows), high, (high + high * WHOLE // PART) // NINTH + 1


LOW, HIGH, SEGMENTS = _bands()
DELETED = np.where(SEGMENTS > 1, np.maximum(SEGMENTS // DELETING, 1), 0)


def _mixed(v: np.ndarray, k: int) -> np.ndarray:
    v = (v ^ (v >> _U(31))) * _M[k]
    v = (v ^ (v >> _U(29))) * _M[k - 1]
    return v ^ (v >> _U(32))


def shingles(text: bytes) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    words = text.lower().split()
    if not words:
        return np.empty(0, _U)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words))
    n = min(SHINGLE, len(words))
    h = w[: len(w) - n + 1].copy()
    for k in range(1, n):
        h = h * _M[0] + w[k : len(w) - n + 1 + k]
    return np.unique(_mixed(h + _U(n), 2))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b) or PART * max(len(a), len(b)) > WHOLE * min(len(a), len(b)):
        return False
    both = np.sort(np.concatenate([a, b]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return WHOLE * shared >= PART * (len(a) + len(b) - shared)


# ---- sketches ----------------------------------------------------------------


def counters(size: np.ndarray | int, counted: int = COUNTED) -> np.ndarray:
    """Length of the sketch of a set: a power of two."""
    least = np.maximum(-(-np.asarray(size) // counted), COUNTERS)
    return 1 << np.ceil(np.log2(least)).astype(np.int64)


def sketch(found: np.ndarray, counted: int = COUNTED) -> bytes:
    """How many shingles fall to each counter, up to 255. Sets differ in as many as their counters do, or more."""
    n = int(counters(len(found), counted))
    at = (_mixed(found, 3) >> _U(65 - n.bit_length())).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=n), 255).astype(np.uint8).tobytes()


class _Sketches:
    """Sketches of sets by size; a longer one is folded to the length of a shorter."""

    def __init__(self, size: np.ndarray, told: np.ndarray, counted: int = COUNTED) -> None:
        self.size, self.n, self.told = size, counters(size, counted), told
        self.start = np.concatenate([[0], np.cumsum(self.n)[:-1]]).astype(np.int64)

    def rows(self, sets: np.ndarray, n: int) -> np.ndarray:
        """Sketches of `sets`, whose lengths are `n` or `2 * n`, at length `n`."""
        out = np.empty((len(sets), n), np.int16)
        for own in (n, 2 * n):
            here = np.flatnonzero(self.n[sets] == own)
            whole = self.told[self.start[sets[here]][:, None] + np.arange(own)].astype(np.int16)
            out[here] = whole if own == n else whole[:, ::2] + whole[:, 1::2]
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many shingles sets `a` and `b`, whose sizes allow the similarity, differ at least."""
        out = np.empty(len(a), np.int64)
        least = np.minimum(self.n[a], self.n[b])
        for n in np.unique(least).tolist():
            here = np.flatnonzero(least == n)
            for k in range(0, len(here), step := max(1, (1 << 19) // n)):
                at = here[k : k + step]
                out[at] = np.abs(self.rows(a[at], n) - self.rows(b[at], n)).sum(axis=1, dtype=np.int64)
        return out

    def may_be_alike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the sketches leave room for the similarity."""
        return self.apart(a, b) <= (self.size[a].astype(np.int64) + self.size[b]) // NINTH


# ---- signatures --------------------------------------------------------------


class _Subsets:
    """The subsets of sets by the segments of a band, of all sets of a chunk at once."""

    def __init__(self, tokens: np.ndarray, doc: np.ndarray, size: np.ndarray, band: np.ndarray, n_docs: int, docs: np.ndarray) -> None:
        m = np.zeros(n_docs, np.int64)
        m[docs] = SEGMENTS[band[docs]]
        base = np.concatenate([[0], np.cumsum(m)])
        self.doc = np.repeat(np.arange(n_docs), m)
        seg = np.arange(base[-1]) - base[self.doc]
        place = (band[self.doc].astype(_U) << _U(32)) + seg.astype(_U)
        at = base[doc] + ((_mixed(tokens, 1) >> _U(32)) * m[doc].astype(_U) >> _U(32)).astype(np.int64)
        value = _mixed(tokens, 3)
        total = np.zeros(base[-1], _U)
        np.add.at(total, at, value)
        self.key = _mixed(total + place * _M[1], 2)
        self.count = np.bincount(at, minlength=base[-1])
        # Only subsets of LEAST or more are met by neighbourhoods, so only these need be asked without one.
        deleting = (seg < DELETED[band[self.doc]]) & (self.count >= LEAST)
        less = deleting[at]
        self.less_of = at[less]
        self.less = _mixed(total[self.less_of] - value[less] + place[self.less_of] * _M[1], 2)
        self.deleting = np.flatnonzero(deleting)

    def probes(self, need: np.ndarray, index: tuple[np.ndarray, np.ndarray], own: int) -> tuple[np.ndarray, np.ndarray]:
        """Which segments are met by their subset, and which by one-deletion neighbourhoods too."""
        met = _RARE[np.minimum(self.count, len(_RARE) - 1)] + 16 * np.maximum(_times(index, self.key) - own, 0)
        near = np.zeros(len(self.key), np.int64)
        np.add.at(near, self.less_of, _times(index, self.less))
        rare = _RARE[np.minimum(np.maximum(self.count - 1, 0), len(_RARE) - 1)]
        more = np.maximum(met, self.count * rare + 16 * near)[self.deleting]
        unit = np.concatenate([np.arange(len(self.key)), self.deleting])
        cost = np.concatenate([met, more])
        second = np.arange(len(unit)) >= len(self.key)
        order = np.lexsort((second, cost, self.doc[unit]))
        doc = self.doc[unit[order]]
        first = np.searchsorted(doc, np.arange(len(need)))
        taken = order[np.arange(len(order)) - first[doc] < need[doc]]
        once, twice = np.zeros(len(self.key), bool), np.zeros(len(self.key), bool)
        once[taken[taken < len(self.key)]] = True
        twice[unit[taken[taken >= len(self.key)]]] = True
        return once, twice


def _times(index: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    values, counts = index
    at = np.minimum(np.searchsorted(values, keys), len(values) - 1)
    return np.where(values[at] == keys, counts[at], 0)


def entries(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`(key, set, flags)` of the sets' index and probe signatures; no set is empty."""
    size = np.array([len(s) for s in sets])
    tokens, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    band = np.searchsorted(LOW, size, side="right") - 1
    own = _Subsets(tokens, doc, size, band, len(sets), np.arange(len(sets)))
    index = np.unique(own.key, return_counts=True)
    once, twice = own.probes(2 * size // NINTH + 1, index, 1)
    out = [
        (own.key, own.doc, _IS + _ASKS * once + _ASKS_LESS * twice),
        (own.less, own.doc[own.less_of], _IS_LESS + _LESS_ASKS * twice[own.less_of]),
    ]
    lower = np.flatnonzero((band > 0) & (WHOLE * HIGH[band - 1] >= PART * size))
    if len(lower):
        of_lower = np.zeros(len(sets), bool)
        of_lower[lower] = True
        here = of_lower[doc]
        below = _Subsets(tokens[here], doc[here], size, np.maximum(band - 1, 0), len(sets), lower)
        once, twice = below.probes((size + HIGH[band - 1]) // NINTH + 1, index, 0)
        flags = _ASKS * once + _ASKS_LESS * twice
        asks = twice[below.less_of]
        out += [
            (below.key[flags > 0], below.doc[flags > 0], flags[flags > 0]),
            (below.less[asks], below.doc[below.less_of[asks]], np.full(int(asks.sum()), _LESS_ASKS)),
        ]
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


_SENT = pa.schema(
    [("part", pa.int32())]
    + [(c, pa.binary()) for c in ("nodes", "sizes", "sketches", "low", "high", "of", "flags")]
    + [("bucket", pa.int64()), ("node", pa.binary()), ("size", pa.int32()), ("flag", pa.int32())]
)
_SENT_DDL = "part int, nodes binary, sizes binary, sketches binary, low binary, high binary, of binary, flags binary, bucket long, node binary, size int, flag int"


def _packed(nodes: list[bytes], sets: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    key, of, flags = entries(sets)
    part = ((key >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
    names = np.frombuffer(b"".join(nodes), np.uint8).reshape(-1, 16)
    size = np.array([len(s) for s in sets], np.int32)
    sketches = [sketch(s) for s in sets]
    # Of a key that stands here often, all entries go as rows of their own, and some packed to tell:
    # without their mark a bucket that other batches fill sparsely would look small and whole.
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    first = np.searchsorted(sorted_key, sorted_key)
    rank = np.arange(len(key)) - first
    crowd = np.searchsorted(sorted_key, sorted_key, side="right") - first
    often = order[crowd > OFTEN]
    if len(often):
        rows = [_bucket(part[often], key[often]), [nodes[k] for k in of[often].tolist()], size[of[often]], flags[often].astype(np.int32)]
        blank = [pa.nulls(len(often), pa.binary())] * 7
        spread = pa.array((of[often] % parts).astype(np.int32))
        yield pa.RecordBatch.from_arrays([spread, *blank, pa.array(rows[0]), pa.array(rows[1], pa.binary()), pa.array(rows[2]), pa.array(rows[3])], schema=_SENT)
        heads = np.flatnonzero(rank == 0)
        asked = np.repeat(np.bitwise_or.reduceat(flags[order], heads), np.diff(np.append(heads, len(key)))) & _ASKING > 0
        flags[often] |= np.where(asked[crowd > OFTEN], _CROWD | _CROWD_ASKS, _CROWD)
        kept = order[rank < OFTEN]
        key, of, flags, part = key[kept], of[kept], flags[kept], part[kept]
    order = np.lexsort((of, part))
    key, of, flags, part = key[order], of[order], flags[order], part[order]
    ends = np.flatnonzero(np.append(part[1:] != part[:-1], True)) + 1
    rows, start = [], 0
    for end in ends.tolist():
        here, at = np.unique(of[start:end], return_inverse=True)
        rows.append(
            {
                "part": int(part[start]),
                "nodes": names[here].tobytes(),
                "sizes": size[here].tobytes(),
                "sketches": pa.compress(b"".join(sketches[k] for k in here.tolist()), "zstd", asbytes=True),
                "low": (key[start:end] & _U(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                "high": ((key[start:end] >> _U(32)) & _U(0xFF)).astype(np.uint8).tobytes(),
                "of": at.astype(np.uint16).tobytes(),
                "flags": flags[start:end].astype(np.uint8).tobytes(),
            }
        )
        start = end
    yield pa.RecordBatch.from_pylist(rows, schema=_SENT)


def _bucket(part: np.ndarray | int, key: np.ndarray) -> np.ndarray:
    return (np.asarray(part).astype(_U) << _U(40) | key & _U((1 << 40) - 1)).astype(np.int64)


def _signed(parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        nodes: list[bytes] = []
        sets: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                if node in seen:  # equal texts
                    continue
                seen.add(node)
                found = shingles(text.as_py())
                if not len(found):
                    continue
                if sets and (held + len(found) > CHUNK_SHINGLES or len(sets) >= CHUNK_TEXTS):
                    yield from _packed(nodes, sets, parts)
                    nodes, sets, held = [], [], 0
                nodes.append(node)
                sets.append(found)
                held += len(found)
        if sets:
            yield from _packed(nodes, sets, parts)

    return run


# ---- candidates --------------------------------------------------------------

_MET = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("bucket", pa.int64()), ("node", pa.binary()), ("size", pa.int32()), ("flag", pa.int32())])
_MET_DDL = "a binary, b binary, bucket long, node binary, size int, flag int"


def _asks(probe: np.ndarray, index: np.ndarray) -> np.ndarray:
    hit = lambda p, i: ((probe & p) > 0) & ((index & i) > 0)
    return hit(_ASKS, _IS) | hit(_ASKS_LESS, _IS_LESS) | hit(_LESS_ASKS, _IS)


def _candidates(blobs: list[dict], wide: int) -> Iterator[pa.RecordBatch]:
    """Pairs that meet in the buckets of one part; wide buckets give neighbours and their entries."""
    part = blobs[0]["part"]
    joined = lambda c, kind: np.concatenate([np.frombuffer(r[c], kind) for r in blobs])
    names = joined("nodes", ">u8").astype(_U).reshape(-1, 2)
    held = joined("sizes", np.int32)
    order = np.lexsort((names[:, 1], names[:, 0], held))
    fresh = np.append(True, (names[order][1:] != names[order][:-1]).any(axis=1))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(fresh) - 1
    name, size = names[order[fresh]], held[order[fresh]].astype(np.int64)
    shift = np.repeat(np.cumsum([0, *[len(r["sizes"]) // 4 for r in blobs[:-1]]]), [len(r["flags"]) for r in blobs])
    node = rank.astype(np.int32)[shift + joined("of", np.uint16)]
    del shift
    whole = [pa.decompress(r["sketches"], int(counters(np.frombuffer(r["sizes"], np.int32)).sum()), "zstd", asbytes=True) for r in blobs]
    # The sketches stand in the blobs' order, their first mention counts.
    told = _Sketches(held, np.frombuffer(b"".join(whole), np.uint8))
    mention = order[fresh]
    low, high, flags = joined("low", np.uint32), joined("high", np.uint8), joined("flags", np.uint8)
    blobs.clear()
    as_bytes = name.astype(">u8").tobytes()
    text = lambda ids: pa.array([as_bytes[16 * i : 16 * i + 16] for i in ids.tolist()], pa.binary())
    nothing = lambda n, kinds: [pa.nulls(n, k) for k in kinds]
    met: list[np.ndarray] = []
    # Keys are worked on a sixteenth at a time, so that little more than the entries is held.
    for k in range(16):
        here = np.flatnonzero(high >> 4 == k)
        key = low[here].astype(_U) | high[here].astype(_U) << _U(32)
        pairs, (key, who, flag) = _slice(key, node[here].astype(np.int64), flags[here], size, mention, told, wide)
        met.append(pairs)
        bucket = _bucket(part, key)
        for j in range(0, len(key), 1 << 16):
            i = slice(j, j + (1 << 16))
            own = [pa.array(bucket[i]), text(who[i]), pa.array(size[who[i]].astype(np.int32)), pa.array((flag[i] & (_CROWD - 1)).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*nothing(len(own[0]), _MET.types[:2]), *own], schema=_MET)
    pairs = np.unique(np.concatenate(met))
    for k in range(0, len(pairs), 1 << 16):
        p = pairs[k : k + (1 << 16)]
        yield pa.RecordBatch.from_arrays([text(p >> 32), text(p & 0xFFFFFFFF), *nothing(len(p), _MET.types[2:])], schema=_MET)


def _slice(
    key: np.ndarray, node: np.ndarray, flags: np.ndarray, size: np.ndarray, mention: np.ndarray, told: _Sketches, wide: int
) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs of these entries' buckets, and the entries of wide buckets."""
    if not len(key):
        return np.empty(0, np.int64), (key, node, flags)
    sort = np.lexsort((node, key)) if len(size) >> 24 else np.argsort(key << _U(24) | node.astype(_U))
    key, node, flags = key[sort], node[sort], flags[sort]
    # Equal texts of several tasks are one entry.
    start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
    flags = np.bitwise_or.reduceat(flags, start)
    key, node = key[start], node[start]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(first, len(key)))
    seen = np.bitwise_or.reduceat(flags, first)
    # Marked entries stand for others that are not here: such buckets are wide, and any that ask count.
    marked = (seen & _CROWD) > 0
    useful = ((count > 1) & _asks(seen, seen)) | (marked & ((seen & (_ASKING | _CROWD_ASKS)) > 0))
    crowd = np.repeat(np.where(useful, np.where(marked, np.maximum(count, wide + 1), count), 0), count)
    keep = crowd > 0
    key, node, flags, crowd = key[keep], node[keep], flags[keep], crowd[keep]
    left, right = [], []
    at, step = np.arange(len(key)), 1
    while len(at):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        a, b = at, at + step  # b is as large or larger
        sa, sb = size[node[a]], size[node[b]]
        near = PART * sb <= WHOLE * sa
        asks = near & (_asks(flags[b], flags[a]) | ((sa == sb) & _asks(flags[a], flags[b])))
        a, b = node[a[asks]], node[b[asks]]
        both = np.unique(a << 32 | b)
        a, b = both >> 32, both & 0xFFFFFFFF
        ok = told.may_be_alike(mention[a], mention[b])
        left.append(a[ok])
        right.append(b[ok])
        at = at[near & (crowd[at] <= wide)]
        step += 1
    pairs = np.unique(np.concatenate(left) << 32 | np.concatenate(right)) if left else np.empty(0, np.int64)
    open_ = crowd > wide
    return pairs, (key[open_], node[open_], flags[open_])


def _met(wide: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[dict] = []
        for batch in batches:
            rows = batch.filter(pa.compute.is_valid(batch.column("bucket"))).select(["bucket", "node", "size", "flag"])
            if rows.num_rows:
                none = pa.nulls(rows.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([none, none, *rows.columns], schema=_MET)
            for row in batch.filter(pa.compute.is_valid(batch.column("nodes"))).to_pylist():
                if blobs and blobs[0]["part"] != row["part"]:
                    yield from _candidates(blobs, wide)
                blobs.append(row)
        if blobs:
            yield from _candidates(blobs, wide)

    return run


def _candidate_table(texts: DataFrame, parts: int, wide: int) -> DataFrame:
    sent = texts.mapInArrow(_signed(parts), _SENT_DDL).repartitionById(parts, "part").sortWithinPartitions("part")
    return written(sent.mapInArrow(_met(wide), _MET_DDL), "met")


# ---- verification ------------------------------------------------------------


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, mine = None, np.empty(0, _U)
    for batch in batches:
        keep = []
        for a, ta, tb in zip(batch.column("a").to_pylist(), batch.column("ta").cast(pa.binary()), batch.column("tb").cast(pa.binary()), strict=True):
            if a != last:
                last, mine = a, shingles(ta.as_py())
            keep.append(alike(mine, shingles(tb.as_py())))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _places(node: pd.Series) -> list[np.ndarray]:
    words = np.frombuffer(b"".join(node), ">u8").astype(_U).reshape(-1, 2)
    return [(words[:, k] >> _U(s)) % _U(BLOOM_BITS) for k, s in ((0, 0), (0, 32), (1, 8))]


def _in_bloom(spark: SparkSession, ends: DataFrame):
    """A function that holds for all nodes of `ends (node)`, and few others.

    The filter has `BLOOM_BITS` at every size: past some ten million nodes it lets more through.
    """

    def bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.concatenate(_places(batch.column("node").to_pandas())).astype(np.int64)
                word = at >> 5
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(np.int64(1) << (at & 31))], names=["word", "bits"])

    words = ends.distinct().mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bloom = np.zeros(BLOOM_BITS // 32, np.uint32)
    bloom[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    sent = spark.sparkContext.broadcast(bloom)

    @F.pandas_udf("boolean")
    def maybe(node: pd.Series) -> pd.Series:
        found = np.ones(len(node), bool)
        for at in _places(node) if len(node) else ():
            found &= (sent.value[(at >> _U(5)).astype(np.int64)] >> (at & _U(31)).astype(np.uint32)) & 1 == 1
        return pd.Series(found)

    return maybe


def _close(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            n = batch.num_rows
            size = np.concatenate([batch.column(c).to_numpy() for c in ("na", "nb")])
            told = b"".join(batch.column("sa").to_pylist() + batch.column("sb").to_pylist())
            ok = _Sketches(size, np.frombuffer(told, np.uint8), FINE).may_be_alike(np.arange(n), n + np.arange(n))
            yield batch.select(["a", "b"]).filter(pa.array(ok))


def _closer(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Those of the distinct `pairs (a, b)` whose fine sketches allow the similarity."""
    sketches = members.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("s"))
    of = lambda end: sketches.select(F.col("node").alias(end), F.col("n").alias(f"n{end}"), F.col("s").alias(f"s{end}")).hint("merge")
    both = pairs.join(of("b"), "b").join(of("a"), "a").where(PART * F.greatest("na", "nb") <= WHOLE * F.least("na", "nb"))
    return both.mapInArrow(_close, "a binary, b binary")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the distinct `pairs (a, b)` that are alike; a text is moved where a pair asks for it."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    found = texts.where(_in_bloom(texts.sparkSession, ends)("node")).groupBy("node").agg(F.first("text").alias("text"))
    found = written(found, "texts")
    # A merge at every size, so that the plan that large inputs need is the one that always runs.
    of = lambda end: found.select(F.col("node").alias(end), F.col("text").alias(f"t{end}")).hint("merge")
    both = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "ta", "tb")
    return written(both.mapInArrow(_compared, "a binary, b binary"), "links")


def _rooted(rows: DataFrame, roots: DataFrame | None, column: str, root: str) -> DataFrame:
    if roots is None:
        return rows.withColumn(root, F.col(column))
    named = roots.select(F.col("node").alias(column), F.col("root").alias("found"))
    return rows.join(named.hint("merge"), column, "left").withColumn(root, F.coalesce("found", column)).drop("found")


def _apart(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    both = _rooted(_rooted(pairs, roots, "a", "ra"), roots, "b", "rb").where("ra <> rb")
    return both.select("a", "b", F.least("ra", "rb").alias("ra"), F.greatest("ra", "rb").alias("rb"))


def _some(pairs: DataFrame, turn: int) -> DataFrame:
    """One of the `pairs (a, b, ra, rb)` for each of the groups at its ends, another each turn."""
    first = F.min(F.struct(F.xxhash64("a", "b", F.lit(turn)), "a", "b")).alias("p")
    return pairs.groupBy("ra").agg(first).select("p.a", "p.b").union(pairs.groupBy("rb").agg(first).select("p.a", "p.b")).distinct()


def _open(entries: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Entries of buckets whose texts don't all hang together and that somebody asks for, with `root` and the bucket's number `n`."""
    placed = written(_rooted(entries, roots, "node", "root"), "open")
    main = placed.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.bit_or("flag").alias("all"), F.count("*").alias("n"))
    left = main.where((F.col("least") != F.col("most")) & (F.col("all").bitwiseAND(F.lit(_ASKING)) > 0))
    return written(placed.join(left.select("bucket", "n").hint("merge"), "bucket"), "open")


def _near_entries(near: DataFrame, members: DataFrame) -> DataFrame:
    """All texts of the buckets of `near (a, b, fa, fb, bucket)` as entries that ask for each other, with their `fp`."""
    shared = near.select("bucket", F.col("fa").alias("fp")).union(near.select("bucket", "fb")).distinct()
    ends = near.select(F.col("a").alias("node"), F.col("fa").alias("fp")).union(near.select("b", "fb")).distinct()
    sizes = members.where("n_shingles > 0").select("node", F.col("n_shingles").cast("int").alias("size")).distinct()
    inside = ends.join(sizes.hint("merge"), "node").join(shared.hint("merge"), "fp")
    return inside.select("bucket", "node", "size", F.lit(_IS | _ASKS).alias("flag"), "fp")


def _crossing(several: DataFrame, members: DataFrame, closest: bool, radius: int | None = None) -> DataFrame:
    """Pairs of open wide buckets that don't hang together and that their sketches allow.

    A bucket is dealt to blocks of about `BLOCK` entries, and tasks compare one block with one.
    With `closest`, a text gives one pair for each block that it is compared with. With a
    `radius`, entries may have a fingerprint `fp`, and those of a pair differ in no more bits.
    """
    sketches = members.select("node", "sketch").distinct()
    own = ["bucket", "low", "high", "block", "node", "size", "flag", "root", "sketch", *([] if radius is None else ["fp"])]
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    dealt = several.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    told = dealt.join(sketches.hint("merge"), "node").select(*own)
    return told.groupBy("bucket", "low", "high").applyInArrow(_met_apart(closest, radius), "a binary, b binary").distinct()


def _met_apart(closest: bool, radius: int | None):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "ascending"), ("node", "ascending")])
        size, flag, block = (table.column(c).to_numpy().astype(np.int64) for c in ("size", "flag", "block"))
        root = table.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
        same = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        told = _Sketches(size, np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8), FINE)
        if radius is not None:
            prints, known = table.column("fp").fill_null(0).to_numpy().view(_U), table.column("fp").is_valid().to_numpy()
        reach = np.searchsorted(size, WHOLE * size // PART, side="right")
        left, right = [], []
        for k in range(0, len(size), step := max(1, (1 << 16) // len(size))):
            some = np.arange(k, min(k + step, len(size)))
            many = reach[some] - some - 1
            i = np.repeat(some, many)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
            open_ = (root[j] != root[i]) & (same | (block[j] != block[i]))
            i, j = i[open_], j[open_]
            asks = _asks(flag[j], flag[i]) | ((size[j] == size[i]) & _asks(flag[i], flag[j]))
            i, j = i[asks], j[asks]
            if radius is not None:
                within = (np.bitwise_count(prints[i] ^ prints[j]) <= radius) | ~(known[i] & known[j])
                i, j = i[within], j[within]
            apart = told.apart(i, j)
            ok = apart <= (size[i] + size[j]) // NINTH
            i, j, apart = i[ok], j[ok], apart[ok]
            if closest and len(i):
                order = np.lexsort((apart, i))
                i, j = i[order], j[order]
                first = np.append(True, i[1:] != i[:-1])
                i, j = i[first], j[first]
            left.append(i)
            right.append(j)
        at = [pa.array(np.concatenate(v)) for v in (left, right)]
        first, second = (table.column("node").combine_chunks().take(v) for v in at)
        less = pa.compute.less(first, second)
        return pa.table({"a": pa.compute.if_else(less, first, second), "b": pa.compute.if_else(less, second, first)})

    return run


# ---- documents ---------------------------------------------------------------


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, least, told = [], [], []
        for text in batch.column("text").cast(pa.binary()):
            found = shingles(text.as_py() or b"")
            n.append(len(found))
            least.append(int(found[0] >> _U(1)) if len(found) else None)
            told.append(sketch(found, FINE))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("node"), pa.array(n, pa.int64()), pa.array(least, pa.int64()), pa.array(told, pa.binary())],
            names=["doc_id", "node", "n_shingles", "least", "sketch"],
        )


def _in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours `(a, b)` among the distinct texts of each least shingle, by size."""
    last: tuple = (None, None, 0)
    for batch in batches:
        a, b = [], []
        for row in zip(*(batch.column(c).to_pylist() for c in ("least", "node", "n_shingles")), strict=True):
            if row[1] != last[1] and row[0] == last[0] and PART * row[2] <= WHOLE * last[2]:
                a.append(min(row[1], last[1]))
                b.append(max(row[1], last[1]))
            last = row
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def node_of(text: F.Column) -> F.Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def groups(
    docs: DataFrame, text: str = "text", wide: int = WIDE, parts: int | None = None, first: Callable[[DataFrame], DataFrame] | None = None, radius: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """`(doc_id, node, n_shingles)` of all rows, and `(node, root)` of the texts that hang together.

    A node is a text; nodes without a root are linked to no other text. `first` may give distinct
    links `(a, b, fa, fb, bucket)` of `texts (node, text)` from another method, with fingerprints. They
    are verified before all others; of texts with a fingerprint in one bucket, all pairs within
    `radius` bits count that don't hang together in the end.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("node", node_of(F.coalesce("text", F.lit(""))))
    members = written(rows.mapInArrow(_summed, "doc_id long, node binary, n_shingles long, least long, sketch binary"), "members")
    texts = rows.where("text IS NOT NULL").select("node", "text")
    if parts is None:
        total = members.agg(F.sum("n_shingles")).first()[0] or 0
        parts = max(16, -(-int(total * 0.6) // PART_ENTRIES))
    links: DataFrame | None = None
    roots: DataFrame | None = None

    def link(pairs: DataFrame) -> bool:
        """Adds those of the distinct `pairs` that are alike; whether there were any pairs."""
        nonlocal links, roots
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            return False
        found = _verified(pairs, texts)
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            roots = connected_components(links)
        return True

    distinct = members.where("least IS NOT NULL").select("least", "n_shingles", "node").distinct()
    lined = distinct.repartitionByRange("least", "n_shingles", "node").sortWithinPartitions("least", "n_shingles", "node")
    pairs = lined.mapInArrow(_in_order, "a binary, b binary")
    if first is not None:
        near = written(first(texts), "near")
        pairs = pairs.unionByName(near.select("a", "b")).distinct()
    link(_closer(pairs, members))
    met = _candidate_table(texts, parts, wide)
    # At first each text stands for itself: few of these pairs hang together yet.
    pairs = met.where("a IS NOT NULL").select("a", "b").distinct().withColumn("ra", F.col("a")).withColumn("rb", F.col("b"))
    pairs = written(pairs, "pairs")
    for turn in range(ROUNDS):
        n, picked = pairs.count(), written(_some(pairs, turn), "picked")
        if n <= 2 * picked.count():
            break
        link(_closer(picked, members))
        pairs = written(_apart(pairs.select("a", "b"), roots), "pairs")
    link(_closer(pairs.select("a", "b"), members))
    wide_ones = met.where("bucket IS NOT NULL").select("bucket", "node", "size", "flag").distinct()
    if first is not None:
        wide_ones = wide_ones.withColumn("fp", F.lit(None).cast("long")).unionByName(_near_entries(near, members))
    for closest in (True, False):
        wide_ones = _open(wide_ones.drop("root", "n"), roots)
        if not link(_crossing(wide_ones, members, closest, radius)):
            break
    if roots is None:
        roots = members.where("false").select("node", F.col("node").alias("root"))
    return members.select("doc_id", "node", "n_shingles"), roots


def linked_documents(docs: DataFrame, text: str = "text", **options: int) -> DataFrame:
    """`(doc_id, n_shingles, component_id)` of every row of `docs`."""
    members, roots = groups(docs, text, **options)
    least = members.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc"))
    rooted = _rooted(least, roots, "node", "root")
    whole = rooted.groupBy("root").agg(F.min("doc").alias("component"))
    component = rooted.select("node", "root").join(whole.hint("merge"), "root").select("node", "component")
    full = members.where("n_shingles > 0").join(component.hint("merge"), "node")
    alone = members.where("n_shingles = 0").withColumn("component", F.col("doc_id"))
    return full.unionByName(alone).select("doc_id", "n_shingles", F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of near copies stays; columns as given.

    It is the one with the smallest `doc_id`, rows without one being last, and of several the one
    whose text has the smallest digest. Of rows that agree in both, one stays. Equal texts
    are copies, also those without words. Only rows that may have to go are moved.
    """
    members, roots = groups(docs, **options)
    rows = members.groupBy("doc_id", "node").agg(F.count("*").alias("n"))
    rooted = written(_rooted(rows, roots, "node", "root"), "rooted")
    best = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("best"))
    key = lambda id_, node: node_of(F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("-")), F.hex(node)))
    winners = written(best.select(key(F.col("best.doc_id"), F.col("best.node")).alias("node")), "winners")
    held = rooted.select(key(F.col("doc_id"), F.col("node")).alias("node"), "n")
    doubtful = written(held.join(winners.withColumn("wins", F.lit(True)).hint("merge"), "node", "left").where("n > 1 OR wins IS NULL"), "doubtful")
    own = key(F.col("doc_id").cast("long"), node_of(F.coalesce("text", F.lit(""))))
    packed = docs.select(F.struct("*").alias("doc"), own.alias("node"))
    maybe = _in_bloom(docs.sparkSession, doubtful.select("node"))
    clear = packed.where(~maybe("node")).select("doc")
    rest = packed.where(maybe("node")).join(winners.hint("merge"), "node", "left_semi")
    first = rest.groupBy("node").agg(F.min_by("doc", F.to_json("doc")).alias("doc"))
    return clear.unionByName(first.select("doc")).select("doc.*")
