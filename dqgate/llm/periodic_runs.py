"""Periodic runs: stretches of words that repeat with some period, three times or more.

A run is a stretch of consecutive words with smallest period `q` and at least `max(24, 3 * q)`
words that no neighbouring word extends. All are found, by multi-scale minimizers:

* periods under 8 are scanned for directly, one lag at a time;
* the scale `w` (8, 16, 32, ...) finds the periods from `w` to `2 * w - 1`. Of each window of
  `w` neighbouring `w`-grams the least by hash is selected (the leftmost of equals). Inside a
  run the windows one period apart hold the same words, so equal selected grams stand exactly
  one period apart there: pairs of equal grams at such a distance are the seeds;
* a seed is extended to both sides as far as the words agree one lag apart. What is long
  enough and has no shorter period is a run.

Grams that lie in a run found before with a third of their length as period or less are never
selected: a stretch that consists of such grams has that shorter period itself. So equal grams
stand at least a third of their length apart, and a scale has a few seeds per selected gram.

Words are compared themselves; hashes only choose seeds and bound extensions, which are then
compared word by word. The documents of a batch are laid end to end and worked on together, at
most `BATCH_WORDS` words at a time unless one document alone has more; memory is some 200 bytes
for each word of these. Documents don't move between tasks.

Defined results: words are separated by the six ASCII blanks. Null and empty texts have no
words, no runs and an empty collapsed text. Rows that repeat and rows without `doc_id` each
give a row. Columns other than `doc_id` and the text are not read, so their names don't matter.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 24
LEAST_TIMES = 3
FIRST_SCALE = 8
BATCH_WORDS = 1 << 18

RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def least_length(period: np.ndarray | int) -> np.ndarray:
    return np.maximum(LEAST_WORDS, LEAST_TIMES * np.asarray(period))


def stretches(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edge = np.diff(np.concatenate([[0], true.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def has_period(x: np.ndarray, start: int, end: int, period: int) -> bool:
    head = min(end, start + period + 16)
    return np.array_equal(x[start : head - period], x[start + period : head]) and np.array_equal(
        x[start : end - period], x[start + period : end]
    )


def _smaller(period: int) -> list[int]:
    """`period` divided by each of its prime factors."""
    found, rest, factor = [], period, 2
    while factor * factor <= rest:
        if rest % factor == 0:
            found.append(period // factor)
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return found + ([period // rest] if rest > 1 else [])


def _names(x: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Hashes of the 1-, 2-, 4-, ... grams that start at each place of the parts that can hold them."""

    def mixed(v: np.ndarray) -> np.ndarray:
        v = (v ^ (v >> np.uint64(29))) * _MIX[0]
        return v ^ (v >> np.uint64(32))

    names = [mixed(x.astype(np.uint64) * _MIX[1] + _MIX[0])]
    while 1 << len(names) <= sizes[0]:
        step, v = 1 << (len(names) - 1), names[-1][: _reach(sizes, 1 << len(names))]
        names.append(mixed(v[:-step] * _MIX[1] + (v[step:] ^ (v[:-step] >> np.uint64(17)))))
    return names


def _reach(sizes: np.ndarray, least: int) -> int:
    """How far the parts of at least so many words reach; they come first."""
    long = int(np.searchsorted(-sizes, -least, side="right"))
    return int(sizes[:long].sum()) + long


def _selected(values: np.ndarray, window: int) -> np.ndarray:
    """Places of the least of each window of values, ascending; the leftmost of equals."""
    bits = np.uint64(len(values).bit_length())
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    key = ((values >> bits) << bits) | np.arange(len(values), dtype=np.uint64)
    key[values == top] = top
    whole = np.full(-(-len(key) // window) * window, top)
    whole[: len(key)] = key
    blocks = whole.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: len(key) - window + 1], ahead[window - 1 : len(key)])
    least = least[least != top]
    return np.unique(least[np.append(True, least[1:] != least[:-1])] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _seeds(values: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """`(place, lag)` of equal selected grams with a lag from `scale` to `2 * scale - 1`."""
    place = _selected(values, scale)
    order = np.argsort(values[place], kind="stable")
    place = place[order]
    value = values[place]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    left, step = np.arange(len(place) - 1), 1
    while len(left):
        left = left[left + step < len(place)]
        lag = place[left + step] - place[left]
        near = (value[left] == value[left + step]) & (lag < 2 * scale)
        left, lag = left[near], lag[near]
        far = lag >= scale
        at, lag = place[left[far]], lag[far]
        # A seed beside one with the same lag is extended to the same stretch.
        again = np.zeros(len(at), bool)
        again[1:] = (at[1:] == at[:-1] + 1) & (lag[1:] == lag[:-1])
        found.append((at[~again], lag[~again]))
        step += 1
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([p for p, _ in found]), np.concatenate([g for _, g in found])


def _extended(names: list[np.ndarray], place: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretch around each seed whose words agree one lag apart."""
    ahead, behind = place.copy(), place.copy()
    for level in range(len(names) - 1, -1, -1):
        size, v = 1 << level, names[level]
        fits = np.flatnonzero(ahead + lag < len(v))
        same = fits[v[ahead[fits]] == v[ahead[fits] + lag[fits]]]
        ahead[same] += size
        fits = np.flatnonzero((behind - size >= 0) & (behind - size + lag < len(v)))
        same = fits[v[behind[fits] - size] == v[behind[fits] - size + lag[fits]]]
        behind[same] -= size
    return behind, ahead + lag


def _compared(x: np.ndarray, start: int, end: int, lag: int, place: int) -> tuple[int, int]:
    """The stretch itself, should a hash have agreed where the words don't."""
    if has_period(x, start, end, lag):
        return start, end
    agree = x[: len(x) - lag] == x[lag:]
    before = np.flatnonzero(~agree[:place])
    after = np.flatnonzero(~agree[place:])
    return int(before[-1]) + 1 if len(before) else 0, (place + int(after[0]) if len(after) else len(agree)) + lag


def runs_of(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows `(start, end, period)` of the runs in `x`, whose parts have `sizes` words, the longest first.

    Behind each part stands a value of its own. A scale looks only at parts that are long enough for it.
    """
    rows: list[tuple[int, int, int]] = []
    longest = int(sizes[0])

    def keep(start: int, end: int, lag: int) -> None:
        if not any(has_period(x, start, end, q) for q in _smaller(lag)):
            rows.append((start, end, lag))

    for lag in range(1, min(FIRST_SCALE, longest // LEAST_TIMES + 1)):
        reach = _reach(sizes, max(LEAST_WORDS, LEAST_TIMES * lag))
        starts, ends = stretches(x[: max(reach - lag, 0)] == x[lag : max(reach, lag)])
        long = ends - starts + lag >= least_length(lag)
        for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            keep(s, e + lag, lag)
    if longest < LEAST_TIMES * FIRST_SCALE:
        return np.array(rows, np.int64).reshape(-1, 3)
    names = _names(x, sizes)
    scale = FIRST_SCALE
    while LEAST_TIMES * scale <= longest:
        values = names[scale.bit_length() - 1][: _reach(sizes, max(LEAST_WORDS, LEAST_TIMES * scale))]
        if len(values) < scale:
            break
        if scale >= LEAST_WORDS:
            inside = np.zeros(len(values) + 1, np.int64)
            for s, e, q in rows:
                if LEAST_TIMES * q <= scale <= e - s and s < len(values):
                    inside[s] += 1
                    inside[min(e - scale + 1, len(values))] -= 1
            values = np.where(np.cumsum(inside[:-1]) > 0, np.uint64(0xFFFFFFFFFFFFFFFF), values)
        place, lag = _seeds(values, scale)
        start, end = _extended(names, place, lag)
        long = end - start >= least_length(lag)
        found = {(s, g): (e, p) for s, e, g, p in zip(*(v[long].tolist() for v in (start, end, lag, place)), strict=True)}
        exact = {(*_compared(x, s, e, g, p), g) for (s, g), (e, p) in found.items()}
        for s, e, g in sorted(exact):
            if e - s >= least_length(g):
                keep(s, e, g)
        scale *= 2
    return np.array(rows, np.int64).reshape(-1, 3)


def _together(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, a value of its own behind each text, and where each begins."""
    flat = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode().indices.to_numpy()
    sizes = np.array([len(words) for words in texts])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    x = np.empty(int(sizes.sum()) + len(texts), np.int64)
    parted = np.zeros(len(x), bool)
    parted[begins + sizes] = True
    x[~parted] = flat
    x[parted] = -1 - np.arange(len(texts))
    return x, begins


def _rows(ids: list[int | None], texts: list[list[bytes]]) -> pa.RecordBatch:
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    ids, texts = [ids[k] for k in order], [texts[k] for k in order]
    sizes = np.array([len(words) for words in texts])
    x, begins = _together(texts)
    runs = runs_of(x, sizes) if sizes[0] >= LEAST_WORDS else np.empty((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    dropped = np.zeros(len(x) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 1], -1)
    dropped = np.cumsum(dropped) > 0
    at = np.searchsorted(begins, runs[:, 0], side="right") - 1
    collapsed = []
    touched = set(at.tolist())
    for k, words in enumerate(texts):
        if k in touched:
            gone = dropped[begins[k] : begins[k] + len(words)]
            words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        collapsed.append(b" ".join(words))
    parts = [runs[:, 0] - begins[at], runs[:, 1] - runs[:, 0], runs[:, 2]]
    offsets = np.searchsorted(at, np.arange(len(texts) + 1))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(words) for words in texts], pa.int64()),
            pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(p) for p in parts], fields=list(_RUNS.value_type))
            ),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def _found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: list[int | None] = []
    texts: list[list[bytes]] = []
    words = 0
    for batch in batches:
        for id_, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
            found = (text.as_py() or b"").split()
            if texts and words + len(found) > BATCH_WORDS:
                yield _rows(ids, texts)
                ids, texts, words = [], [], 0
            ids.append(id_)
            texts.append(found)
            words += len(found)
    if texts:
        yield _rows(ids, texts)


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """`(doc_id, n_words, runs, collapsed)` of each document; runs by start, then period.

    `collapsed` has the words, joined by one blank, without those that any run holds after
    its first period.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(_found, RESULT)
