"""Periodic runs of words by string synchronising sets, and texts without their repetitions.

A run is a stretch of consecutive words with smallest period q, at least ``REPEATS`` q long, that no neighbouring word extends.
At scale t, a power of two, a position is in the synchronising set where the smallest hash of the stretches of t words that begin
at it and at the t positions behind it lies at either end. That depends on 2t words alone, so that a run of a period between
2t and 4t holds two chosen positions of equal words a period apart; equal contexts within 4t are more than t/3 apart, so a position
has a bounded number of partners. Each pair proposes its distance as a period, and comparing words to both sides decides.
Stretches of a period up to t/3 choose no position: hashes inside them are left out, and their runs are known from smaller
scales, the smallest periods from comparing all words with those some places on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import pieces, texts

#: A run has so many periods at least, and so many words.
REPEATS, SHORTEST = 3, 24
#: Periods below this are found by comparing all words; a power of two.
DIRECT = 8
#: Positions handled at a time, where arrays of intermediate values are needed.
CHUNK = 1 << 18
#: Bytes of a text whose words are in memory as objects at a time.
SLICE = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_NONE = np.uint64((1 << 64) - 1)
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


# --- runs of a sequence ---


def _mixed(x: np.ndarray) -> np.ndarray:
    """One to one on 64 bits, in place."""
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(times)
    x ^= x >> np.uint64(31)
    return x


def _joined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the stretches of twice the width, from those of ``width``; overwrites its input."""
    n = len(hashes) - width
    for at in range(0, n, CHUNK):
        end = min(n, at + CHUNK)
        left = hashes[at:end] * np.uint64(0x9E3779B97F4A7C15)
        hashes[at:end] = _mixed(left + hashes[at + width : end + width])
    return hashes[:n]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values, by running minima from both ends of blocks of that width."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, _NONE)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def synchronising(hashes: np.ndarray, scale: int, periodic: list[tuple[int, int]]) -> np.ndarray:
    """The chosen positions, ascending. ``hashes`` are those of ``scale`` words, ``periodic`` the positions (from, to) at which a
    stretch of that length has a period of a third of it at most."""
    found, n = [], len(hashes) - scale
    starts = np.array([a for a, _ in periodic], np.int64)
    ends = np.array([b for _, b in periodic], np.int64)
    step = max(CHUNK, 4 * scale)
    for at in range(0, n, step):
        upto = min(n, at + step)
        own = hashes[at : upto + scale] >> np.uint64(1)
        for k in np.flatnonzero((starts < upto + scale) & (ends > at)):
            own[max(0, starts[k] - at) : max(0, ends[k] - at)] = _NONE
        least = _least(own, scale + 1)
        chosen = (least != _NONE) & ((own[: upto - at] == least) | (own[scale : scale + upto - at] == least))
        found.append(np.flatnonzero(chosen) + at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def equal_contexts(positions: np.ndarray, contexts: np.ndarray, nearest: int, farthest: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of positions with equal contexts at a distance from ``nearest`` to below ``farthest``."""
    none = np.zeros(0, np.int64)
    if not len(positions):
        return none, none
    order = np.argsort(contexts, kind="stable")
    contexts, positions = contexts[order], positions[order]
    equal = contexts[1:] == contexts[:-1]
    some = np.concatenate((equal, [False])) | np.concatenate(([False], equal))
    contexts, positions = contexts[some], positions[some]
    first, apart, lag = [], [], 1
    while lag < len(positions):
        distance = positions[lag:] - positions[:-lag]
        near = (contexts[lag:] == contexts[:-lag]) & (distance < farthest)
        if not near.any():
            break
        near &= distance >= nearest
        first.append(positions[:-lag][near])
        apart.append(distance[near])
        lag += 1
    return (np.concatenate(first), np.concatenate(apart)) if first else (none, none)


def _reach(w: np.ndarray, i: int, q: int) -> int:
    """The first place from ``i`` on at which a word differs from the one q places behind it."""
    n, step = len(w) - q, 64
    while i < n:
        end = min(n, i + step)
        differs = w[i:end] != w[i + q : end + q]
        k = int(differs.argmax())
        if differs[k]:
            return i + k
        i, step = end, min(2 * step, CHUNK)
    return n


def _back(w: np.ndarray, i: int, q: int) -> int:
    """The smallest place from which on, up to ``i``, words equal those q places behind them."""
    step = 64
    while i > 0:
        start = max(0, i - step)
        differs = (w[start:i] != w[start + q : i + q])[::-1]
        k = int(differs.argmax())
        if differs[k]:
            return i - k
        i, step = start, min(2 * step, CHUNK)
    return 0


def runs(w: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, by period; of any length from ``REPEATS`` periods on.

    ``longest`` bounds the length of a run, where it is known, as for texts behind each other with separators between.
    """
    longest = min(len(w), longest or len(w))
    found: list[tuple[int, int, int]] = []
    seen: set[tuple[int, int]] = set()

    def add(start: int, end: int, q: int) -> None:
        """The words of a stretch have the period q; if a smaller one, it is known with the same ends."""
        if (start, end) not in seen:
            seen.add((start, end))
            found.append((start, end - start, q))

    for q in range(1, min(DIRECT, longest // REPEATS + 1)):
        equal = np.concatenate(([False], w[q:] == w[:-q], [False]))
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for start, end in edges.reshape(-1, 2)[np.diff(edges)[::2] >= (REPEATS - 1) * q].tolist():
            add(start, end + q, q)
    scale, hashes = 1, _mixed(w.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    while 2 * REPEATS * scale <= longest:
        if 4 * scale <= DIRECT:  # the periods of this scale are known
            hashes, scale = _joined(hashes, scale), 2 * scale
            continue
        periodic = [(s, s + n - scale + 1) for s, n, q in found if 3 * q <= scale <= n]
        chosen = synchronising(hashes, scale, periodic)
        hashes = _joined(hashes, scale)
        firsts, periods = equal_contexts(chosen, hashes[chosen], 2 * scale, 4 * scale)
        order = np.lexsort((firsts, periods))
        last, upto = 0, 0
        for i, q in zip(firsts[order].tolist(), periods[order].tolist()):
            if q == last and i < upto:
                continue
            last, upto = q, _reach(w, i, q)
            start = _back(w, i, q)
            if upto - start >= (REPEATS - 1) * q:
                add(start, upto + q, q)
        scale *= 2
    return found


# --- texts ---


def _sliced(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(text):
        end = at + SLICE
        blank = _BLANK.search(text, end) if end < len(text) else None
        end = blank.start() if blank else len(text)
        yield text[at:end].split()
        at = end


class _Numbers(dict):
    """A number for each word, in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _numbered(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words as numbers, a number of its own behind each text, and where each text begins (one more at the end)."""
    number, parts, starts, n = _Numbers().__getitem__, [], [0], 0
    for i, text in enumerate(found):
        for words in _sliced(text):
            parts.append(np.fromiter(map(number, words), np.int32, len(words)))
            n += len(words)
        parts.append(np.array([-1 - i], np.int32))
        n += 1
        starts.append(n)
    return np.concatenate(parts), np.array(starts, np.int64)


def _collapsed(found: list[bytes], shortest: int) -> tuple[list[int], pa.Array, list[bytes]]:
    """Of each text the number of words, its runs by start and period, and the words outside of repetitions."""
    w, starts = _numbered(found)
    sizes = np.diff(starts) - 1
    every = [r for r in runs(w, int(sizes.max())) if r[1] >= shortest]
    start, length, period = (np.array(c, np.int64) for c in zip(*every)) if every else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    edge = np.zeros(len(w) + 1, np.int32)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    stays = np.cumsum(edge[:-1]) == 0
    place = np.searchsorted(starts, start, "right") - 1
    offsets = np.searchsorted(place, np.arange(len(found) + 1)).astype(np.int32)
    fields = [pa.array(v) for v in (start - starts[place], length, period)]
    listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    kept = []
    for i, text in enumerate(found):
        if offsets[i] == offsets[i + 1]:
            kept.append(b" ".join(b" ".join(words) for words in _sliced(text) if words))
            continue
        at, parts = int(starts[i]), []
        for words in _sliced(text):
            keep = stays[at : at + len(words)].tolist()
            parts += [b" ".join([word for word, k in zip(words, keep) if k])]
            at += len(words)
        kept.append(b" ".join(filter(None, parts)))
    return sizes.tolist(), listed, kept


def collapse(docs: DataFrame, text_col: str = "text", shortest: int = SHORTEST, carry: list[str] | None = None) -> DataFrame:
    """(row, n_words, runs, kept): each row's ``carry`` columns (all by default), the runs of its text's words as (start, length,
    period), by start and then period, and the words that stay, joined by one space.

    Words lie between the six ASCII blanks and are compared as they are, numbered from 0. A run has at least ``shortest`` words
    and three periods; words of a run behind its first period go, those of several runs if any says so. Texts are worked on
    whole, each by itself: rows may repeat, NULL counts as empty, a text without words has no runs and an empty ``kept``, and an
    empty table gives an empty one.
    """
    rows = docs.select(F.struct(*(carry or docs.columns)).alias("row"), F.col(text_col).alias("text"))
    schema = rows.select("row").schema.add("n_words", T.LongType())
    schema = schema.add("runs", T.StructType.fromDDL(f"runs {RUNS}")["runs"].dataType).add("kept", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            counts, listed, kept = _collapsed(texts(batch.column("text")), shortest)
            arrays = [batch.column("row"), pa.array(counts, pa.int64()), listed, pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "n_words", "runs", "kept"])

    return rows.mapInArrow(run, schema)
