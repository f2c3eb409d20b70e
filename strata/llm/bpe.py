"""Byte-level BPE over Spark columns: merges by a segment tree of pair ranks over byte positions.

Leaf i of a piece's tree holds (rank, position) of the pair that starts at byte i, or nothing; the root is the leftmost
pair of the least rank. A merge changes three leaves, those of the merged pair, of its right part and of its left
neighbour, and their ancestors, so a piece of n bytes takes O(n log n). Short pieces are merged many at a time, one
tree per row of a matrix; long ones one by one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import pieces as sized
from strata.llm.common import texts

#: Longest piece, in bytes, that is merged in a matrix.
SHORT = 64
#: Entries kept for words and for pieces in a Python worker.
KEPT = 120_000
#: Marks that end a word as a piece of their own.
MARKS = ".,;:!?"
#: Rows of a matrix of trees.
ROWS = 1 << 14

NONE = np.int64(1) << 62
_VOCABULARIES: dict[bytes, Vocabulary] = {}


def _ranks(content: bytes) -> dict[bytes, int]:
    rows = (line.split() for line in content.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in rows}


class Vocabulary:
    """Ranks of a rank file (base64 token and rank per line) with the pattern that cuts a text into pieces."""

    def __init__(self, content: bytes, pattern: str):
        self.ranks = _ranks(content)
        # \s as the library's engine has it: white space of Unicode, without the four separators \x1c to \x1f
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.array(rank, np.int64)[order], 0)
        self.pairs = dict(zip(keys.tolist(), rank))
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.of_bytes = self._pair_rank(np.repeat(self.single, 256), np.tile(self.single, 256))
        self.of_piece: dict[str, bytes] = {}
        self.of_word: dict[str, bytes] = {}

    # --- merging ---

    def merge_one(self, piece: bytes) -> list[int]:
        """Token ids of one piece of any length."""
        n = len(piece)
        if n < 2:
            return self.single[list(piece)].tolist()
        size = 1 << (n - 1).bit_length()
        none, pairs = (1 << 62), self.pairs
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * size)

        def leaf(i: int) -> int:
            j = after[i]
            rank = pairs.get(ids[i] << 32 | ids[j]) if j < n else None
            return none if rank is None else rank << 32 | i

        for i in range(n - 1):
            tree[size + i] = leaf(i)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: int) -> None:
            node = size + i
            tree[node] = value
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b

        while (best := tree[1]) != none:
            i = best & 0xFFFFFFFF
            j = after[i]
            ids[i] = best >> 32
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            ids[j] = -1
            put(j, none)
            put(i, leaf(i))
            if (h := before[i]) >= 0:
                put(h, leaf(h))
        return [x for x in ids if x >= 0]

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merge_many(self, found: list[bytes]) -> tuple[bytes, np.ndarray]:
        """Token ids of some short pieces of two bytes or more, one tree per row: all ids, and where each piece's end."""
        n, lengths = len(found), np.array([len(p) for p in found])
        most = int(lengths.max())
        size = 1 << (most - 1).bit_length()
        flat = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in found), np.uint8).reshape(n, size)
        cells = np.arange(size)
        ids = np.where(cells < lengths[:, None], self.single[flat], -1)
        # one cell beyond the end takes what is written past it
        after = np.tile(np.minimum(np.arange(1, size + 2), size), (n, 1))
        after[:, :size] = np.minimum(after[:, :size], lengths[:, None])
        before = np.tile(np.arange(-1, size), (n, 1))
        ids = np.hstack([ids, np.full((n, 1), -1)])
        tree = np.full((n, 2 * size), NONE)
        rank = self.of_bytes[flat[:, :-1].astype(np.int64) << 8 | flat[:, 1:]]
        rank = np.where((cells[:-1] + 1 < lengths[:, None]) & (rank >= 0), rank << 32 | cells[:-1], NONE)
        tree[:, size : 2 * size - 1] = rank
        for node in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])

        def leaf(r: np.ndarray, i: np.ndarray) -> np.ndarray:
            j = after[r, i]
            rank = self._pair_rank(ids[r, i], ids[r, j])
            return np.where((j < lengths[r]) & (rank >= 0), rank << 32 | i, NONE)

        live = np.flatnonzero(tree[:, 1] != NONE)
        while len(live):
            best = tree[live, 1]
            i = best & 0xFFFFFFFF
            j = after[live, i]
            k = after[live, j]
            ids[live, i] = best >> 32
            after[live, i] = k
            before[live, k] = i
            ids[live, j] = -1
            tree[live, size + j] = NONE
            tree[live, size + i] = leaf(live, i)
            h = before[live, i]
            has = h >= 0
            tree[live[has], size + h[has]] = leaf(live[has], h[has])
            node = np.concatenate([size + i, size + j, size + h[has]])
            row = np.concatenate([live, live, live[has]])
            while node[0] > 1:
                node >>= 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            live = live[tree[live, 1] != NONE]
        held = ids[:, :size] >= 0
        return ids[:, :size][held].astype("<i4").tobytes(), np.cumsum(held.sum(axis=1))

    # --- texts ---

    def _learn_pieces(self, new: list[str]) -> None:
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for piece in new:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.of_piece[piece] = rank.to_bytes(4, "little")
            elif len(raw) > SHORT:
                self.of_piece[piece] = np.array(self.merge_one(raw), "<i4").tobytes()
            else:
                by_size.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for group in by_size.values():
            for at in range(0, len(group), ROWS):
                some = group[at : at + ROWS]
                flat, ends = self.merge_many([raw for _, raw in some])
                start = 0
                for (piece, _), end in zip(some, (4 * ends).tolist()):
                    self.of_piece[piece] = flat[start:end]
                    start = end

    def _of_cuts(self, cuts: list) -> list[bytes]:
        """Ids of each sequence of pieces."""
        self._learn_pieces(_unknown(self.of_piece, set().union(*cuts)))
        known = self.of_piece.__getitem__
        return [b"".join(map(known, cut)) for cut in cuts]

    def _cut_word(self, word: str) -> list[str] | tuple[str, ...]:
        """Pieces of a word with a space before it; letters, and letters with a mark, without the pattern's help."""
        if word.isalpha():
            return (" " + word,)
        if word[-1] in MARKS and word[:-1].isalpha():
            return " " + word[:-1], word[-1]
        return self.pattern.findall(" " + word)

    def encode_texts(self, found: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text.

        Where a text has no space beside another blank, each space begins the piece that follows it, so a word with its
        space is cut alike wherever it stands, and its ids are kept.
        """
        words: list = [t.split(" ") for t in found]
        first = [ws[0] for ws in words]
        seen = set().union(*(ws[1:] for ws in words))
        odd = {w for w in seen if w.strip() != w or not w}
        plain = [i for i, ws in enumerate(words) if len(ws) > 1 and (ws[0][-1:].isspace() or odd and not odd.isdisjoint(ws[1:]))]
        for i in plain:
            first[i], words[i] = found[i], words[i][:1]
        new = _unknown(self.of_word, seen - odd)
        self.of_word.update(zip(new, self._of_cuts(list(map(self._cut_word, new)))))
        known = self.of_word.__getitem__
        heads = self._of_cuts(list(map(self.pattern.findall, first)))
        return [head + b"".join(map(known, ws[1:])) for head, ws in zip(heads, words)]


def _unknown(known: dict, seen: set) -> list:
    """What of ``seen`` is not in ``known``, which keeps no more than what is in use once it is full."""
    new = [x for x in seen if x not in known]
    if len(known) + len(new) > KEPT:
        held = {x: known[x] for x in seen if x in known}
        known.clear()
        known.update(held)
    return new


def _vocabulary(content: bytes, pattern: str) -> Vocabulary:
    """One per Python worker, with what it has learnt of words."""
    key = hashlib.sha256(content + b"\0" + pattern.encode()).digest()
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Vocabulary(content, pattern)
    return _VOCABULARIES[key]


def _shipped(df: DataFrame, path: str):
    """The rank file's bytes, read by the driver; a file of some hundred kilobytes, whatever the table's size."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and ``ids`` array<int>: the text's tokens by the ranks in ``path``.

    Each match of ``pattern`` is encoded for itself, without special tokens. NULL and empty texts have no ids. Each row is
    encoded on its own, so rows may repeat; other columns of ``docs`` are not read.
    """
    shipped = _shipped(docs, path)
    held = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, held)], F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shipped.value, pattern)
        for batch in sized(batches, "text", 2 << 20):
            coded = vocabulary.encode_texts([t.decode() for t in texts(batch.column("text"))])
            ends = np.cumsum([0, *map(len, coded)]) // 4
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<i4")))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in held], ids], [*held, "ids"])
        pa.default_memory_pool().release_unused()

    coded = rows.mapInArrow(run, rows.select(*held).schema.add("ids", T.ArrayType(T.IntegerType())))
    return coded.select(*[F.col(n).alias(c) for c, n in zip(keep, held)], "ids")


def decode(coded: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """The ``keep`` columns and ``bytes``: the concatenated bytes of the ids. NULL gives NULL; an unknown id is an error."""
    shipped = _shipped(coded, path)
    held = [f"c{i}" for i in range(len(keep))]
    rows = coded.select(*[F.col(c).alias(n) for c, n in zip(keep, held)], F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in _ranks(shipped.value).items()}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = some.column("ids")
                ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())]).tolist()
                found = list(map(tokens.__getitem__, ids.flatten().to_numpy().tolist()))
                out = [b"".join(found[a:b]) if known else None for a, b, known in zip(ends, ends[1:], ids.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*[some.column(n) for n in held], pa.array(out, pa.binary())], [*held, "bytes"])

    out = rows.mapInArrow(run, rows.select(*held).schema.add("bytes", "binary"))
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, held)], "bytes")
