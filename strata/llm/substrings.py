"""Repeated passages: words covered by a window of ``length`` words whose sequence also starts earlier are removed.

Candidates come from anchors. The anchor of a window is its rarest-ranked run of ``GRAM`` words, the one of the least hash,
so equal windows have equal anchors; only windows whose anchor occurs twice can be repeated. Neighbouring windows share an
anchor and are one fragment. Fragments with equal words are one, with its earliest place. Those that share an anchor but
differ are a reference shard: a suffix automaton takes them up in order, and streaming each one through it gives matching
statistics, whose values of ``length`` and more end windows that start earlier. A shard is never larger than ``SHARD``
fragments; windows of an anchor with more go through an exact aggregate by their words instead.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import pieces, settled, staged, texts

LENGTH = 20
#: Words in an anchor.
GRAM = 6
#: Fragments of one anchor that an automaton takes up.
SHARD = 256
#: The place of a NULL id among ids: last.
LAST = (1 << 63) - 1

_LOW = np.uint64(63)


class SuffixAutomaton:
    """Of strings added one after another; symbols are any hashable values."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def stream_and_add(self, symbols: list, least: int) -> list[bool]:
        """For each position, whether the ``least`` symbols ending there occur before; then they are part of the text.

        Before means in an earlier string, or ending at an earlier position of this one.
        """
        nexts, link, length = self.next, self.link, self.length
        found, last, state, matched = [], 0, 0, 0
        for c in symbols:
            while state and c not in nexts[state]:
                state = link[state]
                matched = length[state]
            if c in nexts[state]:
                state, matched = nexts[state][c], matched + 1
            found.append(matched >= least)
            last = self._extend(last, c)
            while state and matched <= length[link[state]]:
                state = link[state]
        return found

    def _extend(self, last: int, c) -> int:
        nexts, link, length = self.next, self.link, self.length
        if c in nexts[last]:  # an earlier string has it already
            q = nexts[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, q, c)
        here = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = here
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            link[here] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return here

    def _clone(self, p: int, q: int, c) -> int:
        nexts, link, length = self.next, self.link, self.length
        copy = len(nexts)
        nexts.append(dict(nexts[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = copy
            p = link[p]
        return copy


def _hashes(found: list[list[bytes]]) -> np.ndarray:
    ids = defaultdict()
    ids.default_factory = ids.__len__
    at = np.fromiter((ids[w] for ws in found for w in ws), np.int64)
    distinct = np.fromiter((xxhash.xxh64_intdigest(w) for w in ids), np.uint64, len(ids))
    return distinct[at]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if width > done else values


def anchors(found: list[list[bytes]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Document number, first window, windows, hash of each anchor of the texts' windows, and whether it soon comes again."""
    counts = np.array([len(ws) for ws in found], np.int64)
    words = _hashes(found)
    none = np.zeros(0, np.int64)
    if len(words) < length:
        return none, none, none, none, none.astype(bool)
    n = len(words) - gram + 1
    grams = np.zeros(n, np.uint64)
    for j in range(gram):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + words[j : n + j]
    grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    place = np.arange(n, dtype=np.uint64)
    best = _least(grams & ~_LOW | place & _LOW, length - gram + 1)
    windows = np.arange(len(best))
    at = windows + ((best & _LOW).astype(np.int64) - windows & 63)
    doc = np.repeat(np.arange(len(counts)), counts)
    inside = doc[: len(best)] == doc[length - 1 :]
    windows, at = windows[inside], at[inside]
    if not len(windows):
        return none, none, none, none, none.astype(bool)
    owner = doc[windows]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(windows)))
    begins = np.cumsum(counts) - counts
    hashes, again = grams[at[first]], np.zeros(len(first), bool)
    for p in range(1, length - gram + 1):
        again |= grams[np.minimum(at[first] + p, n - 1)] == hashes
    again &= many > 1
    return owner[first], windows[first] - begins[owner[first]], many, hashes.view(np.int64), again


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(text).alias("h"), text.alias("text")
    )


def _find_anchors(keyed: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4 << 20):
            doc, start, n, anchor, again = anchors([t.split() for t in texts(batch.column("text"))], length, GRAM)
            ids = [batch.column(c).take(pa.array(doc)) for c in ("d", "h")]
            rest = [pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(anchor), pa.array(again)]
            yield pa.RecordBatch.from_arrays([*ids, *rest], ["d", "h", "start", "n", "anchor", "again"])

    return keyed.mapInArrow(run, "d long, h long, start int, n int, anchor long, again boolean")


def _cut_fragments(marked: DataFrame, length: int) -> DataFrame:
    """A row per mark of (d, h, text, marks): the words of the anchor's windows, and whether a window repeats in them."""
    out = pa.schema(
        [("anchor", pa.int64()), ("key", pa.int64()), ("d", pa.int64()), ("h", pa.int64()), ("start", pa.int32())]
        + [("n", pa.int32()), ("words", pa.string()), ("within", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 2 << 20):
            rows: dict[str, list] = {name: [] for name in out.names}
            columns = (batch.column(c).to_pylist() for c in ("d", "h", "marks"))
            for d, h, marks, text in zip(*columns, texts(batch.column("text"))):
                words = text.split()
                joined = b" ".join(words)
                ends = np.cumsum([len(w) + 1 for w in words])
                begins = np.concatenate([[0], ends[:-1]]).tolist()
                ends = (ends - 1).tolist()
                for mark in marks:
                    start, n = mark["start"], mark["n"]
                    cut = joined[begins[start] : ends[start + n + length - 2]]
                    rows["anchor"].append(mark["anchor"])
                    rows["key"].append(xxhash.xxh64_intdigest(cut) - (1 << 63))
                    rows["d"].append(d)
                    rows["h"].append(h)
                    rows["start"].append(start)
                    rows["n"].append(n)
                    rows["words"].append(cut.decode())
                    rows["within"].append(_repeats(words[start : start + n + length - 1], n, length))
            yield pa.RecordBatch.from_pydict(rows, schema=out)

    return marked.mapInArrow(run, "anchor long, key long, d long, h long, start int, n int, words string, within boolean")


def _repeats(words: list[bytes], n: int, length: int) -> bool:
    """Whether two of the n windows are equal: ``p`` apart, they make the words common to all windows repeat after ``p``."""
    periods = any(words[n - 1 - p : length] == words[n - 1 : length + p] for p in range(1, n))
    return periods and len({tuple(words[i : i + length]) for i in range(n)}) < n


def _verdicts(contents: DataFrame, length: int) -> DataFrame:
    """(anchor, key, mask): the windows of a fragment's first place that start earlier elsewhere, as bits."""
    sizes = contents.groupBy("anchor").agg(F.count("*").alias("m"), F.max("within").alias("within"))
    sizes = sizes.where("m > 1 OR within")
    shared = staged(contents.join(sizes.select("anchor", "m"), "anchor"), "fragments")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("anchor", "key", "words")))

        anchor, key, mask = [], [], []
        for a, shard in groupby(rows(), lambda r: r[0]):
            automaton = SuffixAutomaton()
            for _, k, words in shard:
                seen = automaton.stream_and_add(words.split(" "), length)
                bits = sum(1 << i for i, hit in enumerate(seen[length - 1 :]) if hit)
                if bits:
                    anchor.append(a)
                    key.append(k)
                    mask.append(bits)
            if len(key) > 10_000:
                yield pa.RecordBatch.from_pydict({"anchor": anchor, "key": key, "mask": mask}, schema=_MASKS)
                anchor, key, mask = [], [], []
        yield pa.RecordBatch.from_pydict({"anchor": anchor, "key": key, "mask": mask}, schema=_MASKS)

    few = shared.where(F.col("m") <= SHARD).repartition("anchor").sortWithinPartitions("anchor", "d", "h", "start")
    few = few.select("anchor", "key", "words").mapInArrow(run, "anchor long, key long, mask long")

    many = shared.where(F.col("m") > SHARD).withColumn("words", F.split("words", " "))
    shift = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("shift")
    many = many.select("anchor", "key", "d", "h", "start", "words", shift)
    place = F.struct("d", "h", (F.col("start") + F.col("shift")).alias("start"))
    window = F.array_join(F.slice("words", F.col("shift") + 1, length), " ")
    many = many.select("anchor", "key", "shift", window.alias("words"), place.alias("place"))
    earliest = many.groupBy("words").agg(F.min("place").alias("least"))
    late = many.join(earliest, "words").where("place > least")
    late = late.groupBy("anchor", "key").agg(F.bit_or(F.expr("shiftleft(1L, shift)")).alias("mask"))
    return few.union(late)


_MASKS = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("mask", pa.int64())])


def _candidates(keyed: DataFrame, length: int) -> DataFrame:
    """The anchors that occur twice, with their windows."""
    found = staged(_find_anchors(keyed, length), "anchors")
    counts = found.groupBy("anchor").agg(F.count("*").alias("c"), F.max("again").alias("again"))
    # Staged, so that both sides of the join are plain shuffles, of which adaptive execution can split a hot anchor.
    shared = staged(counts.where("c > 1 OR again").select("anchor"), "shared")
    return found.join(shared, "anchor").drop("again")


def _marked_texts(keyed: DataFrame, length: int) -> DataFrame:
    """(d, h, marks): the first place of each text and, if it has any, the windows of its candidates."""
    found = settled(lambda: _candidates(keyed, length), "candidates")
    marks = found.groupBy("d", "h").agg(F.collect_set(F.struct("start", "n", "anchor")).alias("marks"))
    named = keyed.select("d", "h", F.md5("text").alias("digest"))
    first = named.groupBy("digest").agg(F.min(F.struct("d", "h")).alias("first")).select("first.*")
    return first.join(marks, ["d", "h"], "left")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(d, h, marks): for each text not seen before, runs of windows (start, n, mask) of which the mask's bits are repeated.

    ``d`` is the id, NULL as the largest, and ``h`` the text's hash; a text that an earlier id has, too, has no row.
    """
    if not GRAM < length <= 63 + GRAM:
        raise ValueError("windows must be longer than an anchor and at most 69 words")
    keyed = _keyed(docs, id_col, text_col)
    first = settled(lambda: _marked_texts(keyed, length), "marks")

    marked = keyed.join(first.where("marks IS NOT NULL"), ["d", "h"]).select("d", "h", "text", "marks")
    fragments = staged(_cut_fragments(marked, length), "places")
    least = F.min(F.struct("d", "h", "start")).alias("first")
    one = [F.max("n").alias("n"), F.max("words").alias("words"), F.max("within").alias("within")]
    contents = fragments.groupBy("anchor", "key").agg(least, F.count("*").alias("c"), *one)
    contents = staged(contents.select("anchor", "key", "first.*", "c", "n", "words", "within"), "contents")
    masks = _verdicts(contents.drop("c"), length)
    late = contents.select("anchor", "key", "d", "h", "start", "c").join(masks, ["anchor", "key"], "left")
    late = late.where("c > 1 OR mask IS NOT NULL").select(
        "anchor", "key", F.struct("d", "h", "start").alias("first"), F.coalesce("mask", F.lit(0)).alias("mask")
    )
    placed = fragments.select("anchor", "key", "d", "h", "start", "n").join(late, ["anchor", "key"])
    whole = F.expr("shiftleft(1L, n) - 1")
    mask = F.when(F.struct("d", "h", "start") == F.col("first"), F.col("mask")).otherwise(whole)
    runs = placed.select("d", "h", "start", mask.alias("mask")).where("mask <> 0")
    runs = runs.groupBy("d", "h").agg(F.collect_set(F.struct("start", "mask")).alias("marks"))
    return first.select("d", "h").join(runs, ["d", "h"], "left")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, carry: list[str] | None = None
) -> DataFrame:
    """(row, n_words, n_removed, kept): each row's ``carry`` columns (all by default) and the words that stay, by one space.

    Words lie between the six ASCII blanks. A window of ``length`` words is removed where the same words start earlier: in a
    smaller id, or before in the same text; NULL ids come last. Rows with equal ids are ordered by a hash of their texts; of
    rows with equal ids and texts one stays as it is and the others lose all their windows. Windows are judged on the input.
    A text of fewer words loses none; NULL counts as empty.
    """
    info = settled(lambda: repeated_windows(docs, id_col, text_col, length), "repeats").withColumn("first", F.lit(True))
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(text).alias("h")]
    rows = docs.select(F.struct(*(carry or docs.columns)).alias("row"), *key, text.alias("text"))
    rows = rows.join(info, ["d", "h"], "left")
    again = F.row_number().over(Window.partitionBy("d", "h").orderBy(F.lit(0))) > 1
    rows = rows.select("row", "text", "marks", (F.col("first").isNull() | again).alias("copy"))
    schema = rows.select("row").schema
    for name, kind in (("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept", T.StringType())):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            counts, gone, kept = [], [], []
            for found, marks, copy in zip(texts(batch.column("text")), *(batch.column(c).to_pylist() for c in ("marks", "copy"))):
                words = found.split()
                n = len(words)
                if copy and n >= length:
                    stay = []
                elif marks:
                    out = np.zeros(n + 1, np.int64)
                    for mark in marks:
                        start, bits = mark["start"], mark["mask"]
                        for i in range(bits.bit_length()):
                            if bits >> i & 1:
                                out[start + i] += 1
                                out[start + i + length] -= 1
                    stay = [w for w, o in zip(words, np.cumsum(out).tolist()) if not o]
                else:
                    stay = words
                counts.append(n)
                gone.append(n - len(stay))
                kept.append(b" ".join(stay).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["row", "n_words", "n_removed", "kept"],
            )

    return rows.mapInArrow(run, schema)
