"""CSV files cut among tasks at the true ends of their records, also where quoted fields hold line breaks.

A file is cut into blocks of bytes. What a block does to the parser's state is a small function, from the state at its start to
the state at its end and the first record that begins in it; tasks work it out without knowing where they start. Composing these
functions in the order of the blocks tells each block's true state, and so the byte ranges that hold whole records. Tasks then read
these ranges and split them into records; fields are counted by state on the way, not by a pattern on the raw line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.staging import open_store

# The parser's state before a byte. QUOTE is right behind a quote that may close its field or be the first of two.
RECORD, FIELD, PLAIN, QUOTED, QUOTE = range(5)

#: Bytes of a block, and the longest record: a longer one is taken for a quote that was never closed.
BLOCK, LONGEST = 32 << 20, 256 << 20

_OPENING = re.compile(rb'[,\n]"')
_CLOSING = re.compile(rb'[^"]*+(?:""[^"]*+)*+"(?!")')


def spans(data: bytes, state: int) -> tuple[list[tuple[int, int]], int]:
    """The stretches of ``data`` inside quotes, quotes included, and the state behind its last byte."""
    found, at, n = [], 0, len(data)
    if not n:
        return found, state
    if state == QUOTE:  # a second quote goes on with the field, anything else is behind it
        state = QUOTED if data[:1] == b'"' else PLAIN
        at = 1 if state == QUOTED else 0
        if state == QUOTED and n == 1:
            return [(0, 1)], QUOTED
    opened = 0 if state == QUOTED else None
    if state in (RECORD, FIELD) and data[:1] == b'"':
        opened, at = 0, 1
    while True:
        if opened is None:
            m = _OPENING.search(data, at)
            if not m:
                last = data[-1:]
                end = RECORD if last == b"\n" else FIELD if last == b"," else PLAIN
                return found, state if at == n and not found else PLAIN if at == n else end
            opened, at = m.end() - 1, m.end()
        m = _CLOSING.match(data, at)
        if not m:
            found.append((opened, n))
            return found, QUOTED
        found.append((opened, m.end()))
        if m.end() == n:
            return found, QUOTE
        at, opened = m.end(), None


def _outside(positions: np.ndarray, inside: list[tuple[int, int]]) -> np.ndarray:
    if not inside or not len(positions):
        return positions
    edges = np.array(inside, np.int64)
    place = np.searchsorted(edges[:, 0], positions, side="right") - 1
    return positions[(place < 0) | (positions >= edges[np.maximum(place, 0), 1])]


def _first_break(data: bytes, inside: list[tuple[int, int]]) -> int:
    """The place behind the first line feed outside of quotes that is not the last byte, else -1."""
    at = 0
    for a, b in [*inside, (len(data), len(data))]:
        found = data.find(b"\n", at, a)
        if found >= 0:
            return found + 1 if found + 1 < len(data) else -1
        at = b
    return -1


def summary(data: bytes) -> tuple[list[int], list[int]]:
    """For each state at the start: the state at the end, and where the first record begins in the block, -1 if none does."""
    ends, firsts = [], []
    plain = None if b'"' in data or not data else spans(data, PLAIN)
    for state in range(5):
        inside, end = spans(data, state) if plain is None or state == QUOTED else plain
        ends.append(end)
        firsts.append(0 if state == RECORD and data else _first_break(data, inside))
    return ends, firsts


def records(data: bytes) -> tuple[list[int], list[int], list[int]]:
    """The start, the end without its line break, and the number of fields of each record; ``data`` begins with a record."""
    inside, _ = spans(data, RECORD)
    raw = np.frombuffer(data, np.uint8)
    breaks = _outside(np.flatnonzero(raw == 10), inside)
    commas = _outside(np.flatnonzero(raw == 44), inside)
    starts, ends = np.append(0, breaks + 1), np.append(breaks, len(data))
    fields = np.searchsorted(commas, ends) - np.searchsorted(commas, starts) + 1
    ends[:-1] -= (ends[:-1] > starts[:-1]) & (raw[breaks - 1] == 13)
    full = ends > starts
    return starts[full].tolist(), ends[full].tolist(), fields[full].tolist()


def _read(path: str, at: int, n: int) -> bytes:
    fs, place = open_store(path)
    with fs.open_input_file(place) as f:
        return f.read_at(n, at)


def _ranges(table: pa.Table, longest: int) -> pa.Table:
    """(path, at, length) of the records that begin in each block, from one file's summaries."""
    rows = sorted(table.to_pylist(), key=lambda r: r["at"])
    state, starts = RECORD, []
    for r in rows:
        first = r["firsts"][state]
        if first >= 0:
            starts.append(r["at"] + first)
        state = r["ends"][state]
    size = max((r["at"] + r["n"] for r in rows), default=0)
    ends = [*starts[1:], size]
    block = max((r["n"] for r in rows), default=0)
    for a, b in zip(starts, ends):
        if b - a > longest + block:
            raise ValueError(f"{rows[0]['path']}: a record of more than {longest} bytes begins behind byte {a}")
    return pa.table({
        "path": pa.array([rows[0]["path"]] * len(starts), pa.string()), "at": pa.array(starts, pa.int64()),
        "n": pa.array([b - a for a, b in zip(starts, ends)], pa.int64()),
    })


def csv_ranges(spark: SparkSession, files: DataFrame, block: int = BLOCK, longest: int = LONGEST) -> DataFrame:
    """(path, at, n): byte ranges of whole records, one for each block in which a record begins.

    ``files`` has (path, length). Every block is read once for its summary; the summaries of a file, some bytes for each block,
    are composed in one task. Empty files have no range. A range of more than ``longest`` bytes beyond a block is an error.
    """
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block).cast("long"))).alias("at")
    blocks = files.where("length > 0").select("path", "length", at)
    blocks = blocks.select("path", "at", F.least(F.lit(block).cast("long"), F.col("length") - F.col("at")).alias("n"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ends, firsts = summary(_read(r["path"], r["at"], r["n"]))
                yield pa.RecordBatch.from_pylist([r | {"ends": ends, "firsts": firsts}], schema=kinds)

    kinds = pa.schema([
        ("path", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("ends", pa.list_(pa.int32())), ("firsts", pa.list_(pa.int64())),
    ])
    dealt = blocks.repartition(_tasks(spark), "path", "at")
    summaries = dealt.mapInArrow(summed, "path string, at long, n long, ends array<int>, firsts array<long>")
    return summaries.groupBy("path").applyInArrow(lambda t: _ranges(t, longest), "path string, at long, n long")


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def csv_records(spark: SparkSession, files: DataFrame, block: int = BLOCK, longest: int = LONGEST) -> DataFrame:
    """(path, at, line, fields, header): every record of CSV files that is not empty, its place in the file, its number of fields,
    and whether it is its file's first.

    Files are cut among tasks by :func:`csv_ranges`. A quote opens a field only where the field begins with it, inside two quotes
    are one; records end with a line feed, with or without a carriage return before it. Bytes that are not UTF-8 become U+FFFD,
    and a byte order mark at a file's start is left out. A file whose first block holds nothing but line breaks is an error.
    """
    size = 4 << 20

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data = _read(r["path"], r["at"], r["n"])
                mark = 3 if r["at"] == 0 and data.startswith(b"\xef\xbb\xbf") else 0
                data = data[mark:]
                starts, ends, fields = records(data)
                if r["at"] == 0 and not starts and len(data) >= block:
                    raise ValueError(f"{r['path']}: no header in the first {block} bytes")
                i = 0
                while i < len(starts):  # batches of bounded bytes
                    j = i + 1
                    while j < len(starts) and ends[j] - starts[i] <= size:
                        j += 1
                    lines = [data[a:b].decode("utf-8", "replace") for a, b in zip(starts[i:j], ends[i:j])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([r["path"]] * (j - i), pa.string()),
                        pa.array([r["at"] + mark + a for a in starts[i:j]], pa.int64()),
                        pa.array(lines, pa.string()), pa.array(fields[i:j], pa.int32()),
                        pa.array([r["at"] == i + k == 0 for k in range(j - i)], pa.bool_()),
                    ], ["path", "at", "line", "fields", "header"])
                    i = j

    # A few dozen bytes stand for a block: they are dealt anew, so that adaptive execution does not put them into one task.
    dealt = csv_ranges(spark, files, block, longest).repartition(_tasks(spark), "path", "at")
    return dealt.mapInArrow(cut, "path string, at long, line string, fields int, header boolean")
