"""Token ids of documents in binary shards, with a minimal perfect hash index from document keys to offsets.

A shard holds, in this order: the raw ids of its documents in ascending key order, little-endian, 2 or 4 bytes each; the
document table (key, whether it is NULL, where its ids start); the index; the sizes of its levels; and a footer of fixed size
that says where those begin. The index is a minimal perfect hash of the distinct keys, bit vectors in levels: a key is settled
at the first level where it falls alone into a cell, and its slot is the number of settled cells before, which is stored with
each block of cells. A slot stores a fingerprint of its key and the first row with it. So a lookup seeks one block a level, of
which most keys need two, one fingerprint, one row and its key and ends, whatever the shard's size, and a foreign key is
refused by the fingerprint or, where that agrees by chance, by the key in the table.
"""

from __future__ import annotations

import hashlib
import os
import struct
import sys
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pds
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import pieces, scratch, texts
from strata.staging import open_store

MAGIC = b"STRATIDS"
FOOTER = struct.Struct("<8sIIQQQQQ")  # magic, bytes an id, levels, rows, ids, and where rows, index, slots begin
#: Cells a key at each level of the index.
SPARSE = 2
#: Cells of a block, and its bytes: the number of settled cells before, and the cells as bits.
STRIDE = 512
BLOCK = 8 + STRIDE // 8
#: Words whose ids are put together at a time.
GATHERED = 1 << 20
#: Distinct words kept in a Python worker, and marks that a tokenizer cuts from the letters before them.
KEPT = 1_200_000
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
MANIFEST = "shard int, file string, n_rows long, n_ids long, least long, largest long"


# --- minimal perfect hash ---


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing step by multiplications and shifts; one to one for every seed."""
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Maps n distinct unsigned 64-bit keys to 0 .. n-1; other keys to any slot, or to -1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before, total = [], 0
        for bits in levels:
            counts = np.add.reduceat(bits.astype(np.int64), np.arange(0, len(bits), STRIDE))
            self.before.append(total + np.concatenate([[0], np.cumsum(counts)[:-1]]))
            total += int(counts.sum())
        self.size = total

    def packed(self) -> list[bytes]:
        """The blocks of each level."""
        out = []
        for bits, before in zip(self.levels, self.before):
            rows = np.packbits(bits, bitorder="little").reshape(-1, STRIDE // 8)
            out.append(np.hstack([before.astype("<u8").view(np.uint8).reshape(-1, 8), rows]).tobytes())
        return out

    @classmethod
    def unpacked(cls, levels: list[bytes]) -> PerfectHash:
        rows = (np.frombuffer(level, np.uint8).reshape(-1, BLOCK)[:, 8:].ravel() for level in levels)
        return cls([np.unpackbits(r, bitorder="little").astype(bool) for r in rows])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            n = -(-SPARSE * len(keys) // STRIDE) * STRIDE
            cells = (_mixed(keys, len(levels)) % np.uint64(n)).astype(np.int64)
            alone = np.bincount(cells, minlength=n) == 1
            levels.append(alone)
            keys = keys[~alone[cells]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for seed, (bits, before) in enumerate(zip(self.levels, self.before)):
            if not len(open_):
                break
            cells = (_mixed(keys[open_], seed) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[cells]
            for i, cell in zip(open_[hit].tolist(), cells[hit].tolist()) if hit.sum() < 32 else ():
                block = cell // STRIDE
                out[i] = before[block] + int(bits[block * STRIDE : cell].sum())
            if hit.sum() >= 32:
                ranks = np.cumsum(bits) - 1 + int(before[0])
                out[open_[hit]] = ranks[cells[hit]]
            open_ = open_[~hit]
        return out


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


# --- shards ---


class ShardWriter:
    """Takes documents in ascending key order; ids go straight to the file, only the tables are held."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.keys: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, keys: pa.Array, coded: list[bytes]) -> None:
        self.out.write(b"".join(coded))
        self.keys.append(keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.nulls.append(keys.is_null().to_numpy(zero_copy_only=False))
        self.counts.append(np.array([len(c) for c in coded], np.int64) // self.width)

    def close(self) -> tuple[int, int, int | None, int | None]:
        """Rows, ids, least and largest key."""
        keys, nulls, counts = (np.concatenate(x) for x in (self.keys, self.nulls, self.counts))
        starts = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
        rows_at = int(starts[-1]) * self.width
        self.out.write(keys.tobytes() + nulls.astype(np.uint8).tobytes() + starts.tobytes())
        distinct, first = np.unique(np.where(nulls, np.iinfo(np.int64).min, keys)[~nulls], return_index=True)
        first = np.flatnonzero(~nulls)[first]
        hashed = distinct.astype(np.int64).view(np.uint64)
        index = PerfectHash.of(hashed)
        index_at = rows_at + 17 * len(keys) + 8
        packed = index.packed()
        self.out.write(b"".join(packed))
        slots_at = index_at + sum(map(len, packed))
        prints, rows = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u8")
        at = index.slots(hashed)
        prints[at], rows[at] = _fingerprint(hashed), first
        self.out.write(prints.tobytes() + rows.tobytes())
        self.out.write(np.array([len(b) // BLOCK for b in packed], "<u8").tobytes())
        self.out.write(FOOTER.pack(MAGIC, self.width, len(packed), len(keys), int(starts[-1]), rows_at, index_at, slots_at))
        ends = (int(distinct[0]), int(distinct[-1])) if len(distinct) else (None, None)
        return len(keys), int(starts[-1]), *ends


class Shard:
    """One shard opened for reading: its footer and the sizes of its levels are held, all else is read as asked for."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        size = source.size()
        footer = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        magic, self.width, levels, self.n, self.n_ids, self.rows_at, index_at, self.slots_at = footer
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        self.blocks = np.frombuffer(self._at(size - FOOTER.size - 8 * levels, 8 * levels), "<u8").astype(np.int64)
        self.levels_at = index_at + BLOCK * np.concatenate([[0], np.cumsum(self.blocks)])
        self.n_slots = (size - FOOTER.size - 8 * levels - self.slots_at) // 12

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(int(start))
        return self.source.read(int(length))

    def _number(self, start: int, kind: str = "<q") -> int:
        return struct.unpack(kind, self._at(start, struct.calcsize(kind)))[0]

    # the whole tables, for a scan

    @cached_property
    def keys(self) -> np.ndarray:
        return np.frombuffer(self._at(self.rows_at, 8 * self.n), "<i8")

    @cached_property
    def nulls(self) -> np.ndarray:
        return np.frombuffer(self._at(self.rows_at + 8 * self.n, self.n), np.uint8).astype(bool)

    @cached_property
    def starts(self) -> np.ndarray:
        return np.frombuffer(self._at(self.rows_at + 9 * self.n, 8 * self.n + 8), "<u8").astype(np.int64)

    @cached_property
    def index(self) -> PerfectHash:
        return PerfectHash.unpacked([self._at(at, BLOCK * n) for at, n in zip(self.levels_at, self.blocks)])

    @cached_property
    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and first row of each slot."""
        held = self._at(self.slots_at, 12 * self.n_slots)
        return np.frombuffer(held, "<u4", self.n_slots), np.frombuffer(held, "<u8", self.n_slots, 4 * self.n_slots).astype(np.int64)

    def first_rows(self, keys: np.ndarray) -> np.ndarray:
        """The first row of each of many keys, -1 where the shard has none; holds the whole tables."""
        hashed = np.asarray(keys, np.int64).view(np.uint64)
        prints, first = self.slots
        slots = self.index.slots(hashed)
        known = slots >= 0
        known[known] = prints[slots[known]] == _fingerprint(hashed[known])
        rows = np.where(known, first[np.where(known, slots, 0)] if len(first) else -1, -1)
        known[known] = self.keys[rows[known]] == np.asarray(keys)[known]
        return np.where(known, rows, -1)

    def ids(self, row: int, end: int | None = None) -> np.ndarray:
        """Ids of the rows from ``row`` to before ``end``, of one row by default; the tables are held."""
        return self._ids(self.starts[row], self.starts[row + 1 if end is None else end])

    def _ids(self, a: int, b: int) -> np.ndarray:
        return np.frombuffer(self._at(int(a) * self.width, int(b - a) * self.width), f"<u{self.width}")

    # one key, by seeking

    def first_row(self, key: int) -> int:
        """The first row of a key, -1 where the shard has none."""
        hashed = np.array([key], np.int64).view(np.uint64)
        for seed, (at, n) in enumerate(zip(self.levels_at.tolist(), self.blocks.tolist())):
            cell = int(_mixed(hashed, seed)[0] % np.uint64(n * STRIDE))
            block = self._at(at + BLOCK * (cell // STRIDE), BLOCK)
            bits = int.from_bytes(block[8:], "little")
            if not bits >> cell % STRIDE & 1:
                continue
            slot = int.from_bytes(block[:8], "little") + (bits & (1 << cell % STRIDE) - 1).bit_count()
            if self._number(self.slots_at + 4 * slot, "<I") != int(_fingerprint(hashed)[0]):
                return -1
            row = self._number(self.slots_at + 4 * self.n_slots + 8 * slot)
            return row if self._number(self.rows_at + 8 * row) == key else -1
        return -1

    def find(self, key: int) -> list[np.ndarray]:
        """Ids of every row with this key."""
        row, found = self.first_row(key), []
        while 0 <= row < self.n and self._number(self.rows_at + 8 * row) == key:
            if self._number(self.rows_at + 8 * self.n + row, "<B"):
                break
            found.append(self._ids(*struct.unpack("<QQ", self._at(self.rows_at + 9 * self.n + 8 * row, 16))))
            row += 1
        return found


def open_file(path: str, mode: str = "rb"):
    fs, at = open_store(path)
    return fs.open_input_file(at) if mode == "rb" else fs.open_output_stream(at)


# --- encoding ---

_ENCODERS: dict[tuple, WordEncoder] = {}


class WordEncoder:
    """Ids of texts by a tokenizer file. By words, the ids of each distinct word are kept."""

    def __init__(self, content: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_str(content), by_word
        most = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
        self.width = 2 if most < 1 << 16 else 4
        some = self.tokenizer.encode_batch(["Az", "az"], add_special_tokens=False)
        self.lower = some[0].ids == some[1].ids
        self.kept: dict[bytes, bytes] = {}

    def _library(self, found: list[bytes]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast([t.decode() for t in found], add_special_tokens=False)
        kind = "H" if self.width == 2 else "I"
        out = [array(kind, e.ids) for e in coded]
        if sys.byteorder == "big":
            for a in out:
                a.byteswap()
        return [a.tobytes() for a in out]

    def __call__(self, found: list[bytes], end: bytes) -> list[bytes]:
        if not self.by_word:
            return [ids + end for ids in self._library(found)]
        listed = pc.ascii_split_whitespace(pa.array(found, pa.binary()).view(pa.string()))
        coded = listed.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        parts = list(map(self.kept.get, words))
        holes = [i for i, part in enumerate(parts) if part is None]
        if holes:
            self._learn([words[i] for i in holes], words, parts)
            for i in holes:
                parts[i] = self.kept[words[i]]
        parts.append(end)
        offsets = listed.offsets.to_numpy()
        which = np.insert(coded.indices.to_numpy(), offsets[1:] - offsets[0], len(words))
        ends = np.cumsum(np.diff(offsets) + 1)
        return self._gathered(parts, which, ends)

    def _gathered(self, parts: list[bytes], which: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The parts of the numbers in ``which`` one after another, cut at ``ends``."""
        ids = np.frombuffer(b"".join(parts), f"<u{self.width}")
        sizes = np.array(list(map(len, parts)), np.int64) // self.width
        starts = np.cumsum(sizes) - sizes
        done, upto = [], np.cumsum(sizes[which])
        for at in range(0, len(which), GATHERED):
            some = which[at : at + GATHERED]
            many = sizes[some]
            places = np.repeat(starts[some] - (np.cumsum(many) - many), many)
            places += np.arange(len(places))
            done.append(ids[places].tobytes())
        whole = b"".join(done)
        cuts = (upto[ends - 1] * self.width).tolist()
        return [whole[a:b] for a, b in zip([0, *cuts], cuts)]

    def _learn(self, new: list[bytes], words: list[bytes], parts: list[bytes | None]) -> None:
        """Encode words that are not kept. Where too many are, those of this batch stay."""
        if len(self.kept) + 2 * len(new) > KEPT:
            self.kept = {w: part for w, part in zip(words, parts) if part is not None}
        # Letters and the marks behind them are encoded apart, so that a word is known with all marks and, in ASCII, in any case.
        cut, kept = {}, self.kept
        for word in new:
            head = word.rstrip(MARKS)
            ascii_ = head.isascii()
            if head.isalpha() if ascii_ else head.decode().isalpha():
                cut[word] = head.lower() if ascii_ and self.lower else head, word[len(head) :]
        apart = {part for halves in cut.values() for part in halves if part and part not in kept}
        whole = list(apart.union(word for word in new if word not in cut))
        kept.update(zip(whole, self._library(whole)))
        kept.update((word, kept[head] + kept[tail] if tail else kept[head]) for word, (head, tail) in cut.items())


def _encoder(content: str, by_word: bool) -> WordEncoder:
    key = (hashlib.sha256(content.encode()).digest(), by_word)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(content, by_word)
    return _ENCODERS[key]


# --- tables ---


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    by_word: bool = False,
    shards: int | None = None,
) -> DataFrame:
    """Encode every text, write shards in ascending key order to ``folder`` and return the manifest, one row per shard.

    Keys are whole numbers; rows may repeat, rows with a NULL key come first and are not in the index; NULL texts count as
    empty, and every row ends with ``end_id``. No special tokens are added. ``by_word`` encodes the words between ASCII blanks
    one by one: right for a tokenizer that drops white space, looks at nothing beyond it and cuts marks from letters. Shards
    are ranges of keys, one per task; equal keys may lie in two neighbours. A repeated task writes the same file again under the same name.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        shipped = spark.sparkContext.broadcast(f.read())
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    order = ["key", F.xxhash64("text")]
    rows = rows.repartitionByRange(shards, *order).sortWithinPartitions("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shipped.value, by_word)
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        task = TaskContext.get()
        name = f"shard-{task.partitionId():06d}"
        writer, draft = None, f"{folder}/.{name}.{task.taskAttemptId()}"
        for batch in pieces(batches, "text", 4 << 20):
            if writer is None:
                fs, at = open_store(draft)
                fs.create_dir(os.path.dirname(at), recursive=True)
                writer = ShardWriter(fs.open_output_stream(at), encoder.width)
            writer.add(batch.column("key"), encoder(texts(batch.column("text")), end))
        if writer is not None:
            said = writer.close()
            writer.out.close()
            fs.move(at, f"{os.path.dirname(at)}/{name}.ids")
            row = dict(zip(("n_rows", "n_ids", "least", "largest"), said))
            row |= {"shard": task.partitionId(), "file": f"{folder}/{name}.ids"}
            yield pa.RecordBatch.from_pylist([row], schema=_MANIFEST_ARROW)

    manifest = f"{folder}/manifest"
    rows.mapInArrow(run, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


_MANIFEST_ARROW = pa.schema(
    [("shard", pa.int32()), ("file", pa.string())] + [(n, pa.int64()) for n in ("n_rows", "n_ids", "least", "largest")]
)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(key, start, n_ids, ids): every stored document; ``ids`` are the bytes of its ids as little-endian 32-bit numbers.

    ``start`` counts the ids of all documents before it. Each key is looked up in the index of its shard; repeated keys are
    the rows that follow the one found.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("shard", "file", F.coalesce(before, F.lit(0)).alias("base"))
    files = files.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard")
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, base in ((r["file"], r["base"]) for b in batches for r in b.to_pylist()):
            with open_file(file) as source:
                shard = Shard(source)
                n = shard.n
                same = np.zeros(n, bool)  # as the row before
                same[1:] = (shard.keys[1:] == shard.keys[:-1]) & (shard.nulls[1:] == shard.nulls[:-1])
                found = np.arange(n)
                asked = ~shard.nulls & ~same
                found[asked] = shard.first_rows(shard.keys[asked])
                if (found < 0).any():
                    raise ValueError(f"the index of {file} lacks a key")
                for a, b in _groups(shard.starts, 1 << 20):
                    wide = shard.ids(a, b).astype("<u4").tobytes()
                    begins, ends = shard.starts[found[a:b]], shard.starts[found[a:b] + 1]
                    cuts = zip(4 * (begins - shard.starts[a]), 4 * (ends - shard.starts[a]))
                    keys = pa.array(shard.keys[a:b], mask=shard.nulls[a:b])
                    ids = pa.array([wide[x:y] for x, y in cuts], pa.binary())
                    yield pa.RecordBatch.from_arrays([keys, pa.array(base + begins), pa.array(ends - begins), ids], schema=schema)

    return files.mapInArrow(run, "key long, start long, n_ids long, ids binary")


def _groups(starts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most`` ids; at least one row each."""
    a, n = 0, len(starts) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + most, "right")) - 1)
        yield a, b
        a = b


def lookup(keys: DataFrame, folder: str, key_col: str = "doc_id") -> DataFrame:
    """(key, ids array<int>) of every stored row with one of the distinct keys asked for; unknown and NULL keys give none.

    Each task finds the shards of its keys by binary search in the manifest; then each shard is opened once for its keys.
    """
    asked = keys.select(F.col(key_col).cast("long").alias("key")).dropna().distinct()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = open_store(f"{folder}/manifest")
        shards = pds.dataset(at, filesystem=fs, format="parquet").to_table(columns=["file", "least", "largest"])
        shards = shards.filter(pc.is_valid(shards["least"])).sort_by([("least", "ascending"), ("largest", "ascending")])
        files, least, largest = (shards[c].to_numpy() for c in ("file", "least", "largest"))
        for batch in batches:
            asked = batch.column("key").to_numpy()
            first, last = np.searchsorted(largest, asked, "left"), np.searchsorted(least, asked, "right")
            times = np.maximum(last - first, 0)
            which = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            found = [pa.array(files[which], pa.string()), pa.array(np.repeat(asked, times))]
            yield pa.RecordBatch.from_arrays(found, ["file", "key"])

    met = asked.mapInArrow(place, "file string, key long")
    out = T.StructType([T.StructField("key", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["file"] != name:
                    name, shard = r["file"], Shard(open_file(r["file"]))
                rows += [{"key": r["key"], "ids": ids.tolist()} for ids in shard.find(r["key"])]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32()))]))

    return met.repartition("file").sortWithinPartitions("file", "key").mapInArrow(run, out)


def new_folder(spark: SparkSession) -> str:
    return scratch(spark, "token-ids")
