import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import queries, token_store

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_query(spark, library):
    docs = sorted(pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist(), key=lambda d: d["doc_id"])
    want, start = [], 0
    for d in docs:
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        want.append((d["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.op7_token_store(spark, SF_DIR).collect()) == want


def test_words_are_encoded_as_whole_texts(library):
    rng = random.Random(2)
    found = ["".join(rng.choice("aB é'st  \n\t.,12😀\x1c\xa0ΣǺ한ᄒ") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    found += ["a<|endoftext|>b <|endoftext|>", "It's we'll", "", " "]
    by_word = token_store.WordEncoder(open(PATH, encoding="utf-8").read(), True)
    got = [np.frombuffer(x, "<u2").tolist() for x in by_word([t.encode() for t in found], b"")]
    assert got == [e.ids for e in library.encode_batch(found, add_special_tokens=False)]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 60_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
    index = token_store.PerfectHash.of(keys)
    assert index.size == len(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    assert [index.slots(keys[i : i + 1])[0] for i in range(min(50, len(keys)))] == index.slots(keys)[:50].tolist()
    assert sum(len(b) for b in index.levels) <= 8 * len(keys) + 4096


def test_odd_rows_and_keyed_access(spark, library):
    rows = [(5, "five words", 1), (None, "no key", 1), (5, "five again", 1), (-3, None, 1), (9, "", 1), (9, "", 1),
            (7, "long " * 60_000, 1), (None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    folder = token_store.new_folder(spark)
    manifest = token_store.write(df, folder, PATH, end_id=1, shards=3)
    assert manifest.agg(F.sum("n_rows")).first()[0] == len(rows)
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 1]
    got = token_store.read(spark, folder).collect()
    seen = sorted(((r.key is not None, r.key or 0), np.frombuffer(r.ids, "<u4").tolist()) for r in got)
    assert seen == sorted(((k is not None, k or 0), ids(t)) for k, t, _ in rows)
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == [sum(r.n_ids for r in order[:i]) for i in range(len(order))]
    assert [r.key for r in order] == [None, None, -3, 5, 5, 7, 9, 9]
    asked = spark.createDataFrame([(5,), (5,), (7,), (8,), (None,), (10**12,)], "doc_id long")
    found = sorted((r.key, r.ids) for r in token_store.lookup(asked, folder).collect())
    assert found == sorted((k, ids(t)) for k, t, _ in rows if k in (5, 7))


def test_empty_table(spark):
    folder = token_store.new_folder(spark)
    assert token_store.write(spark.createDataFrame([], "doc_id long, text string"), folder, PATH, 1).count() == 0
    assert token_store.read(spark, folder).count() == 0


class Counting:
    """A file that counts what is read."""

    def __init__(self, content):
        self.content, self.at, self.n_bytes, self.n_reads = content, 0, 0, 0

    def size(self):
        return len(self.content)

    def seek(self, at):
        self.at = at

    def read(self, n):
        self.n_bytes, self.n_reads = self.n_bytes + n, self.n_reads + 1
        return self.content[self.at : self.at + n]


@pytest.mark.parametrize("n", [1000, 1_000_000])
def test_a_lookup_reads_as_much_of_any_shard(n):
    out = io.BytesIO()
    writer = token_store.ShardWriter(out, 2)
    keys = np.sort(np.random.default_rng(n).choice(10 * n, n, replace=False))
    for at in range(0, n, 5000):
        some = keys[at : at + 5000]
        writer.add(pa.array(some), [np.array([k % 40_000, 7], "<u2").tobytes() for k in some.tolist()])
    writer.close()
    for key in [*keys[:: n // 50].tolist(), -1, 10 * n + 5]:
        source = Counting(out.getvalue())
        found = token_store.Shard(source).find(key)
        assert [f.tolist() for f in found] == ([[key % 40_000, 7]] if key >= 0 and key <= keys[-1] else [])
        assert source.n_bytes < 2500 and source.n_reads < 36
