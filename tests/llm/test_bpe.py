import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken

from strata.llm import bpe, queries

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(PATH, "rb").read(), public_tokenizers.PATTERN)


def ids(vocabulary, found):
    return [np.frombuffer(x, "<i4").tolist() for x in vocabulary.encode_texts(found)]


def test_texts_are_cut_and_merged_as_the_library_does(vocabulary, library):
    rng = random.Random(3)
    found = ["", " ", "  ", "a b", "a  b", "a   b c", " x", "x ", "x\n y", "x \ny", "\x1c\x1d a\x85b\xa0c", "I'm 's",
             "ab" * 3000, "日本語 テキスト 😀😀", "²³ ½x 12", "a\n\nb c\n", "<|endoftext|>"]
    for _ in range(4000):
        found.append("".join(rng.choice("ab éß'st  \n\t.,12😀\x1c\xa0") for _ in range(rng.randint(0, 40))))
    assert ids(vocabulary, found) == [library.encode_ordinary(t) for t in found]


def test_both_trees_merge_alike(vocabulary, library):
    rng = random.Random(4)
    found = [bytes(rng.choice(b"aethn\xc3\xa9 ") for _ in range(rng.randint(2, 64))) for _ in range(300)]
    flat, ends = vocabulary.merge_many(found)
    flat = np.frombuffer(flat, "<i4").tolist()
    assert [flat[a:b] for a, b in zip([0, *ends], ends)] == [vocabulary.merge_one(p) for p in found]


def test_full_caches_do_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 50)
    small = bpe.Vocabulary(open(PATH, "rb").read(), public_tokenizers.PATTERN)
    for i in range(20):
        found = [f"word{i * 10 + j} of some text{j}" for j in range(10)]
        assert ids(small, found) == [library.encode_ordinary(t) for t in found]


def test_query(spark, library):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for d in docs:
        found = library.encode_ordinary(d["text"] or "")
        want.add((d["doc_id"], len(found), sha(" ".join(map(str, found)).encode()), sha((d["text"] or "").encode())))
    got = [tuple(r) for r in queries.op8_bpe(spark, SF_DIR).collect()]
    assert len(got) == len(docs) and set(got) == want


def test_odd_rows(spark):
    long = "x" * 200_000 + " word" * 50_000
    rows = [(1, None, "a"), (2, "", "a"), (3, "hi there", "a"), (3, "hi there", "a"), (None, "é\0", "a"), (4, long, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    back = bpe.decode(coded, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r.bytes).decode()) for r in back) == sorted((i or 0, t or "") for i, t, _ in rows)
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe.decode(none, PATH, public_tokenizers.PATTERN).first().bytes is None
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
