import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from strata.llm import periodic, queries

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, shortest=0):
    """(start, length, period) of the runs of a list, by comparing it with itself at every distance."""
    n, seen, out = len(w), set(), []
    for q in range(1, n // 3 + 1):
        x = 0
        while x + q < n:
            start = x
            while x + q < n and w[x] == w[x + q]:
                x += 1
            if x - start >= 2 * q and (start, x + q) not in seen:
                seen.add((start, x + q))
                out.append((start, x + q - start, q))
            x += x == start
    return [r for r in sorted(out, key=lambda r: (r[0], r[2])) if r[1] >= shortest]


def plain_kept(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def made_up(rng):
    """Words with runs in runs, blocks of one word, and noise."""
    kinds, n, w = rng.choice([1, 2, 2, 3, 5, 50]), rng.choice([0, 1, 5, 24, 60, 150, 400]), []
    some = lambda most: [rng.randrange(kinds) for _ in range(rng.randint(1, most))]
    while len(w) < n:
        block = some(rng.choice([3, 10, 60]))
        if rng.random() < 0.4:
            block = [rng.randrange(kinds)] * rng.randint(1, 30) + block + [rng.randrange(kinds)] * rng.randint(0, 12)
        if rng.random() < 0.3:
            block = block * rng.randint(1, 6) + some(1)
        w += block * rng.randint(1, 6) + block[: rng.randrange(len(block) + 1)] if rng.random() < 0.5 else some(30)
    return w


@pytest.mark.parametrize("chunk", [1 << 18, 37])
def test_runs_of_made_up_words(monkeypatch, chunk):
    monkeypatch.setattr(periodic, "CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(150):
        w = made_up(rng)
        got = periodic.runs(np.array(w, np.int32))
        assert sorted(got, key=lambda r: (r[0], r[2])) == plain_runs(w)


def test_runs_of_famous_words():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    for w in (b[:1500], [bin(i).count("1") & 1 for i in range(1500)], [0] * 1000, (list(range(300)) * 4)[:1100]):
        assert sorted(periodic.runs(np.array(w, np.int32)), key=lambda r: (r[0], r[2])) == plain_runs(w)


def test_synchronising_positions_are_consistent_and_dense():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 9, 300)
    w = np.concatenate((rng.integers(0, 9, 111), part, rng.integers(0, 9, 57), part)).astype(np.int32)
    hashes, scale = periodic._mixed(w.astype(np.uint64)), 1
    while scale < 16:
        hashes, scale = periodic._joined(hashes, scale), 2 * scale
    chosen = periodic.synchronising(hashes, scale, [])
    one, two = chosen[(chosen >= 111) & (chosen <= 411 - 32)] - 111, chosen[chosen >= 468] - 468
    assert one.tolist() == two.tolist()  # equal words, equal choice
    assert np.diff(chosen).max() <= scale  # no stretch without a choice, as nothing here is periodic


def planted(doc):
    words, n = WORD.findall(doc["text"] or ""), 0
    h, n = zlib.crc32(str(doc["doc_id"]).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_equals_brute_force(spark):
    want = set()
    for doc in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist():
        words = planted(doc)
        runs = plain_runs(words, 24)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in (lines, plain_kept(words, runs)))
        want.add((doc["doc_id"], len(runs), *best, milli, *digests))
    rows = queries.op13_periodic(spark, SF_DIR).collect()
    assert rows[0].asDict().keys() == {
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    }
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want and any(r.n_runs for r in rows)


def test_odd_texts_and_columns(spark):
    """NULL, empty and blank texts, repeated rows, a word's own blanks, and columns named like the result's."""
    texts = [None, "", " \t\n", "a " * 23, "a " * 24, "x\u00a0y z " * 12, "a " * 24, "\u2003b " * 30]
    rows = [(i if i % 2 else None, t, "kept", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")
    got = {r.row.n_words: r for r in periodic.collapse(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        runs = plain_runs(words, 24)
        assert got[i].n_words == len(words) and [tuple(r) for r in got[i].runs] == runs
        assert got[i].kept == plain_kept(words, runs) and got[i].row.runs == "kept"
    assert got[4].kept == "a" and got[3].kept == " ".join("a" * 23)
    empty = periodic.collapse(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["row", "n_words", "runs", "kept"]


def test_very_long_text_and_slices(spark, monkeypatch):
    """A text beyond a slice: a long period, a short one inside of it, and a word longer than a slice."""
    block = [f"w{i}" for i in range(70_000)] + ["same"] * 40
    words = ["head", "x" * 3_000_000, *block * 3, "tail"]
    ((row,),) = ([r for r in periodic.collapse(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).collect()],)
    long = (2, 3 * len(block), len(block))
    same = [(2 + 70_000 + k * len(block), 40, 1) for k in range(3)]
    assert sorted(map(tuple, row.runs)) == sorted([long, *same])
    assert row.n_words == len(words) and row.kept == plain_kept(words, [long, *same])
