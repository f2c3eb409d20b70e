import hashlib
import random
import re

import pyarrow.parquet as pq
import pytest

from strata.llm import queries, substrings

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, length=20):
    """Each document's words that stay; docs in order."""
    seen, out = set(), []
    found = [WORD.findall(t or "") for t in docs]
    for words in found:
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        out.append([w for w, g in zip(words, gone) if not g])
    return found, out


def test_query_equals_brute_force(spark):
    docs = sorted(pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist(), key=lambda d: d["doc_id"])
    found, kept = plain([d["text"] for d in docs])
    want = {
        (d["doc_id"], len(f), len(f) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest())
        for d, f, k in zip(docs, found, kept)
    }
    got = [tuple(r) for r in queries.op9_substrings(spark, SF_DIR).collect()]
    assert len(got) == len(docs) and set(got) == want


def made_up(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [text(n) for n in (19, 20, 21, 35, 60)]
    docs = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            parts += rng.choice([text(rng.randint(0, 30)), p, p[rng.randint(0, 9) :], p[:25], p + p])
        docs.append(" ".join(parts))
    line = " ".join(f"line{i}" for i in range(19))
    docs += [f"{a} {line} {a} {line} {b}" for a in words for b in words[:8]]  # a line in many contexts, of 19 words
    return docs + ["same " * 90, "same " * 25, "ab ba " * 40, "", None]


@pytest.mark.parametrize("shard", [256, 3])
def test_made_up_documents(spark, monkeypatch, shard):
    monkeypatch.setattr(substrings, "SHARD", shard)
    docs = made_up(shard)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id long, text string, anchor string")
    got = {r.row.doc_id: (r.n_words, r.kept) for r in substrings.remove_repeats(df).collect()}
    found, kept = plain(docs)
    for i in range(len(docs)):
        assert got[i] == (len(found[i]), " ".join(kept[i])), docs[i]


def test_odd_rows(spark):
    rng = random.Random(1)
    long = " ".join(f"x{rng.randint(0, 9)}" for _ in range(40_000))
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (1, a), (None, a), (2, b), (2, f"{b} more"), (3, None), (4, long), (5, "short one"), (5, "short one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.row.doc_id or 99, r.n_words, r.n_removed) for r in substrings.remove_repeats(df).collect())
    _, kept = plain([long])
    two = sorted([(2, 30, 0), (2, 31, 30)]) if (2, 30, 0) in got else sorted([(2, 30, 30), (2, 31, 0)])
    assert got == [(1, 30, 0), (1, 30, 30), *two, (3, 0, 0), (4, 40_000, 40_000 - len(kept[0])), (5, 2, 0), (5, 2, 0),
                   (99, 30, 30)]
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def test_automaton():
    rng = random.Random(8)
    for _ in range(200):
        automaton, seen = substrings.SuffixAutomaton(), set()
        for _ in range(6):
            s = [rng.choice("abc") for _ in range(rng.randint(0, 15))]
            want = []
            for e in range(1, len(s) + 1):
                want.append(e >= 4 and tuple(s[e - 4 : e]) in seen)
                seen.add(tuple(s[max(0, e - 4) : e]) if e >= 4 else None)
            assert automaton.stream_and_add(s, 4) == want
