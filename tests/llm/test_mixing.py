import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing


def plain_targets(sizes):
    """Sizes by source, in order: shares by weight, what is over reshared until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: 1 + i % 3 for i, s in enumerate(names)}
    out, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * level > 3 * sizes[s]}
        if not over:
            return out | {s: weights[s] * level for s in open_}
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def check(rows, got):
    sizes, members = defaultdict(int), defaultdict(list)
    for i, t, s in rows:
        n = len((t or "").split())
        sizes[s] += n
        members[s].append((int(hashlib.md5(b"" if i is None else str(i).encode()).hexdigest()[:15], 16), i is not None, i or 0, n))
    want, by_source = plain_targets(sizes), defaultdict(list)
    for r in got:
        by_source[r.row.source].append(r)
    for s, rs in by_source.items():
        assert {r.source_size for r in rs} == {sizes[s]}
        assert all(math.isclose(r.target, want[s], abs_tol=1e-9) for r in rs)
        assert sum(r.taken for r in rs) == round(rs[0].target) and all(0 <= r.taken <= 3 * r.size for r in rs)
        start, budget, expected = 0, round(rs[0].target), []
        for _, _, i, n in sorted(members[s]):
            e = budget // sizes[s] if sizes[s] else 0
            expected.append((i, n, e * n + max(0, min(n, budget - e * sizes[s] - start))))
            start += n
        assert sorted((r.row.doc_id or 0, r.size, r.taken) for r in rs) == sorted(expected)


def taken_texts(rows):
    """(id, source, text) for each time a document of (id, text, source) is taken."""
    sizes, members, out = defaultdict(int), defaultdict(list), []
    for i, t, s in rows:
        sizes[s] += len(t.split())
        members[s].append((int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), i, t))
    for s, target in plain_targets(sizes).items():
        epochs, left = divmod(round(target), sizes[s])
        for _, i, t in sorted(members[s]):
            words = t.split()
            part = min(len(words), left)
            left -= part
            out += [(i, s, t)] * (epochs + (part == len(words)))
            if 0 < part < len(words):
                out.append((i, s, " ".join(words[:part])))
    return out


CASES = [
    [(i, "w " * (i % 17), f"s{i % 5}") for i in range(200)],
    [(i, "w " * (1 if i % 50 else 900), "abcdefg"[i % 7] if i % 50 else None) for i in range(300)],
    [(1, "a b c", "x"), (1, "a b c", "x"), (None, "a b", None), (2, None, "x"), (3, "", "é"), (4, "one " * 50_000, "é"), (None, "a b", None)],
    [(1, "", "x"), (2, None, None)],
    [(1, "a b c", "only")],
]


@pytest.mark.parametrize("rows", CASES)
def test_mix(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, key int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    check(rows, got)


def test_empty_table_and_epochs(spark):
    df = spark.createDataFrame([(i, f"a{i}  b\nc", "s", 99) for i in range(9)], "doc_id long, text string, source string, n_chars long")
    assert mixing.mix(df.limit(0)).count() == 0
    small = df.union(df.select("doc_id", "text", F.lit("t").alias("source"), "n_chars").limit(3))
    mixed = mixing.mix(small)
    out = mixing.epochs(mixed)
    assert out.columns == df.columns
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    assert words(out.collect()) == mixed.agg(F.sum("taken")).first()[0] == 36
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    plan = mixing.mix(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
