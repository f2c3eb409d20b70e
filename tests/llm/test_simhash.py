import random
import re

import numpy as np
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import functions as F

from strata.llm import queries, simhash
from strata.llm.components import _digest, connected_components

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance=4):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(values))]


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_query_equals_brute_force(spark):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    prints = {d["doc_id"]: plain_fingerprint(d["text"]) for d in docs}
    ids = sorted(prints)
    parts = plain_components([prints[i] for i in ids])
    want = {i: (f"{prints[i]:016x}", ids[p]) for i, p in zip(ids, parts)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash(spark, SF_DIR).collect()}
    assert got == want


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(70_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t", "x"), (4, "One two", "x"), (5, "one\ttwo", "x"), (6, long, "x"),
            (6, long, "x"), (None, "alone here", "x"), (7, "É é", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by_id = {r.id: r for r in got}
    assert [by_id[i].component for i in (1, 2, 3)] == [1, 1, 1] and by_id[1].fp == 0
    assert by_id[4].component == by_id[5].component == 4
    assert by_id[6].fp == signed(plain_fingerprint(long)) and by_id[None].component is None
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_dense_groups_and_chains_link_as_all_pairs_do(spark):
    rng = random.Random(5)
    heart = rng.getrandbits(64)
    values = {heart}
    for _ in range(150):
        values.add(heart ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    chain = rng.getrandbits(64)
    for _ in range(12):
        values.add(chain)
        chain ^= sum(1 << b for b in rng.sample(range(64), 4))
    values |= {rng.getrandbits(64) for _ in range(200)}
    values = sorted(values, key=signed)
    counted = spark.createDataFrame([(signed(v), 1) for v in values], "fp long, n long")
    got = {r.node: r.component for r in simhash.link_fingerprints(counted).collect()}
    want = {signed(v): signed(values[p]) for v, p in zip(values, plain_components(values))}
    assert {v: got.get(v, v) for v in want} == want


def test_masks_cover_all_close_pairs():
    masks = simhash.block_masks(4, 6)
    rng = np.random.default_rng(1)
    assert len(masks) == 15
    for _ in range(500):
        x = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(signed(x) & m == 0 for m in masks)


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (8, 9), (1, None), (20, 10), (30, 10), (30, 31)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {2: 2, 3: 2, 4: 2, 5: 2, 8: 8, 9: 8, 7: 7, 10: 10, 20: 10, 30: 10, 31: 10}


def test_digest_of_many_edges(spark):
    many = spark.range(20_000_000).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    assert _digest(many) == _digest(many.repartition(3)) != _digest(many.where("a > 0"))


def grams(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_similar_finds_planted_copies(spark):
    rng = random.Random(3)
    rows, want, pairs = [], {}, []
    for i in range(0, 1200, 2):
        words = [f"w{rng.randrange(5000)}" for _ in range(100)]
        copy = list(words)
        for at in rng.sample(range(100), rng.choice([1, 1, 2, 3])):  # similarities from about 0.73 to 0.98
            copy[at] = "changed"
        rows += [(i, " ".join(words), 1), (i + 1, " ".join(copy).title(), 1)]
        a, b = grams(rows[-2][1]), grams(rows[-1][1].lower())
        want[i], want[i + 1] = i, i if len(a & b) >= 0.8 * len(a | b) else i + 1
        pairs.append(want[i + 1] == i)
    heart = [f"h{i}" for i in range(100)]  # a group in which many pairs are less similar than 0.8
    group = []
    for i in range(2000, 2120):
        words = list(heart)
        for at in rng.sample(range(100), 2):
            words[at] = f"x{i}"
        group.append(grams(" ".join(words)))
        rows.append((i, " ".join(words), 1))
    rows += [(5000, None, 1), (5001, " ", 1), (5002, "few words", 1), (5003, "Few\nwords", 1)]
    want |= {5000: 5000, 5001: 5000, 5002: 5002, 5003: 5002}
    parent = list(range(len(group)))
    for i in range(len(group)):
        for j in range(i):
            if len(group[i] & group[j]) >= 0.8 * len(group[i] | group[j]):
                low, high = sorted((parent[i], parent[j]))
                parent = [low if p == high else p for p in parent]
    got = {r.id: r.component for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()}
    assert all(got[i] >= c for i, c in want.items())  # no pair less similar is linked
    assert sum(got[i + 1] == i for i in range(0, 1200, 2)) >= 0.97 * sum(pairs) and 300 < sum(pairs) < 600
    assert [got[i] for i in range(5000, 5004)] == [5000, 5000, 5002, 5002]
    assert sum(got[2000 + i] == 2000 + p for i, p in enumerate(parent)) >= 0.95 * len(parent)
    assert simhash.similar(spark.createDataFrame(rows[:1], "doc_id long, text string, fp int").limit(0)).count() == 0


def test_dense_group_without_all_pairs(spark, monkeypatch):
    """Copies near one text, half of them too far from it: the links are those of all pairs, and few pairs are looked at."""
    looked_at, staged = [], simhash.staged

    def counted(df, label):
        df = staged(df, label)
        if label == "pairs":
            looked_at.append(df.count())
        return df

    monkeypatch.setattr(simhash, "staged", counted)
    rng = random.Random(4)
    heart, rows, sets = [f"h{i}" for i in range(146)], [], []
    for i in range(400):
        words = list(heart)
        for at in rng.sample(range(0, 145, 5), 2 if i % 2 else 6):
            words[at] = f"x{i}at{at}"
        rows.append((i, " ".join(words)))
        sets.append(grams(rows[-1][1]))
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((part[i], part[j]))
                part = [low if p == high else p for p in part]
    got = {r.id: r.component for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == part and 150 < len(set(part)) < 400
    assert len(looked_at) == 3 and 200 <= sum(looked_at) < 4000  # of 79,800


def test_similar_takes_candidates_from_fingerprint_blocks(spark, monkeypatch):
    """Without any min-hash in common, pairs within four bits are found, and no others."""
    monkeypatch.setattr(simhash, "BANDS", 0)
    monkeypatch.setattr(simhash, "ROWS", 1)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join([*words[: 40 * i], "changed", *words[40 * i + 1 :]])) for i in range(8)]
    rows.append((8, " ".join(f"x{i}" for i in range(400))))
    got = {r.id: r.component for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    prints = [simhash.simhash(sorted(set(simhash.shingles(t.encode(), 5)))) for _, t in rows]
    near = {(i, j) for i in range(8) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4}
    assert near and all(got[i] == got[j] for i, j in near)
    assert got[8] == 8


def test_keys_shared_by_chance_alone_do_not_go_on(spark, monkeypatch):
    """With blocks so short that unrelated texts share many, only near copies keep keys, and all of these are found."""
    with_keys, staged = [], simhash.staged

    def noted(df, label):
        df = staged(df, label)
        if label == "shared":
            with_keys.append(df.count())
        return df

    monkeypatch.setattr(simhash, "staged", noted)
    monkeypatch.setattr(simhash, "NEAR", 4)
    monkeypatch.setattr(simhash, "BLOCKS", 5)  # 13 bits
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(9000)}" for _ in range(100))) for i in range(900)]
    rows += [(900 + i, f"{rows[i][1]} end") for i in range(20)]
    prints = [simhash.fingerprint(t.encode(), 5) for _, t in rows[:900]]
    by_chance = {(i, j) for i in range(900) for j in range(i) if any((prints[i] ^ prints[j]) & m == 0 for m in simhash.block_masks(4, 5))}
    assert len({i for pair in by_chance for i in pair}) > 400
    got = {r.id: r.component for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - 900 if i >= 900 else i for i in range(920)}
    assert len(with_keys) == 1 and 40 <= with_keys[0] < 60
