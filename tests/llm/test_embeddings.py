import math

import numpy as np
import pyarrow.parquet as pq

from strata.llm import embeddings, queries

SF_DIR = "/root/testdata/sf0.01"


def brute_force(rows, threshold=0.98):
    """Links by row number of (id, vector, label)."""
    links = {i: set() for i in range(len(rows))}
    by = {}
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            by.setdefault((label, len(v)), []).append(i)
    for members in by.values():
        x = np.array([rows[i][1] for i in members], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= threshold)):
            if a != b:
                links[members[a]].add(members[b])
    return links


def parts(links):
    out = {}
    for i in links:
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = seen
    return out


def test_recall_on_the_given_table(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist()]
    links = brute_force(rows)
    got = {r.vec_id: r for r in queries.op3_embeddings(spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    total = sum(len(x) for x in links.values())
    found = sum(got[rows[i][0]].n_links for i in links)
    assert all(got[rows[i][0]].n_links <= len(x) for i, x in links.items()) and found >= 0.95 * total
    if found == total:
        for i, seen in parts(links).items():
            assert got[rows[i][0]].component_id == min(rows[j][0] for j in seen)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def made_up():
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for label in (1, 2):
        for _ in range(30):
            heart = rng.standard_normal(64)
            for _ in range(rng.integers(1, 9)):
                near = heart + rng.standard_normal(64) * rng.choice([0, 0.05, 0.1, 0.14])
                rows.append((i, (near * rng.uniform(0.1, 9)).tolist(), label))
                i += 1
        step = rng.standard_normal(64)
        for _ in range(12):  # a chain, each near the next one
            rows.append((i, step.tolist(), label))
            step = step + rng.standard_normal(64) * 0.12
            i += 1
    return rows


def test_made_up_vectors(spark):
    rows = made_up()
    links = brute_force(rows)
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<double>, label int, n long")
    got = {r.id: r for r in embeddings.near_duplicates(df, recall=0.999999).collect()}
    assert {i: got[i].n_links for i in got} == {i: len(x) for i, x in links.items()}
    assert {i: got[i].component for i in got} == {i: min(s) for i, s in parts(links).items()}


def test_odd_rows(spark):
    one, nan = [1.0, 2.0, 3.0], float("nan")
    rows = [(1, one, 1), (2, one, 1), (2, one, 1), (None, one, 1), (3, one, None), (4, None, 1), (5, [], 1), (6, [0.0] * 3, 1),
            (7, [1.0, None, 3.0], 1), (8, [1.0, nan, 3.0], 1), (9, [1.0, float("inf"), 3.0], 1), (10, [2.0, 4.0, 6.0], 1),
            (11, [1.0, 2.0], 1), (12, one, 2), (13, [3.0, -1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.id or 0, r.n_links, r.component) for r in embeddings.near_duplicates(df).collect())
    alone = [(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 11, 12, 13)]
    assert got == sorted([(0, 4, 1), (1, 4, 1), (2, 4, 1), (2, 4, 1), (10, 4, 1)] + alone)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_calibration():
    half, least = embeddings.calibrated(0.98, 16, 3, 0.99)
    rng = np.random.default_rng(0)
    u = rng.standard_normal(64)
    u /= np.linalg.norm(u)
    w = rng.standard_normal(64)
    w -= (w @ u) * u
    v = 0.98 * u + math.sqrt(1 - 0.98**2) * w / np.linalg.norm(w)
    lines = rng.standard_normal((20_000, 16, 64))
    hits = np.abs(lines @ (u - v)) <= half
    assert (hits[:, :3].all(axis=1) & (hits[:, 3:].sum(axis=1) >= least)).mean() >= 0.988


def test_extreme_magnitudes(spark):
    """Very large and very small components, of both signs, link as they do when scaled to one."""
    plain = [(1.0, 1.0), (1.0, 1.8), (1.0, 2.2), (-1.0, -2.2), (-1.0, 2.2), (1.0, 1.01), (3.0, -1.0)]
    rows = [(k * 10 + i, k, [x * size for x in v]) for k, size in enumerate((1.0, 1e200, 1e-200, 1e306, 1e-306)) for i, v in enumerate(plain)]
    rows += [(100, 9, [5e-324, 0.0]), (101, 9, [1e308, 0.0]), (102, 9, [0.0, 5e-324]), (103, 9, [-1e308, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r.id: (r.n_links, r.component) for r in embeddings.near_duplicates(df).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in enumerate(plain)}
    for k in range(5):
        for i in range(len(plain)):
            links = sum(j != i and float(unit[i] @ unit[j]) >= 0.98 for j in unit)
            assert got[10 * k + i][0] == links
            assert got[10 * k + i][1] - 10 * k == got[i][1]
    assert [got[i] for i in (100, 101, 102, 103)] == [(1, 100), (1, 100), (0, 102), (0, 103)]
