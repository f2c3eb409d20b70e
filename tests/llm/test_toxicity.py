import itertools

import numpy as np
import pyarrow.parquet as pq

from strata.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF_DIR}/labels.parquet").to_pylist()}
    got = queries.op5_toxicity(spark, SF_DIR).collect()
    assert len(got) == pq.read_table(f"{SF_DIR}/documents.parquet").num_rows and all(0 <= r.score <= 1 for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    hits = sum(p and y for p, y in held)
    # some of this table's labels mark documents without any word of that kind
    assert hits >= 0.85 * sum(y for _, y in held) and hits >= 0.95 * sum(p for p, _ in held)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    steps = rng.standard_normal((2, 2))
    lengths = np.array([1, 2, 4, 5])
    scores = rng.standard_normal((4, 5)) * 3
    p, pairs, norm = toxicity.forward_backward(scores, lengths, steps)
    for i, n in enumerate(lengths):
        total, mark, step = 0.0, np.zeros(5), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(s for s, a in zip(scores[i], y) if a) + sum(steps[a, b] for a, b in zip(y, y[1:])))
            total += w
            mark[: len(y)] += w * np.array(y)
            for a, b in zip(y, y[1:]):
                step[a, b] += w
        assert np.allclose(p[i], mark / total) and np.allclose(pairs[i], step / total) and np.isclose(norm[i], np.log(total))


def test_odd_rows_and_spans(spark):
    rows = [(i, f"you are a rotten fool number{i % 3}. good day friend{i} to all" if i % 4 == 0 else f"good day friend{i % 9} to all of us")
            for i in range(120)]
    odd = [(200, None), (201, ""), (202, "Rotten fool! the day"), (202, "Rotten fool! the day"), (None, "a rotten fool"),
           (203, "good day. " * 40_000 + "é rotten fool")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows + odd], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(0, 0), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {}
    for r in toxicity.score(docs, model).collect():
        got.setdefault(r.id, []).append(r)
    assert len(got[202]) == 2 and got[202][0].score > 0.7 > got[201][0].score == got[200][0].score == got[1][0].score
    assert [tuple(s) for s in got[202][0].spans] == [(0, 12)] and [tuple(s) for s in got[None][0].spans] == [(2, 13)]
    start = len("good day. " * 40_000) + 2
    assert [tuple(s) for s in got[203][0].spans] == [(start, start + 11)] and got[203][0].score > 0.7
    assert toxicity.fit(docs.limit(0), labels) is None and toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_chains():
    words = ["a", "b.", *["c"] * 130]
    assert toxicity.chains(words) == [(0, 2), (2, 66), (66, 130), (130, 132)] and toxicity.chains([]) == []
