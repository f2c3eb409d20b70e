import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from strata.llm import langid, queries

SF_DIR = "/root/testdata/sf0.01"


def test_accuracy_on_held_out_documents(spark):
    docs = {d["doc_id"]: d for d in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()}
    got = queries.op2_language(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and docs[r.doc_id]["lang"]]
    right = [r.lang_pred == docs[r.doc_id]["lang"] for r in held]
    assert np.mean(right) > 0.97 and abs(np.mean([r.score for r in held]) - np.mean(right)) < 0.05
    assert all(0 <= r.score <= 1 for r in got)


def plain_grams(text):
    chars = "".join(c if c.isalpha() else " " for c in " " + text.lower()) + "  "
    out = Counter()
    for i in range(len(chars) - 2):
        a, b = chars[i], chars[i + 1]
        out[1] += a != " "
        out[2] += a != " " or b != " "
        out[3] += b != " "
    return out


def test_grams_do_not_reach_into_other_texts():
    found = ["Añb, c", "", "x", "  é1 ", "İstanbul ǅ"]
    many, starts = langid.grams([t.encode() for t in found])
    for i, t in enumerate(found):
        end = starts[i + 1] if i + 1 < len(found) else many.shape[1]
        alone, _ = langid.grams([t.encode()])
        assert (many[:, starts[i] : end] == alone).all()
        assert [(row < langid.BUCKETS).sum() for row in alone] == [plain_grams(t)[n] for n in (1, 2, 3)]


def test_long_texts_in_stretches(monkeypatch):
    found = [t.encode() for t in ("İstanbul ΟΔΟΣ, c  é1 ǅ" * 9, "", "a", "x ΑΣ")]
    whole, starts = langid.grams(found)
    for size in (1, 2, 3, 7, 50, 100):
        parts = [[] for _ in found]
        for i, at, _ in langid.stretches(found, size):
            parts[i].append(at)
        assert (np.concatenate([np.concatenate(p, axis=1) for p in parts], axis=1) == whole).all()
    model = langid.Model(["a", "b"], np.random.default_rng(3).standard_normal((langid.BUCKETS + 1, 2)), 1.0, np.zeros(2))
    scores, total = model.scores(found)
    counts = langid.counted(found)
    monkeypatch.setattr(langid.stretches, "__defaults__", (5,))
    again = model.scores(found)
    assert np.allclose(scores, again[0]) and (total == again[1]).all()
    assert all((a == b).all() and (n == m).all() for (a, n), (b, m) in zip(counts, langid.counted(found), strict=True))


def test_memory_does_not_grow_with_the_text():
    classes = [str(i) for i in range(8)]
    model = langid.Model(classes, np.ones((langid.BUCKETS + 1, 8), np.float32), 1.0, np.zeros(8))
    text, peaks = b"some words, and 12 more. " * 40_000, []
    for times in (1, 16):
        tracemalloc.start()
        scores, total = model.scores([text * times])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert total[0] > 10**6 * times and np.ptp(scores) == 0
    assert peaks[1] - peaks[0] < 15 * len(text) * 4  # the text, as bytes, characters and in lower case


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog " * 5, "en", "x") for i in range(20)]
    rows += [(i, "der hund und die katze " * 5, "de", "x") for i in range(20, 40)]
    rows += [(50, None, "en", "x"), (51, "", "en", "x"), (52, "12 34 !", "en", "x"), (53, "the dog", None, "x"),
             (None, "die katze", "de", "x"), (54, "the and " * 60_000, None, "x"), (54, "the and", None, "x")]
    df = spark.createDataFrame(rows, "key long, text string, label string, score string")
    model = langid.fit(df)
    assert model.classes == ["de", "en"] and (model.table[:-1] == 0).mean() > 0.9
    got = {}
    for r in langid.predict(df, model, id_col="key").collect():
        got.setdefault(r.id, []).append((r.lang_pred, r.score))
    assert got[50] == got[51] == got[52] == [("und", 0.0)]
    assert got[53][0][0] == "en" and got[None][0][0] == "de" and len(got[54]) == 2 and got[54][0][0] == "en"
    nothing = df.limit(0)
    assert langid.fit(nothing) is None and langid.predict(nothing, None, id_col="key").count() == 0
    assert {r.lang_pred for r in langid.predict(df, langid.fit(nothing), id_col="key").collect()} == {"und"}


def test_temperature():
    rng = np.random.default_rng(0)
    scores = rng.standard_normal((4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in langid.softmax(scores)])
    assert 2.6 < langid.fit_temperature(3 * scores, labels) < 3.5


def test_penalties_leave_weights_out():
    rng = np.random.default_rng(1)
    model = langid.Ftrl(50, 2, l1=0.5)
    for _ in range(400):
        label = int(rng.integers(2))
        x = rng.standard_normal(50) * 0.05
        x[0] = 1 if label else -1
        model.learn(np.arange(50), x, label)
    w = model.weights()
    assert np.sign(w[0]).tolist() == [-1, 1] and (w[1:] == 0).mean() > 0.8
