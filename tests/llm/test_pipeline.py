import base64

import public_tokenizers
import pyarrow.parquet as pq
import test_common
import test_mixing
import test_quality_cascade
import test_simhash
import test_substrings
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from strata.llm import simhash

SF_DIR = "/root/testdata/sf0.001"


def good_documents(docs):
    return sorted((d for d in docs if test_quality_cascade.plain(d["text"])[-1]), key=lambda d: d["doc_id"])


def first_of_near_copies(docs):
    """Documents, in order, that are the first of those reachable over pairs with a similarity of five-word shingles of 0.8."""
    sets = [test_simhash.grams(d["text"].lower()) for d in docs]
    part = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((part[i], part[j]))
                part = [low if p == high else p for p in part]
    return [d for i, d in enumerate(docs) if part[i] == i]


def brute_force(docs):
    """Rows (doc_id, source, text) that reach the last stage."""
    docs = first_of_near_copies(good_documents(docs))
    found, kept = test_substrings.plain([d["text"] for d in docs])
    rows = []
    for d, f, k in zip(docs, found, kept):
        if k:
            rows.append((d["doc_id"], " ".join(k) if len(k) < len(f) else d["text"], d["source"]))
    return rows


def test_run_equals_brute_force(spark):
    rows = brute_force(pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist())
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((i, s, library.encode_ordinary(t)) for i, s, t in test_mixing.taken_texts(rows))
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert all(r.decodes and r.n_tokens == len(r.ids) for r in got)
    assert sorted((r.doc_id, r.source, r.ids) for r in got) == want


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_odd_rows_pass_through(spark):
    text = " ".join(f"word{i} of{i % 7} text{i % 11}" for i in range(60))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, text + " again", None, None, None), (2, None, "en", "a", 0),
            (3, "", None, "b", 0), (None, None, None, None, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, id string")
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), stage(spark, docs, SF_DIR).schema)
    assert {r.doc_id for r in docs.collect()} <= {1, None} and docs.count() > 0


def test_keep_first(spark):
    rows = [(5, "a b"), (3, "A b"), (3, "a B"), (None, "a b"), (None, "lonely one"), (None, "lonely one"), (7, None), (8, "")]
    got = simhash.keep_first(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")).collect()
    assert sorted((r.doc_id or 99, (r.text or "").lower()) for r in got) == [(3, "a b"), (7, ""), (99, "lonely one")]


def test_registered():
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_a_copy_with_one_changed_word_goes(spark):
    words = [f"word{i * i % 997}" for i in range(100)]
    texts = [" ".join(words[:at] + [f"changed{at}"] + words[at + 1 :]) for at in (10, 30, 50, 70, 90)]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate([" ".join(words), *texts])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.distinct(spark, docs, SF_DIR).collect()] == [0]


def test_near_copies_equal_brute_force_by_similarity(spark):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    docs = good_documents(docs)
    want = [d["doc_id"] for d in first_of_near_copies(docs)]
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").where(F.col("doc_id").isin([d["doc_id"] for d in docs]))
    assert sorted(r.doc_id for r in corpus_pipeline.distinct(spark, table, SF_DIR).select("doc_id").collect()) == want


def test_stages_leave_little_on_disk(spark):
    docs = test_common.documents(spark).selectExpr("doc_id", "text", "'en' lang", "'a' source", "cast(length(text) as long) n_chars")
    before = test_common.tables(spark)
    for stage in (corpus_pipeline.distinct, corpus_pipeline.without_repeats):
        assert stage(spark, docs, SF_DIR).count() > 0
    assert {t.split("-")[0] for t in test_common.tables(spark) - before} == {"similar", "repeats"}
