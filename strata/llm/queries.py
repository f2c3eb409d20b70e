"""The registered queries of this subpackage: each applies one operator to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    bpe, chat, embeddings, html, langid, mixing, negatives, oracles, periodic, quality, simhash, substrings, token_store, toxicity,
)
from strata.llm.common import staged, word_array


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    train = docs.where(~langid.held_out(F.col("doc_id")))
    model = langid.fit(train.select(F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text"))
    found = langid.predict(docs, model).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(False))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").cast("long").alias("component_id"), kept.alias("kept")
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.judge(_table(spark, sf_dir, "documents"), report=facts)
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return judged.select(F.col("id").alias("doc_id"), *facts, failed.alias("base_failed"), "kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~langid.held_out(F.col("doc_id"))).select("doc_id", "toxic"))
    found = toxicity.score(docs, model).withColumnRenamed("id", "doc_id")
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_text(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_store.new_folder(spark)
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    token_store.write(_table(spark, sf_dir, "documents"), folder, vocabulary, end_id=1, by_word=True)
    found = token_store.read(spark, folder)
    return found.select(
        F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, pattern)
    digest = F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256)
    coded = coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"))
    back = bpe.decode(coded, ranks, pattern, keep=("doc_id", "n_tokens", "ids_sha256"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")
    said = F.lit("\\### Assistant: </turn> ok").alias("text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, said)
    formatted = staged(chat.format_conversations(rows.unionByName(planted)), "chat")
    texts = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = chat.read_back(formatted).select(
        "conv", "n_chars", F.size("turns").alias("n"), F.struct("part", F.array_join(texts, "").alias("turns"), "learnt").alias("of")
    )
    parts = F.sort_array(F.collect_list("of")).alias("of")
    whole = back.groupBy("conv").agg(parts, F.sum("n").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"))
    learnt = F.array_join("of.learnt", "")
    valid = chat.verdicts(formatted).select(F.col("conv").alias("judged"), "valid")
    return whole.join(valid, F.col("conv").eqNullSafe(F.col("judged"))).select(
        F.col("conv").alias("conv_id"),
        "n_turns",
        F.sha2(F.array_join("of.turns", ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.select("vec_id", label.alias("label"), "embedding")
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where the texts of every tenth hash go on periodically from some word on."""
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, word_array(F.col("text"))))
    rows = rows.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.expr("int(g % greatest(n, 1))")).withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    block = "flatten(array_repeat(slice(words, a + 1, p), int(ceil((n - a) / p))))"
    planted = F.expr(f"array_join(concat(slice(words, 1, a), slice({block}, 1, n - a)), ' ')")
    return rows.select("doc_id", F.when(F.expr("h % 10 = 0 AND n > 0"), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(with_planted_periods(_table(spark, sf_dir, "documents")), carry=["doc_id"])

    def better(best, one):
        return F.when(best.isNull() | (one["length"] * best["period"] > best["length"] * one["period"]), one).otherwise(best)

    none = F.lit(None).cast(found.schema["runs"].dataType.elementType)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n"))))
    found = found.withColumn("best", F.aggregate("runs", none, better))
    return found.select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def all_queries() -> dict:
    every = (
        op1_simhash, op2_language, op3_embeddings, op4_quality, op5_toxicity,
        op6_html, op7_token_store, op8_bpe, op9_substrings, op10_mixing, op11_chat, op12_negatives, op13_periodic,
    )
    return {f.__name__: f for f in every}


def all_oracles() -> dict[str, str]:
    return {
        "op4_quality": oracles.QUALITY, "op10_mixing": oracles.MIXING, "op11_chat": oracles.CHAT, "op12_negatives": oracles.NEGATIVES,
    }
