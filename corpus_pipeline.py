"""A corpus from raw documents to token ids, in stages that each write their rows for the next one.

Each stage works on all that the one before kept and returns the columns of ``documents``, the last one ids instead:

1. quality rules: documents that break one go;
2. SimHash near copies: candidates by fingerprint blocks, and bands for those further apart, verified by fingerprint and by a
   similarity of 0.8 of their five-word shingles; of each group the document with the smallest id stays;
3. repeated passages: words that an earlier window covers go, and documents of which nothing is left;
4. mixture: documents are taken as often as their source's target says, the last one of a source in part;
5. byte-level BPE: the ids of each text, and the bytes that they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, mixing, quality, simhash, substrings
from strata.llm.common import staged

RANKS = "byte_bpe_50k.tiktoken"

#: SQL for the rows of ``run``; the ranks of a vocabulary file and 64-bit XXH hashes are out of its reach.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in small batches: they are long, and both sides hold a whole batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule. NULL and empty texts do not."""
    _small_batches(spark)
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; of rows with equal ids and texts one."""
    _small_batches(spark)
    return simhash.keep_first(docs, width=5, similarity=0.8, distance=18)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start earlier; a text that loses no word is unchanged, one that loses all goes."""
    _small_batches(spark)
    found = substrings.remove_repeats(docs).where("n_words > n_removed OR n_removed = 0")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    rows = found.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
    return rows.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else rows


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their targets: a row for each time a document is taken."""
    return mixing.epochs(mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the text's ids and how many, and whether they decode to the text's bytes again."""
    _small_batches(spark)
    path = public_tokenizers.path(RANKS)
    docs = docs.select("doc_id", "source", "text", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    # Written before they are decoded, so that a task runs one Python worker at a time, not two.
    coded = staged(bpe.encode(docs, path, public_tokenizers.PATTERN, keep=("doc_id", "source", "digest")), "ids")
    back = bpe.decode(coded, path, public_tokenizers.PATTERN, keep=("doc_id", "source", "ids", "digest"))
    return back.select(
        "doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.md5("bytes") == F.col("digest")).alias("decodes")
    )


STAGES = [
    ("quality_rules", good),
    ("simhash_near_dedup", distinct),
    ("substring_dedup", without_repeats),
    ("source_mixing", mixture),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
