"""From raw documents to token ids, in five stages that each write what the next one reads.

1. Language ID: documents whose language no evidence tells are left out.
2. N-gram Jaccard join: one document of each class of near copies stays, the one of least doc_id.
3. Suffix-array dedup: passages of fifty words or more that an earlier document holds are cut out; a
   document that had nothing else goes.
4. Benchmark decontamination: runs of ten words of a benchmark item are cut out; a document of which they
   were more than half goes.
5. SentencePiece encoding and decoding: ids of what is left, with the check that they give the text back.

Stages keep all columns of documents, with n_chars brought up to date where the text has changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm import decontamination, jaccard, language, sentencepiece_fst, suffixes
from lakeworks.llm.texts import small_batches, table
from lakeworks.llm.token_counts import place
from lakeworks.runtime import materialise


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that evidence tells; the labels of `docs` train the text model. Without any
    label nothing can be told, and all documents stay."""
    small_batches(spark)
    languages, model = language.train(docs, "text", "lang")
    if not languages:
        return docs
    found = language.identify(docs, languages, model, host="source")
    return found.where("accepted").select(docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents hold."""
    found = suffixes.repeats(docs).where("n_cut = 0 or n_cut < n_words")
    return found.withColumn(
        "n_chars", F.when(F.col("n_cut") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    ).select(docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's passages."""
    before = docs.withColumn("n_chars", F.struct("n_chars", F.length("text").alias("was")))
    found = decontamination.remove(before, table(spark, sf_dir, "benchmark"))
    size = F.length("text")
    return found.withColumn(
        "n_chars",
        F.when(size == F.col("n_chars.was"), F.col("n_chars.n_chars"))
        .otherwise(F.coalesce(size.cast(docs.schema["n_chars"].dataType), F.col("n_chars.n_chars"))),
    )


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the decoded text's digest and whether it is the text."""
    model = place("piece_bpe_32k.model")
    return sentencepiece_fst.encoded_digests(docs, model, with_ids=True)


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_near_copies),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmarks),
    ("SentencePiece encoding and decoding", encoded),
]

#: SQL cannot express these stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
