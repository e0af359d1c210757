"""The operators' registered queries over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lakeworks.llm import (
    decontamination,
    fill_middle,
    jaccard,
    language,
    oracles,
    packing,
    quality,
    resampling,
    sentencepiece_fst,
    sharding,
    suffixes,
    token_counts,
    token_files,
    winnowing,
)
from lakeworks.llm.texts import table
from lakeworks.llm.token_counts import place
from lakeworks.runtime import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


QUERIES["pipeline"] = corpus_pipeline.run


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_dedup(spark, sf_dir):
    """All documents with passages of fifty words or more that an earlier document holds cut out."""
    found = suffixes.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_cut", "cut_spans", "text")


@query
def op2_sharding(spark, sf_dir):
    """All documents in 40 shards of nearly equal bytes, equal texts together."""
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 40)


@query
def op3_language_id(spark, sf_dir):
    """The language of every document, from its text and from how its source reads."""
    docs = table(spark, sf_dir, "documents")
    languages, model = language.train(docs, "text", "lang")
    found = language.identify(docs.drop("lang"), languages, model, host="source")
    return found.select("doc_id", "language", "posterior", "accepted")


@query
def op3_language_id_pages(spark, sf_dir):
    """The language of every page, from its text, markup, address suffix and host."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    languages, model = language.train(docs, "text", "lang")
    host = language.host_of(F.col("url"))
    rows = pages.select(
        "page_id", language.visible(F.col("html")).alias("text"), host.alias("host"),
        language.suffix_of(host).alias("suffix"), language.declared_in(F.col("html")).alias("declared"),
    )
    found = language.identify(
        rows, languages, model, host="host", declared=F.col("declared"), suffix=F.col("suffix")
    )
    return found.select("page_id", "host", "declared", "language", "posterior", "accepted")


@query
def op4_jaccard_join(spark, sf_dir):
    """The class of every document among texts at a similarity of 0.8 or more, and its links."""
    return jaccard.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query
def op5_decontamination(spark, sf_dir):
    """Words of every document that lie in ten words of a benchmark item."""
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.drop("spans")


ORACLES["op5_decontamination"] = oracles.DECONTAMINATION


@query
def op6_token_files(spark, sf_dir):
    """All documents as token files, read back: offsets, sizes and checksums of the ids."""
    where = fresh_path(spark, "tokens")
    token_files.write_token_store(table(spark, sf_dir, "documents"), where, place("word_bpe_49k.json"), end=2)
    return token_files.with_crc32(token_files.read_tokens(spark, where))


@query
def op7_token_counts(spark, sf_dir):
    """Tokens of every document by the compiled tokenizer."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), place("word_bpe_49k.json"))


@query
def op8_sentencepiece(spark, sf_dir):
    """Every document encoded and decoded again."""
    model = place("piece_bpe_32k.model")
    return sentencepiece_fst.encoded_digests(table(spark, sf_dir, "documents"), model)


@query
def op9_quality(spark, sf_dir):
    """Quality scores of every document."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_winnowing(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return winnowing.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op11_importance_resampling(spark, sf_dir):
    """Every document's weight towards the benchmark's words, and the quarter that is drawn."""
    found = resampling.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("n_words")


ORACLES["op11_importance_resampling"] = oracles.RESAMPLING


@query
def op12_fill_in_middle(spark, sf_dir):
    """All documents cut at two line ends and put in the order that a model fills gaps from."""
    found = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


ORACLES["op12_fill_in_middle"] = oracles.FILL_IN_MIDDLE


@query
def op13_packing(spark, sf_dir):
    """All documents cut into sequences of 2048 tokens, each with the sources in their shares."""
    return packing.pack(table(spark, sf_dir, "documents"), place("word_bpe_49k.json"), with_ids=False)
