"""The pipeline's decisions on a small corpus, stage by stage and as a whole."""

import pytest
import sentencepiece

import corpus_pipeline
from lakeworks.llm import language, sentencepiece_fst
from lakeworks.llm.texts import words_of
from lakeworks.llm.token_counts import place

from .conftest import prose

BENCH = "what is the name of the river that runs through the old town of stone"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    base, passage = prose(1, 300), " ".join(prose(2, 70))
    near = [*base[:100], "changed", *base[101:]]
    texts = {
        1: " ".join(base), 2: " ".join(near), 3: " ".join(base),  # near and exact copies of 1
        4: " ".join(prose(3, 90)) + " " + passage, 5: passage + " " + " ".join(prose(4, 90)),  # share a passage
        6: passage, 7: " ".join(prose(5, 80)) + ". " + BENCH + ". end", 8: BENCH,
        9: "", 10: None, 11: "1234 #### 5678", 12: " ".join(prose(6, 50)), 13: " ".join(prose(7, 6)),
    }
    rows = [(i, t, None if i == 12 else "en", "s", len(t) if t is not None else None) for i, t in texts.items()]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, BENCH)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, passage


def test_stages(spark, corpus):
    folder, texts, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = [
        {1, 2, 3, 4, 5, 6, 7, 8, 12, 13},  # 9, 10 and 11 have no letters that tell
        {1, 4, 5, 6, 7, 8, 12, 13},
        {1, 4, 5, 7, 8, 12, 13},  # 6 was nothing but the passage
        {1, 4, 5, 7, 12, 13},  # 8 was nothing but the item
    ]
    for (name, stage), ids in zip(corpus_pipeline.STAGES[:4], want):
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = {r.doc_id: r for r in docs.collect()}
        assert set(rows) == ids, name
        assert all(r.n_chars == len(r.text) for r in rows.values())
        docs = spark.createDataFrame([tuple(r) for r in rows.values()], docs.schema)
    assert words_of(rows[5].text) == words_of(texts[5])[len(words_of(passage)) :]
    assert rows[7].text == texts[7].replace(BENCH, "")
    assert all(rows[i].text == texts[i] for i in (1, 4, 12, 13))


def test_run(spark, corpus):
    folder, texts, _ = corpus
    library = sentencepiece.SentencePieceProcessor(model_file=place("piece_bpe_32k.model"))
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(rows) == {1, 4, 5, 7, 12, 13} and all(r.round_trip for r in rows.values())
    for i in (1, 4, 12, 13):
        assert rows[i].ids == library.encode(texts[i]) and rows[i].n_pieces == len(rows[i].ids)


def test_empty_tables(spark, corpus, tmp_path):
    folder, _, _ = corpus
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_odd_rows_going(spark, corpus, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus[0])
    assert docs.count() >= 2


def python_steps(df):
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")


def test_one_python_worker_a_task(spark, make):
    """Two steps over Arrow in one task keep two workers alive, in an executor of two cores four."""
    docs = make([(i, " ".join(prose(i, 40))) for i in range(20)])
    languages, model = language.train(docs, "text", "lang")
    assert python_steps(language.identify(docs, languages, model, host="source")) == 1
    assert python_steps(corpus_pipeline.encoded(spark, docs, "")) == 1


def test_one_step_gives_what_two_give(spark, make, odd):
    model = place("piece_bpe_32k.model")
    two = sentencepiece_fst.digests(sentencepiece_fst.encode(odd, model), model, with_ids=True)
    assert sorted(map(str, sentencepiece_fst.encoded_digests(odd, model, with_ids=True).collect())) == sorted(map(str, two.collect()))


def test_languages_in_slices_of_a_batch(spark, make):
    """A batch of more bytes than a slice: each row keeps the priors of its own host."""
    rows = [(i, " ".join(prose(i % 7, 20 if i % 5 else 1500)), ("en", "fr", "de")[i % 7 % 3], f"h{i % 4}", 1) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    languages, model = language.train(docs, "text", "lang")

    def found(size):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        return sorted((r.doc_id, r.language, round(r.posterior, 9)) for r in language.identify(docs, languages, model, host="source").collect())

    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        assert found("10000") == found("1")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
