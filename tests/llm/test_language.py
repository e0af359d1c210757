"""Language identification: held-out accuracy, and each kind of evidence on its own."""

import pytest
from pyspark.sql import functions as F

from lakeworks.llm import language, quality
from lakeworks.llm.queries import QUERIES


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return language.train(docs.where(~quality.held_out(F.col("doc_id"))), "text", "lang")


def test_held_out_accuracy(spark, trained):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumnRenamed("lang", "truth")
    found = language.identify(docs.where(quality.held_out(F.col("doc_id"))), *trained, host="source").collect()
    assert sum(r.language == r.truth for r in found) > 0.98 * len(found) and all(r.accepted for r in found)


def test_every_kind_of_evidence(spark, trained):
    rows = [(1, "", None, None, "de"), (2, None, "x.fr", "fr", None), (3, "123 %%", "", "", ""), (4, "?", "x.es", "es", "en")]
    df = spark.createDataFrame(rows, "id long, text string, h string, s string, d string")
    found = {r.id: r for r in language.identify(df, *trained, host="h", suffix=F.col("s"), declared=F.col("d")).collect()}
    assert (found[1].language, found[2].language, found[4].language) == ("de", "fr", "en")
    assert found[3].language is None and not found[3].accepted


def test_host_decides_where_the_text_does_not(spark, trained):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'es'").limit(20).collect()]
    df = spark.createDataFrame([(i, t, "host") for i, t in enumerate(docs)] + [(99, "en", "host"), (98, "en", "other")], "id long, text string, h string")
    found = {r.id: r for r in language.identify(df, *trained, host="h").collect()}
    assert found[99].posterior != found[98].posterior and found[99].language == "es"


def test_other_scripts_are_no_known_language(spark, trained):
    df = spark.createDataFrame([(1, "это предложение на другом языке " * 20), (2, "漢字仮名交じり文" * 20)], "id long, text string")
    assert [r.accepted for r in language.identify(df, *trained).collect()] == [False, False]


def test_markup():
    import re

    assert re.search(r"(?i)<html[^>]*\blang", "<!DOCTYPE html><HTML class=x lang='de-AT'>")


def test_pages_query(spark, sf_dir):
    found = QUERIES["op3_language_id_pages"](spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert sum(r.language == r.declared for r in found if r.declared) > 0.9 * sum(bool(r.declared) for r in found)


def test_odd_rows(spark, odd, trained):
    found = language.identify(odd, *trained, host="source").collect()
    assert len(found) == odd.count() and all(r["a.b"] == "x" for r in found)
    assert {r.accepted for r in found if not r.text} == {False}


def test_empty_table(odd, trained):
    none = odd.limit(0)
    assert language.identify(none, *trained, host="source").count() == 0
    assert language.train(none, "text", "lang")[0] == []
