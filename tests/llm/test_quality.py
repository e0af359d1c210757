"""Quality scores: passages, gradients, held-out ranking."""

import numpy as np
from pyspark.sql import functions as F

from lakeworks.llm import quality


def test_passages_cover_whole_texts():
    texts = ["", None, "a" * 999, "b c " * 250, "b c " * 251, "x\n" * 5000]
    features, firsts = quality.passages(texts)
    assert np.diff(firsts).tolist() == [1, 1, 1, 1, 2, 10]
    assert features.shape == (16, quality.FEATURES) and np.isfinite(features).all()
    alone = [quality.passages([t])[0] for t in texts]
    assert np.allclose(np.concatenate(alone), features)  # a text's features do not depend on its batch


def test_slopes_follow_the_loss():
    rng = np.random.default_rng(0)
    x, firsts = rng.normal(size=(40, 5)), np.array([0, 3, 10, 11, 25, 40])
    y = np.array([0.0, 1, 0, 1, 1])
    fits = [quality.Attention.fitted(x, firsts, y, quality.Fit(rounds=n)) for n in (1, 300)]
    loss = [-np.mean(np.log(np.where(y == 1, p, 1 - p))) for p in (f.score(x, firsts) for f in fits)]
    assert loss[1] < 0.1 * loss[0]


def test_attention_finds_the_passage_that_matters():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(8, 4)) for _ in range(300)]
    labels = rng.integers(0, 2, 300).astype(float)
    for bag, label in zip(bags, labels):
        bag[rng.integers(8), 0] = 6 if label else -6  # one of eight passages tells
    firsts = np.arange(0, 2401, 8)
    model = quality.Attention.fitted(np.concatenate(bags[:200]), firsts[:201], labels[:200], quality.Fit())
    scores = model.score(np.concatenate(bags[200:]), firsts[:101])
    assert np.mean((scores >= 0.5) == labels[200:]) > 0.9


def test_held_out_ranking(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality.score_quality(docs, labels).where("held_out").join(labels, "doc_id").collect()
    low, high = ([r.score for r in found if r.quality == q] for q in (0, 1))
    assert len(low) > 5 and np.mean([a < b for a in low for b in high]) > 0.97


def test_labels_held_out_are_not_read(spark, make):
    docs = make([(i, ("good words here. " if i % 2 else "%% $$ ## ") * 9) for i in range(60)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.score_quality(docs, x).collect()} for x in (labels, turned))
    assert a == b and all((s >= 0.5) == bool(i % 2) for i, s in a.items())


def test_one_key_with_many_rows(spark, make, monkeypatch):
    """A labelled key that holds most rows, equal and different ones, takes no other key's place in the sample."""
    sizes, fitted = [], quality.Attention.fitted.__func__

    def watched(cls, features, firsts, labels, fit):
        sizes.append((len(labels), int(labels.sum())))
        return fitted(cls, features, firsts, labels, fit)

    monkeypatch.setattr(quality.Attention, "fitted", classmethod(watched))
    hot = next(i for i in range(0, 99, 2) if not spark.range(1).select(quality.held_out(F.lit(i))).first()[0])
    rows = [(i, ("good words here. " if i % 2 else "%% $$ ## ") * 9) for i in range(100, 120)]
    rows += [(hot, "%% $$ ## " * 5)] * 60 + [(hot, f"%% {i} ## " * 5) for i in range(60)]
    docs = make(rows)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality")).distinct()
    learnt = labels.where(~quality.held_out(F.col("doc_id")))
    found = quality.score_quality(docs, labels, fit=quality.Fit(most_documents=30)).collect()
    assert sizes == [(30, learnt.where("quality = 1").count())]
    assert len(found) == len(rows) and all(r.predicted == r.doc_id % 2 for r in found)


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (5, None), (2, 0)], "doc_id long, quality int")
    found = quality.score_quality(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    one_kind = quality.score_quality(odd, labels.where("quality = 1")).collect()
    assert {r.score for r in one_kind} == {0.5}
    assert quality.score_quality(odd.limit(0), labels).count() == 0
