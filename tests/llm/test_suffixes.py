"""Repeated passages against a plain search for long common runs."""

import random

import numpy as np
import pytest
from .conftest import prose

from lakeworks.llm import shingles, suffixes
from lakeworks.llm.queries import QUERIES
from lakeworks.llm.texts import words_of


def brute(rows, least=50):
    """Words of each document in runs of `least` that a document of lesser key holds."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        words = words_of(text)
        grams = [tuple(words[i : i + least]) for i in range(len(words) - least + 1)]
        hit = set()
        for i, gram in enumerate(grams):
            if gram in seen:
                hit |= set(range(i, i + least))
        seen |= set(grams)
        out[doc] = hit
    return out


def spans(found):
    return {r.doc_id: {w for s in r.cut_spans for w in range(s["first"], s["end"])} for r in found}


@pytest.fixture(scope="module")
def planted():
    rng, rows = random.Random(2), []
    passages = [" ".join(prose(500 + i, n)) for i, n in enumerate((49, 50, 51, 55, 60, 90, 300, 1200))]
    for i in range(120):
        own = [" ".join(prose(i * 10 + j, rng.randint(0, 90))) for j in range(4)]
        for passage in rng.sample(passages, rng.randint(0, 2)):
            own.insert(rng.randint(0, 4), passage.upper() if rng.random() < 0.3 else passage)
        rows.append(". ".join(own))
    rows += [rows[3], " ".join(prose(77, 400)), " ".join(prose(77, 400)), "short text", "short text", ""]
    return list(enumerate(rows))


def test_like_brute_force(make, planted):
    found = suffixes.repeats(make(planted)).collect()
    assert spans(found) == brute(planted)
    texts = dict(planted)
    for r in found:
        assert r.n_cut == sum(s["end"] - s["first"] for s in r.cut_spans)
        assert words_of(r.text) == [w for i, w in enumerate(words_of(texts[r.doc_id])) if i not in spans([r])[r.doc_id]]
        assert r.n_words == len(words_of(texts[r.doc_id]))


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = [None, "", "  ", "a", " lead and tail ", "w" * 5000 + " x", "é" * 3000, *(" ".join(prose(i, i)) for i in range(60))]
    whole, starts = shingles.word_hashes(texts)
    assert np.diff(starts).tolist() == shingles.word_counts(texts).tolist() == [len(words_of(t)) for t in texts]
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(shingles, "PIECE", size)
        some, places = shingles.word_hashes(texts)
        assert (some == whole).all() and (places == starts).all()
        assert shingles.word_counts(texts).tolist() == np.diff(starts).tolist()


def test_hot_groups_across_partitions(spark, make):
    """One passage in most rows: its suffixes fill many partitions, and one document keeps it."""
    passage = " ".join(prose(1, 80))
    rows = [(i, " ".join(prose(100 + i, 20)) + " " + passage) for i in range(300)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = suffixes.repeats(make(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spans(found) == brute(rows)
    assert all(r.n_cut >= 80 * (r.doc_id > 0) for r in found)


def held_in_part(trials):
    """Documents in threes: one that holds part of a passage, and two that hold all of it."""
    rows = []
    for i in range(trials):
        passage = prose(9000 + i, 60)
        part = [*passage[13:36], "changed", *passage[37:]] if i % 2 else passage[13:]
        for j, middle in enumerate((part, passage, passage)):
            rows.append(" ".join([*prose(10_000 + 10 * i + j, 30), *middle, *prose(20_000 + 10 * i + j, 30)]))
    return list(enumerate(rows))


def test_first_holder_of_a_part(make):
    """Every passage is cut, though its suffixes stand first in a document that holds less than a repeat."""
    rows = held_in_part(60)
    assert sum(map(len, brute(rows).values())) >= 60 * 60
    assert spans(suffixes.repeats(make(rows)).collect()) == brute(rows)


def test_first_holder_of_a_part_across_partitions(spark, make):
    """The same in many partitions, a hot part and one document that holds the part twice before the whole."""
    passage = prose(1, 60)
    rows = [" ".join([*prose(50, 20), *passage[13:], *prose(51, 20), *passage[13:], *prose(52, 9), *passage])]
    rows += [" ".join([*prose(100 + i, 20), *(passage[13:] if i % 3 else passage), *prose(900 + i, 20)]) for i in range(200)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = suffixes.repeats(make(list(enumerate(rows)))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spans(found) == brute(list(enumerate(rows)))


def test_no_missed_word(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op1_suffix_dedup"](spark, "/root/testdata/sf0.1").select("doc_id", "cut_spans").collect()
    assert spans(found) == brute([tuple(r) for r in rows])


def test_query_cuts_all_long_repeats(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found, want = spans(QUERIES["op1_suffix_dedup"](spark, sf_dir).collect()), brute(docs)
    missed = sum(len(want[d] - found[d]) for d in want)
    assert missed <= 0.01 * sum(map(len, want.values()))
    for doc, text in docs:
        if not want[doc]:
            assert len(found[doc]) <= 0.05 * len(words_of(text)) + 60


def test_minimisers_like_a_loop():
    rng = np.random.default_rng(3)
    for size, window in ((0, 4), (3, 4), (4, 4), (200, 4), (200, 24), (300, 7)):
        grams = rng.integers(1, 40, size, np.uint64)
        want = sorted({i + j for i in range(size - window + 1) for j in range(window) if grams[i + j] == grams[i : i + window].min()})
        assert suffixes.minimisers(grams, window).tolist() == want


def test_word_hashes():
    texts = ["", None, "a b a", "x" * 9000 + " " + "x" * 9000 + " " + "x" * 8999, "É é É", "..", "a"]
    hashes, starts = shingles.word_hashes(texts)
    rows = [hashes[a:b].tolist() for a, b in zip(starts, starts[1:])]
    assert [len(r) for r in rows] == [0, 0, 3, 3, 3, 0, 1]
    assert rows[2][0] == rows[2][2] == rows[6][0] != rows[2][1]
    assert rows[3][0] == rows[3][1] != rows[3][2] and rows[4][0] == rows[4][2] != rows[4][1]
    for lead in ("", " ", "..", "é"):  # a word's hash does not depend on what stands before it
        assert shingles.word_hashes([lead + " word"])[0][-1] == shingles.word_hashes(["word"])[0][0]


def test_odd_rows(odd):
    found = suffixes.repeats(odd)
    assert [c for c in found.columns if c not in ("n_words", "n_cut", "cut_spans")] == [c for c in odd.columns if c != "n_words" and c != "n_cut"]
    rows = found.collect()
    assert len(rows) == odd.count() and all(r["a.b"] == "x" for r in rows)
    cut = {(r.doc_id, r.n_cut > 0) for r in rows}
    assert {(None, False), (1, True), (2, True), (6, True), (5, False), (-3, True), (8, False)} <= cut
    assert all(r.text is None for r in rows if r.doc_id == 3)


def test_empty_table(odd):
    assert suffixes.repeats(odd.limit(0)).count() == 0
