"""The suffix automaton against windows tried one by one."""

import hashlib
import random
import re

import pytest

from lakeworks.llm import decontamination
from lakeworks.llm.queries import QUERIES
from lakeworks.llm.texts import words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    doc, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        size = min(window, len(w))
        for a in range(len(w) - size + 1 if w else 0):
            for b in range(len(doc) - size + 1):
                if doc[b : b + size] == w[a : a + size]:
                    hit |= set(range(b, b + size))
                    found.add("" if item is None else str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(doc), len(hit), len(found), digest, bool(hit)


def test_words():
    text = "Ab1_c É{x}\x7fÀ9 z İ"
    assert [w.decode() for w in words_of(text)] == words(text)


@pytest.mark.parametrize("seed,window,block", [(1, 10, 1 << 20), (2, 4, 1 << 20), (3, 3, 60), (4, 5, 1)])
def test_find(spark, make, seed, window, block):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))  # noqa: E731  few words: many overlaps
    items = [(i, text(rng.randint(0, 14))) for i in range(12)] + [(12, None), (13, "a b"), (14, "Q!"), (None, "c a q c")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)] + [(40, None), (41, "q")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find(make(docs), table, window, block_bytes=block).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found}
    assert got == {i: brute(t, items, window) for i, t in docs}


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    grams = {}
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for a in range(len(w) - size + 1 if w else 0):
            grams.setdefault(tuple(w[a : a + size]), set()).add(str(item))
    found = {r.doc_id: r for r in QUERIES["op5_decontamination"](spark, sf_dir).collect()}
    for d in docs:
        w, hit, ids = words(d.text), set(), set()
        for size in {len(g) for g in grams}:
            for b in range(len(w) - size + 1):
                if tuple(w[b : b + size]) in grams:
                    hit |= set(range(b, b + size))
                    ids |= grams[tuple(w[b : b + size])]
        r = found[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(ids), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def test_remove(spark, make):
    item = "one two three four five six seven eight nine ten eleven"
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    lead = "alpha beta gamma delta " * 10
    split = "one two three four five " + item + " six seven eight nine ten end"
    docs = [(1, lead + item + "! tail"), (2, item), (3, lead), (4, lead * 2 + split), (5, None), (6, "")]
    left = {r.doc_id: r.text for r in decontamination.remove(make(docs), table).collect()}
    assert sorted(left) == [1, 3, 4, 5, 6] and left[3] == lead and left[5] is None
    assert left[1] == lead + "! tail"
    assert left[4].split()[-1] == "end" and not brute(left[4], [(1, item)], 10)[-1]  # the cut brought a new run together


@pytest.mark.parametrize("block", [1, 60])
def test_remove_in_blocks(spark, make, block):
    """Several blocks of items leave what one block leaves."""
    rng = random.Random(7)
    few = lambda n: " ".join(rng.choice("abcd") for _ in range(n))  # noqa: E731  few words: many overlaps
    one, two = " ".join(f"p{i}" for i in range(12)), " ".join(f"q{i}" for i in range(12))
    items = [(1, one), (2, two), *((i, few(6)) for i in range(3, 9))]
    own = lambda n: " ".join(f"w{i}" for i in range(n))
    half = "p0 p1 p2 p3 p4 "
    docs = [(1, f"{one} {own(6)} {two}"), (2, own(40) + f" {half}{two} p5 p6 p7 p8 p9 p10 end"), (3, None), (4, "")]
    docs += [(i, own(60) + " " + few(rng.randint(0, 40))) for i in range(5, 25)]
    table = spark.createDataFrame(items, "item_id long, text string")
    whole, parts = (
        {r.doc_id: r.text for r in decontamination.remove(make(docs), table, window=5, block_bytes=b).collect()} for b in (1 << 20, block)
    )
    assert parts == whole and 1 not in whole and whole[2] == own(40) + "  end"


def test_odd_rows(spark, odd):
    table = spark.createDataFrame([(1, "other words here"), (None, None), (2, "")], "item_id long, text string")
    found = decontamination.find(odd, table).collect()
    assert len(found) == odd.count() and [r.doc_id for r in found if r.contaminated] == [2]
    assert decontamination.remove(odd, table).count() == odd.count() - 1
    assert decontamination.find(odd, table.limit(0)).where("contaminated").count() == 0


def test_empty_table(spark, odd):
    table = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontamination.find(odd.limit(0), table).count() == 0
    assert decontamination.remove(odd.limit(0), table).count() == 0
