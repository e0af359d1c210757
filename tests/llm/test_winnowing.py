"""Winnowing against a plain loop."""

import hashlib
import random
import re

import pytest
import xxhash

from lakeworks.llm import winnowing
from lakeworks.llm.queries import QUERIES


def brute(text, k=4, w=8):
    units = [u for part in re.split(r"\s", text or "") for u in (part[:48], *part[48:])]
    hashes = []
    for i in range(max(1, len(units) - k + 1)):
        h = 42
        for u in units[i : i + k]:
            h = xxhash.xxh64(u.encode(), seed=h).intdigest()
        hashes.append(h >> 22)
    kept = []
    for a in range(max(1, len(hashes) - w + 1)):
        span = hashes[a : a + w]
        place = a + max(i for i, h in enumerate(span) if h == min(span))
        if (hashes[place], place) not in kept:
            kept.append((hashes[place], place))
    return kept


def shown(kept):
    return " ".join(f"{h:x}:{p}" for h, p in kept)


def near(a, b):
    x, y = {h for h, _ in a}, {h for h, _ in b}
    return len(x & y) / len(x | y)


def checked(docs, found):
    order = sorted(docs, key=lambda d: -d[0])
    found = {r.doc_id: r for r in found.collect()}
    assert len(found) == len(docs)
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following, r = text or "", following or "", found[doc]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (shown(brute(text)), shown(brute(edited)))
        assert r.near_edited == pytest.approx(near(brute(text), brute(edited)))
        assert r.near_next == pytest.approx(near(brute(text), brute(following)))


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    checked(docs, QUERIES["op10_winnowing"](spark, sf_dir))


def test_one_rule_for_units_of_any_length(make):
    """Words of 40 to 60 characters differ by one character's unit, not by the rule; long ones match after an insertion."""
    rng = random.Random(11)
    line = "".join(rng.choices("abcdefgh", k=600))
    docs = [(i, " ".join("".join(rng.choices("xyz", k=n)) for n in range(40, 60))) for i in range(5)] + [(9, line), (8, "Q" + line), (7, line[:50])]
    found = winnowing.compare_with_next(make(docs))
    checked(docs, found)
    assert {r.doc_id: r.near_next for r in found.collect()}[9] > 0.8


@pytest.mark.parametrize("count", [1, 2, 3, 30])
def test_few_rows(make, count):
    docs = [(7 * i - 3, "".join(chr(97 + (i * j * j) % 5) + (" " if j % 3 else "😀") for j in range(i * 9))) for i in range(count)]
    checked(docs, winnowing.compare_with_next(make(docs)))


def test_long_texts_in_parts(make, monkeypatch):
    monkeypatch.setattr(winnowing, "PART", 16)
    text = " ".join("abcab"[i * i % 5] for i in range(300))
    checked([(1, text), (2, text[50:])], winnowing.compare_with_next(make([(1, text), (2, text[50:])])))


def test_shared_run_is_found(make):
    run = " ".join(f"w{i}" for i in range(winnowing.K + winnowing.W - 1))
    a, b = "p q r " * 20 + run + " s t" * 9, "u v " * 33 + run
    rows = [r.found for r in make([(1, a), (2, b)]).select(winnowing.fingerprints("text").alias("found")).collect()]
    assert {f.h for f in rows[0]} & {f.h for f in rows[1]}


def test_texts_without_white_space(make):
    """Edited and moved texts share fingerprints, though they are one word or have no spaces."""
    rng = random.Random(4)
    han = lambda n: "".join(chr(rng.randint(0x4E00, 0x9FA0)) for _ in range(n))
    base = lambda n: "".join(rng.choices("ABCDEFGHabcdefgh0123456789+/", k=n))
    docs = [(1, han(30)), (2, han(400)), (3, base(120)), (4, base(3000)), (5, "ไทย" * 20), (6, base(20) + " " + han(40))]
    found = {r.doc_id: r for r in winnowing.compare_with_next(make(docs)).collect()}
    assert all(r.near_edited > 0 for r in found.values())
    moved = make([(i, lead + t) for i, t in docs for lead in ("", "xyz")]).select("doc_id", winnowing.fingerprints("text").alias("f"))
    prints = {}
    for r in moved.collect():
        prints.setdefault(r.doc_id, []).append({f.h for f in r.f})
    assert all(a & b for a, b in prints.values())


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op10_winnowing"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_odd_rows(odd):
    found = winnowing.compare_with_next(odd).collect()
    assert len(found) == odd.count()
    prints = {}
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_empty_table(odd):
    assert winnowing.compare_with_next(odd.limit(0)).count() == 0
