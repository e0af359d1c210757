"""Fill-in-the-middle against a plain loop, and every text back."""

import hashlib
import random
import re

import pytest

from lakeworks.llm import fill_middle
from lakeworks.llm.fill_middle import Form
from lakeworks.llm.queries import ORACLES, QUERIES
from tests.checking import compare, database


def brute(key, text, rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    None, "", "\n", "\n\n\n", "one", "one\n", "a\nb\nc", "a\n\nb\r\nc\x85d e\n", "$1 \\ $2\n\\$\nx$3", "<P", "<<\nS>", "x<P>y", "<\n<S\n<M",
    "日本語\n😀é\n" * 30, "line\n" * 30_000, "w" * 300_000, "\n" * 50_000 + "end",
]


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (90, 100)])
def test_like_a_plain_loop(spark, make, rate, spm):
    rng = random.Random(rate)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [
        (1000 + i, "".join(rng.choices(["ab", "\n", "é", " ", "<P", ">", "$", "\\"], k=rng.randint(0, 60)))) for i in range(300)
    ]
    how = Form(rate=rate, spm=spm)
    found = fill_middle.fill_in_middle(make(rows), how=how)
    back = fill_middle.restored(found["output"], found["form"], how)
    got = {r.doc_id: r for r in found.select("*", back.alias("back")).collect()}
    for key, text in rows:
        r = got[key]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(key, text, rate, spm)
        assert r.back == (text or "")


def test_other_marks_and_units(spark, make):
    how = Form(unit=r"[^ ]* |[^ ]+", marks=("[$pre]", "[\\suf]", "[mid]"))
    rows = [(i, "some words that\nstand here " * i) for i in range(20)]
    found = fill_middle.fill_in_middle(make(rows), how=how)
    for r in found.withColumn("back", fill_middle.restored(found["output"], found["form"], how)).collect():
        assert r.back == rows[r.doc_id][1]
        assert r.n == 4 * r.doc_id and (r.form == "plain") == (r.doc_id == 0)
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(make(rows), how=Form(marks=("<P>", "<P>>", "<M>")))


def test_odd_rows(spark, odd):
    clash = odd.selectExpr("*", "'x' as n", "'y' as Form", "'z' as output", "'c' as c0", "'t' as t", "'a' as a")
    found = fill_middle.fill_in_middle(clash)
    assert set(odd.columns) <= set(found.columns)
    want = sorted(str((d, *brute(d, t))) for d, t in odd.select("doc_id", "text").collect())
    assert sorted(str(tuple(r)) for r in found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()) == want
    assert fill_middle.fill_in_middle(odd.limit(0)).count() == 0


def test_no_python_and_no_shuffle(spark, sf_dir):
    plan = QUERIES["op12_fill_in_middle"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query_against_sql(spark, sf_dir):
    assert compare(QUERIES["op12_fill_in_middle"](spark, sf_dir), database(sf_dir), ORACLES["op12_fill_in_middle"]) is None
