"""The similarity join against all pairs compared, and components against union-find."""

import random
import re

import pytest
from .conftest import prose

from lakeworks.llm import graph, jaccard
from lakeworks.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if 0 < len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows, threshold=0.8):
    """Class and number of links by comparing everything with everything."""
    sets = {}
    for doc, text in rows:
        sets.setdefault(shingles(text) or repr(text), []).append(doc)
    kinds, parent = list(sets), {}
    links = dict.fromkeys(kinds, 0)

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if isinstance(a, frozenset) and isinstance(b, frozenset) and len(a & b) >= threshold * len(a | b):
                links[a] += 1
                links[b] += 1
                if root(a) != root(b):
                    parent[root(a)] = root(b)
    least = {}
    for k in kinds:
        least[root(k)] = min([*sets[k], least.get(root(k), 1 << 60)])
    return {doc: (least[root(k)], links[k]) for k in kinds for doc in sets[k]}


def near_copies(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


@pytest.fixture(scope="module")
def planted():
    rng, rows = random.Random(4), []
    for group in range(12):
        base = " ".join(prose(group, rng.randint(30, 400)))
        rows += [base] * rng.randint(1, 3)
        rows += [near_copies(rng, base, rng.choice([1, 2, 3, 5, 9, 30])) for _ in range(rng.randint(0, 9))]
    chain = prose(99, 300)
    for step in range(0, 100, 6):  # each links to the next, the ends do not
        rows.append(" ".join([f"new{i}" for i in range(step)] + chain[step:]))
    rows += [" ".join(prose(1000 + i, 80)) for i in range(40)]
    rows += ["", "", ", .", "one", "One!", "one two", "one two three four", "one two three four five"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [128, 4])
def test_like_brute_force(make, planted, block):
    found = jaccard.classes(make(planted), forest=jaccard.Forest(block_rows=block)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in found} == brute(planted)


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op4_jaccard_join"](spark, sf_dir).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in found} == brute(docs)


def test_one_of_each(make, planted):
    want = sorted({c for c, _ in brute(planted).values()})
    assert sorted(r.doc_id for r in jaccard.one_of_each(make(planted)).collect()) == want


def test_prefix_reaches_the_recall():
    for forest in (jaccard.Forest(), jaccard.Forest(trees=4, recall=0.9), jaccard.Forest(trees=32, threshold=0.5)):
        reached = [1 - (1 - forest.threshold**d) ** forest.trees for d in (forest.prefix(), forest.prefix() + 1)]
        assert reached[0] >= forest.recall and (forest.prefix() == forest.depth or reached[1] < forest.recall)
    with pytest.raises(ValueError):
        jaccard.Forest(trees=1).prefix()


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(5000, 5000 + i) for i in range(1, 60)] + [(7, 7)]
    group = {}
    for a, b in links:
        x, y = group.setdefault(a, {a}), group.setdefault(b, {b})
        if x is not y:
            x |= y
            for n in y:
                group[n] = x
    want = {n: min(g) for n, g in group.items() if n != min(g)}
    rows = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == want


def test_odd_rows(odd):
    found = jaccard.classes(odd).collect()
    assert len(found) == odd.count()
    copies = {r.class_id for r in found if r.doc_id in (1, -3)}
    assert copies == {-3}
    assert {r.n_links for r in found if r.doc_id in (3, 4, 7)} == {0}
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len({(r.class_id, r.class_uid) for r in found})


def test_empty_table(odd):
    assert jaccard.classes(odd.limit(0)).count() == 0 and jaccard.one_of_each(odd.limit(0)).count() == 0
