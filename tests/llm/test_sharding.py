"""Contiguous shards of least greatest size against plain search."""

import random
import zlib

import pytest

from lakeworks.llm import sharding
from lakeworks.llm.queries import QUERIES


def least_capacity(sizes, shards):
    """Brute force: the smallest greatest part over all ways to cut, by dynamic programming."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        new = list(best)
        for end in range(1, len(sizes) + 1):
            total = 0
            for start in range(end - 1, -1, -1):
                total += sizes[start]
                new[end] = min(new[end], max(best[start], total))
        best = new
    return best[-1]


def checked(found, shards):
    rows = [r.asDict() for r in found.collect()]
    group = {}
    for r in rows:
        assert group.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    return rows


@pytest.mark.parametrize("seed,shards,points", [(1, 4, 1 << 16), (2, 7, 64), (5, 40, 8)])
def test_least_capacity(make, monkeypatch, seed, shards, points):
    monkeypatch.setattr(sharding, "POINTS", points)  # few blocks: many rounds of refinement
    rng = random.Random(seed)
    texts = ["z" * rng.choice([1, 5, 30, 400]) + str(rng.randint(0, 60)) for _ in range(150)]
    texts += [texts[0]] * 30
    rows = checked(sharding.shard_by_bytes(make(list(enumerate(texts))), shards), shards)
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    import hashlib

    groups = {}
    for t in texts:
        groups[hashlib.sha256(t.encode()).digest()] = groups.get(hashlib.sha256(t.encode()).digest(), 0) + len(t) + 16
    loads = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(shards)]
    assert max(loads) == least_capacity([groups[g] for g in sorted(groups)], shards)


def test_even_where_one_group_is_large(make):
    texts = ["same " * 2000] * 10 + [f"text {i} " * 20 for i in range(400)]
    rows = checked(sharding.shard_by_bytes(make(list(enumerate(texts))), 8), 8)
    loads = sorted(sum(r["size"] for r in rows if r["shard"] == s) for s in range(8))
    assert loads[0] > 0.8 * sum(loads[:7]) / 7  # the others share the rest evenly


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = checked(QUERIES["op2_sharding"](spark, sf_dir), 40)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in docs.items()
    }


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op2_sharding"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_odd_rows(odd):
    rows = checked(sharding.shard_by_bytes(odd, 5), 5)
    assert len(rows) == odd.count()
    assert {r["size"] for r in rows if r["doc_id"] == 3} == {16}


def test_empty_table(odd):
    assert sharding.shard_by_bytes(odd.limit(0), 5).count() == 0
