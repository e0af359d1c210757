"""Importance resampling against zlib and a plain loop, and its query against SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeworks.llm import position_crc, resampling
from lakeworks.llm.queries import ORACLES, QUERIES
from lakeworks.llm.resampling import Draw
from tests.checking import compare, database
from tests.llm.conftest import prose


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text, buckets=10_000):
    w = words(text)
    return [zlib.crc32(f.encode()) % buckets for f in [*w, *map(" ".join, zip(w, w[1:]))]]


def brute(docs, target, how=Draw()):
    """(key, features, weight, score, rank) of rows with different keys."""
    own, s, t = [features(x, how.buckets) for _, x in docs], Counter(), Counter()
    for f in own:
        s.update(f)
    for x in target:
        t.update(features(x, how.buckets))
    all_s, all_t, b = sum(s.values()), sum(t.values()), how.buckets
    gain = [math.floor(1000 * math.log((t[i] + 1) * (all_s + b) / ((s[i] + 1) * (all_t + b)))) for i in range(b)]
    rows = []
    for (key, text), f in zip(docs, own, strict=True):
        weight = sum(gain[i] for i in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{how.seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append((key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    able = sorted((-r[3], r[0] is not None, r[0]) for r in rows if r[4] >= how.least_words)
    ranks = {k: i + 1 for i, (_, _, k) in enumerate(able[: how.percent * len(able) // 100])}
    return [(*r[:4], ranks.get(r[0])) for r in rows]


def got(df):
    return sorted(map(str, (tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())))


@pytest.mark.parametrize("size", [0, 1, 3, 511, 512, 513, 1024, 1025, 5000, 65536 + 512, 200_001])
def test_crc_of_one_span(size):
    data = random.Random(size).randbytes(size)
    assert position_crc.span_crc(np.frombuffer(data, np.uint8)) == zlib.crc32(data)


@pytest.mark.parametrize("group", [8, 300, 1 << 18])
def test_crcs_of_words_and_pairs(group):
    rng = random.Random(group)
    found = [bytes(rng.choices(range(33, 256), k=rng.choice([1, 2, 5, 9, 250, 255, 256, 257, 300, 511, 512, 513, 2000]))) for _ in range(400)]
    codes = np.frombuffer(b" ".join([*found, b""]), np.uint8)
    last = np.array([rng.random() < 0.1 for _ in found[:-1]] + [True])
    single, pair = position_crc.word_and_pair_crcs(codes, np.cumsum([len(w) + 1 for w in found]) - 1, last, group)
    assert single.tolist() == [zlib.crc32(w) for w in found]
    assert pair.tolist() == [0 if e else zlib.crc32(a + b" " + b) for a, b, e in zip(found, [*found[1:], b""], last.tolist())]


@pytest.mark.parametrize("piece", [20, 64, 1 << 20])
def test_features_of_pieces(monkeypatch, piece):
    monkeypatch.setattr(resampling, "PIECE", piece)
    rng = random.Random(piece)
    texts = [None, "", " ", "a", "...", "A\nb", "\nlast", "w" * 3000 + " x " + "é" * 700] + [
        "".join(rng.choices(["ab", "Q", "é", " ", "\n", ", ", "日本", "    ", "7"], k=rng.randint(0, 120))) for _ in range(200)
    ]
    n_words, sizes, found = resampling.feature_buckets(texts, 10_000)
    ends = np.cumsum(sizes)
    for i, text in enumerate(texts):
        assert n_words[i] == len(words(text))
        assert sorted(found[ends[i] - sizes[i] : ends[i]].tolist()) == sorted(features(text))


def test_like_a_plain_loop(spark, make):
    rows = [(i, " ".join(prose(i % 40, 5 + i % 60))) for i in range(300)] + [(None, None), (400, ""), (401, " ".join(prose(3, 40)))]
    target = [" ".join(prose(i, 30)) for i in range(8)] + [None, ""]
    for how in (Draw(), Draw(buckets=100_000, percent=60, least_words=30, seed=8)):
        found = resampling.ranked(make(rows), make(list(enumerate(target))), how)
        assert got(found) == sorted(map(str, brute(rows, target, how)))


def test_target_like_rows_come_first(spark, make):
    """Rows of the target's own words are drawn far more often than others."""
    rows = [(i, " ".join(random.Random(i).choices(prose(1 if i % 10 == 0 else 2, 200), k=60))) for i in range(1000)]
    target = make([(i, " ".join(random.Random(-i).choices(prose(1, 200), k=200))) for i in range(50)])
    ids = [r.doc_id for r in resampling.drawn(make(rows), target, Draw(percent=10)).collect()]
    assert len(ids) == 100 and sum(i % 10 == 0 for i in ids) > 60


def test_hot_key_and_partitions(spark, make):
    """A third of the rows are one row: each has a rank of its own, whatever the partitions."""
    rows = [(7, " ".join(prose(1, 30)))] * 100 + [(100 + i, " ".join(prose(i, 30))) for i in range(200)]
    found = resampling.ranked(make(rows).repartition(17), make([(0, " ".join(prose(1, 30)))]), Draw(percent=50)).collect()
    ranks = sorted(r.rank for r in found if r.rank)
    assert len(found) == 300 and ranks == list(range(1, 151))
    in_order = sorted((r for r in found if r.rank), key=lambda r: r.rank)
    assert [(-r.score, r.doc_id) for r in in_order] == sorted((-r.score, r.doc_id) for r in in_order)


def test_odd_rows(spark, odd, make):
    clash = odd.selectExpr("*", "'x' as uid0", "'y' as Weight", "'z' as score", "'r' as rank", "'b' as buckets")
    found = resampling.ranked(clash, odd).collect()
    want = Counter((str(d), max(0, 2 * len(words(t)) - 1)) for d, t in odd.select("doc_id", "text").collect())
    assert Counter((str(r.doc_id), r.n_features) for r in found) == want
    kept = resampling.drawn(clash, odd, Draw(percent=100))
    able = [t for _, t in odd.select("doc_id", "text").collect() if len(words(t)) >= 20]
    assert sorted(r.text for r in kept.collect()) == sorted(able)
    assert {"uid0", "Items", "a.b"} <= set(kept.columns)
    assert resampling.ranked(odd.limit(0), odd).count() == 0
    assert resampling.ranked(odd, odd.limit(0)).count() == odd.count()


def test_query_against_sql(spark, sf_dir):
    assert compare(QUERIES["op11_importance_resampling"](spark, sf_dir), database(sf_dir), ORACLES["op11_importance_resampling"]) is None
