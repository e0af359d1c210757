"""Packing: every id once, full windows, shares as wanted, against a plain walk through the deal."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeworks.llm import packing
from lakeworks.llm.packing import Track, Windows, deal, pack, pieces
from lakeworks.llm.queries import QUERIES
from lakeworks.llm.token_counts import place
from tests.llm.conftest import COLUMNS, prose

WORDS = place("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(WORDS)
SMALL = Windows(size=32, grain=4, period=8, queues=8)


def lib_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def windows_of(phases):
    """Every window's tokens by queue, one after the other."""
    return [row for p in phases for _ in range(p.times) for row in p.served.tolist()]


def check_sizes(found, size):
    """Windows are full, but for those at the end, which are powers of two."""
    short = [n for n in found if n != size]
    assert found[: len(found) - len(short)] == [size] * (len(found) - len(short))
    assert all(n & (n - 1) == 0 and n < size for n in short) and len(short) < size.bit_length()


totals = st.lists(st.integers(0, 5000), min_size=1, max_size=8)


@settings(max_examples=200, deadline=None)
@given(totals, st.one_of(st.none(), st.lists(st.sampled_from([0.0, 0.01, 0.3, 1.0]), min_size=8, max_size=8)))
def test_deal_serves_everything(totals, weights):
    found = windows_of(deal(totals, weights and weights[: len(totals)], SMALL))
    assert [sum(row[q] for row in found) for q in range(len(totals))] == totals
    check_sizes([sum(row) for row in found], 32)


@settings(max_examples=100, deadline=None)
@given(totals, st.integers(0, 1 << 30))
def test_tracks_follow_the_deal(totals, seed):
    phases, rng = deal(totals, None, SMALL), random.Random(seed)
    want = defaultdict(list)  # queue: (window, offset) of each token
    for window, row in enumerate(windows_of(phases)):
        offset = 0
        for q, n in enumerate(row):
            want[q] += [(window, offset + i) for i in range(n)]
            offset += n
    for q, total in enumerate(totals):
        if not total:
            continue
        cuts = sorted({0, *rng.sample(range(total), min(total, 20))})
        begins, ends = np.array(cuts), np.array([*cuts[1:], total])
        got = []
        for row, start, length, window, offset in zip(*pieces(Track(phases, q), begins, ends - begins), strict=True):
            assert start == len(got) - cuts[row]
            got += [(window, offset + i) for i in range(length)]
        assert got == want[q]


@pytest.mark.parametrize("weights", [None, [0.2, 0.5, 0.05, 0.25]])
def test_windows_keep_to_the_target(weights):
    """Until a queue ends, no queue is ever two grains away from its share of all windows so far, over any of them."""
    how, totals = Windows(), [900_000, 400_000, 70_000, 1_130_000]
    shares = weights or [t / sum(totals) for t in totals]
    found = np.cumsum(np.array(windows_of(deal(totals, weights, how))), 0)
    ended = int(np.argmax((found == np.array(totals)).any(1)))
    assert ended > 300
    want = np.outer(np.arange(1, ended + 1) * how.size, shares)
    # quotas are whole grains a period, so the target itself is off by a grain a period at most
    slack = 2 * how.grain + how.grain * np.arange(1, ended + 1)[:, None] / how.period
    assert (np.abs(found[:ended] - want) <= slack).all()


def check_pieces(rows, docs, size):
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    assert set(by_doc) == set(docs)
    for key, text in docs.items():
        ids, at = lib_ids(text), 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, list(r.ids)) == (at, len(ids), ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    assert sorted(by_window) == list(range(len(by_window)))
    for found in by_window.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
    check_sizes([sum(r.length for r in by_window[w]) for w in sorted(by_window)], size)
    return by_window


def made(spark, n=300, hot=3):
    """Documents of a few sources, a third of them of one."""
    rows = [(i, " ".join(prose(i, 3 + i % 50)), "en", "hot" if i % hot == 0 else f"s{i % 7}" if i % 11 else None, 1) for i in range(n)]
    return spark.createDataFrame(rows, COLUMNS).repartition(9), {r[0]: r[1] for r in rows}


@pytest.mark.parametrize("target", [None, {"hot": 0.5, "s1": 0.3, "absent": 0.1}, {"s1": 1.0}])
@pytest.mark.parametrize("queues", [8, 4])
def test_pack(spark, monkeypatch, target, queues):
    df, docs = made(spark)
    monkeypatch.setattr(packing, "SMALL", 0 if queues == 4 else 1_000_000)  # both joins
    how = Windows(size=64, grain=8, period=8, queues=queues)
    found = pack(df, WORDS, target, how)
    windows = check_pieces(found.collect(), docs, 64)
    whole = {r.sequence_id: r for r in packing.sequences(found, how, padding=9).collect()}
    for w, rows in windows.items():
        ids = [i for r in sorted(rows, key=lambda r: r.offset) for i in r.ids]
        assert whole[w].ids == ids and whole[w].n_tokens == len(ids)  # powers of two are not padded
    if target and "hot" in target:
        first = [r for w in range(20) for r in windows[w]]
        assert abs(sum(r.length for r in first if r.queue == 1) / (20 * 64) - 0.5) < 0.1


def test_sequences_pad(spark):
    rows = spark.createDataFrame([(0, 2, [3, 4]), (0, 0, [1, 2]), (1, 0, [5] * 3), (2, 0, [6])], "sequence_id long, offset long, ids array<int>")
    found = {r.sequence_id: r.ids for r in packing.sequences(rows, Windows(size=8, grain=4, period=32)).collect()}
    assert found == {0: [1, 2, 3, 4], 1: [5] * 3 + [0] * 5, 2: [6]}


def test_odd_rows(spark, odd):
    clash = odd.selectExpr("*", "'x' as queue", "'y' as place0", "'z' as sequence_id", "1 as length", "'o' as `offset`", "'p' as n")
    found = pack(clash, WORDS).collect()
    want = sorted(str((d, i)) for d, t in odd.select("doc_id", "text").collect() for i in lib_ids(t))
    assert sorted(str((r.doc_id, i)) for r in found for i in r.ids) == want
    taken = sorted((r.sequence_id, r.offset, r.length) for r in found)
    assert all(a[0] != b[0] and b[1] == 0 or a[1] + a[2] == b[1] for a, b in zip(taken, taken[1:]))
    assert pack(odd.limit(0), WORDS).count() == 0
    with pytest.raises(ValueError):
        pack(odd, WORDS, {"a": 0.5, "b": 0.5}, Windows(queues=2))


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows, by_doc = QUERIES["op13_packing"](spark, sf_dir).collect(), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for key, text in docs.items():
        ids, at = lib_ids(text), 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    check_sizes([used[w] for w in range(len(used))], 2048)
