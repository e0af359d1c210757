"""Token counts, token files and SentencePiece coding against their libraries."""

import random
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeworks.llm import sentencepiece_fst, token_counts, token_files
from lakeworks.llm.queries import QUERIES
from lakeworks.llm.token_counts import place

WORDS, PIECES = place("word_bpe_49k.json"), place("piece_bpe_32k.model")
LIBRARY, MODEL = Tokenizer.from_file(WORDS), sentencepiece.SentencePieceProcessor(model_file=PIECES)
BITS = [
    *"abcdeéèüßñ \n\t'stvermld0123.,!?<|>ABCİΣ中日 ​\x1c\x85 ̈😀▁", "<|endoftext|>", "  ", "    ", "'re", "don't", "aaaa",
    "the", "ing", "▁▁", " " * 7, " " * 23, "<0x41>", "<s>", "ﬁ", "ा", "\x00", "﻿",
]
texts = st.lists(st.sampled_from(BITS) | st.text(max_size=3), max_size=40).map("".join)


def lib_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def storable(text):
    return not any(0xD800 <= ord(c) <= 0xDFFF for c in text)


@settings(max_examples=400, deadline=None)
@given(texts.filter(storable))
def test_counts_like_the_library(text):
    assert token_counts.compiled(WORDS).count(text) == len(lib_ids(text))


@settings(max_examples=400, deadline=None)
@given(texts.filter(storable))
def test_files_hold_the_librarys_ids(text):
    assert token_files.Encoder(WORDS)([text], 2) == [np.asarray([*lib_ids(text), 2], "<u4").tobytes()]


@settings(max_examples=400, deadline=None)
@given(texts.filter(storable))
def test_pieces_like_the_library(text):
    coder = sentencepiece_fst.compiled(PIECES)
    ids = np.frombuffer(coder.encode(text), "<i4")
    assert ids.tolist() == MODEL.encode(text)
    back = sentencepiece_fst.decoder(PIECES).decode(ids)
    assert back == MODEL.decode(ids.tolist())
    if "▁" not in text:
        assert back == text


def test_random_words_through_a_small_automaton():
    rng = random.Random(3)
    coder = sentencepiece_fst.Transducer(PIECES)
    coder.words.most_states = 50  # thrown away again and again
    for _ in range(300):
        text = " ".join("".join(rng.choices("theandig", k=rng.randint(1, 15))) for _ in range(6))
        assert np.frombuffer(coder.encode(text), "<i4").tolist() == MODEL.encode(text)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_chunks_compose(monkeypatch, size):
    monkeypatch.setattr(token_counts, "CHUNK", size)
    text = "".join(random.Random(size).choices(BITS, k=200))
    assert token_counts.compiled(WORDS).count(text) == len(lib_ids(text))


def test_composition_is_associative():
    counter = token_counts.compiled(WORDS)
    a, b, c = (counter.chunk(t) for t in ("don't st", "op", "ping now\nor ne"))
    left, right = counter.compose(counter.compose(a, b), c), counter.compose(a, counter.compose(b, c))
    assert left == right == counter.chunk("don't stopping now\nor ne")


def test_count_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op7_token_counts"](spark, sf_dir).collect():
        n = len(lib_ids(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 2048)


def test_file_query(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    found, before = {r.doc_id: r for r in QUERIES["op6_token_files"](spark, sf_dir).collect()}, 0
    assert len(found) == len(docs)
    for doc, text in docs:
        ids = [*lib_ids(text), 2]
        assert (found[doc].start, found[doc].n_tokens, found[doc].ids_crc32) == (before, len(ids), crc(ids))
        before += len(ids)


def test_sentencepiece_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op8_sentencepiece"](spark, sf_dir).collect():
        ids = MODEL.encode(docs[r.doc_id])
        assert (r.n_pieces, r.ids_crc32, r.round_trip) == (len(ids), crc(ids), True)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_store_reads_only_what_is_asked(spark, make, path, encoding):
    where = path("tokens")
    token_files.write_token_store(
        make([(i, f"word{i} " * 50) for i in range(500)]), where, WORDS, encoding=encoding, row_group_bytes=1 << 14, rows_per_page=10
    )
    small = token_files.read_tokens(spark, where, ())
    plan = small._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0].replace("ids_before", "")
    some = token_files.read_tokens(spark, where).where("doc_id between 100 and 103").collect()
    assert {r.doc_id: r.ids for r in some} == {i: [*lib_ids(f"word{i} " * 50), 2] for i in range(100, 104)}


def test_odd_rows(spark, odd, path):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    want = sorted((str(d), len(lib_ids(t or ""))) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens) for r in token_counts.count_tokens(odd, WORDS).collect()) == want
    where = path("odd")
    token_files.write_token_store(odd, where, WORDS)
    read = token_files.read_tokens(spark, where).collect()
    assert sorted((str(r.doc_id), r.n_tokens - 1) for r in read) == want
    in_order = sorted(read, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(in_order, in_order[1:]))
    pieces = sentencepiece_fst.digests(sentencepiece_fst.encode(odd, PIECES), PIECES).collect()
    assert sorted((str(r.doc_id), r.n_pieces) for r in pieces) == sorted((str(d), len(MODEL.encode(t or ""))) for d, t in rows)


def test_empty_tables(spark, odd, path):
    none = odd.limit(0)
    assert token_counts.count_tokens(none, WORDS).count() == 0
    token_files.write_token_store(none, where := path("none"), WORDS)
    assert token_files.read_tokens(spark, where).count() == 0
    assert sentencepiece_fst.digests(sentencepiece_fst.encode(none, PIECES), PIECES).count() == 0
