"""SentencePiece encoding and decoding as a weighted transducer.

The model file is compiled to three machines: the normaliser (the blank before the text and blanks as
U+2581), the pieces, and the byte fallback for characters without a piece. They are composed with a text,
and the ids are the labels on the shortest path in the tropical semiring. The file's scores are merge
priorities, not costs that add up: adding them gives other pieces than the model's own. So a path's
weight sums one weight for each pair of neighbouring pieces: 0 where the merges keep both pieces as they
are, infinity where a merge would have crossed their border. Exactly one path is finite, and it is the
model's encoding; `paths.Paths` relaxes it prefix by prefix, with one finite state at each, for all words of a batch that were
not met before. No piece reaches over a blank's front, a line break or from a letter to a stop, so words end there.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lakeworks.llm.known import Known
from lakeworks.llm.merges import Merges
from lakeworks.llm.paths import Paths
from lakeworks.llm.texts import clean, in_slices, list_column
from lakeworks.llm.token_files import list_crc32

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _model(path: str):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return model


class Decoder:
    """The surface of every piece."""

    def __init__(self, path: str):
        model = _model(path)
        self.surface = pa.array([
            p.piece.replace(BLANK, " ").encode() if p.type == NORMAL
            else bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE
            else b"" if p.type == CONTROL else model.trainer_spec.unk_surface.encode()
            for p in model.pieces
        ], pa.binary())
        self.blank_first = np.array([p.type == NORMAL and p.piece.startswith(BLANK) for p in model.pieces])

    def rows(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each row of ids, the rows ending at `ends`; the blank that encoding puts first is taken off."""
        found = self.surface.take(pa.array(ids))
        data, places = memoryview(found.buffers()[2] or b""), np.frombuffer(found.buffers()[1], np.int32)
        starts = np.concatenate(([0], ends[:-1]))
        first = np.zeros(len(ends), np.int64)
        first[ends > starts] = self.blank_first[ids[starts[ends > starts]]]
        return [bytes(data[a:b]) for a, b in zip((places[starts] + first).tolist(), places[ends].tolist(), strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids."""
        return self.rows(ids, np.array([len(ids)]))[0].decode("utf-8", "replace")


class Transducer:
    """A model file with an identity character map, blank prefix and byte fallback."""

    def __init__(self, path: str):
        model = _model(path)
        norm, trainer = model.normalizer_spec, model.trainer_spec
        if (
            trainer.model_type != trainer.BPE or not trainer.byte_fallback or norm.precompiled_charsmap
            or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or trainer.treat_whitespace_as_suffix
        ):
            raise ValueError(f"{path} is not a BPE model with byte fallback and an identity normaliser")
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        blanks = {p for p in score if not p.strip(BLANK)}
        if any(BLANK in p.lstrip(BLANK) or p.startswith(BLANK * 2) and p not in blanks for p in score):
            raise ValueError(f"{path} has pieces across words")
        # runs of blanks merge last and with equal scores, so they have a machine of their own
        self.blank_runs = Merges(blanks, lambda a, b: -score[a + b] if a + b in blanks else None)
        ranks = {p: -s for p, s in score.items() if p not in blanks}
        self.paths = Paths(ranks, Merges(ranks, lambda a, b: ranks.get(a + b)))
        self.words = self.paths.automaton
        if any("\n" in p for p in score):
            raise ValueError(f"{path} has pieces with line breaks")
        #: signs that no piece has after a letter: a border there always holds
        self.stops = "".join(c for c in ".,!?;:" if not any(a.isalpha() and b == c for p in score for a, b in zip(p, p[1:])))
        self.letter_and_stop = rf"(\p{{L}})([{re.escape(self.stops)}])" if self.stops else None
        # a token without a piece is spelt in bytes
        self.id_at = np.array([self.id_of.get(t, -1) for t in self.paths.tokens], np.int32)
        self.known = Known(self._teach, np.uint16 if len(model.pieces) <= 1 << 16 else np.int32, 150_000)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids."""
        token, counts, codes = self.paths.split(words)
        ids = self.id_at[token]
        spelt = np.flatnonzero(ids < 0)
        if not len(spelt):
            return counts, ids
        spelling = [[self.byte_id[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in codes[spelt].tolist()]
        size = np.ones(len(ids), np.int64)
        size[spelt] = list(map(len, spelling))
        through = np.cumsum(size)
        out = np.repeat(ids, size)
        out[out < 0] = [i for found in spelling for i in found]
        return np.diff(np.concatenate(([0], through))[np.concatenate(([0], np.cumsum(counts)))]), out

    def _teach(self, words: list[str]) -> None:
        several = [w for w in words if w.startswith(BLANK * 2)]
        plain = [w for w in words if not w.startswith(BLANK * 2)]
        bodies = {BLANK + w.lstrip(BLANK) for w in several}
        plain += [b for b in bodies.difference(plain) if b not in self.known.slots]
        if plain:
            self.known.keep(plain, *self._ids(plain))
        blank = self.id_of[BLANK]
        for word in several:
            body = word.lstrip(BLANK)
            own = self.known.of(BLANK + body).tolist()
            alone = own[0] == blank  # the last blank is a piece of its own, so it merges with those before
            run = self.blank_runs.merged([BLANK] * (len(word) - len(body) - 1 + alone))
            ids = [*(self.id_of[part[0]] for part in run), *own[alone:]]
            self.known.keep([word], [len(ids)], ids)

    def forget(self) -> None:
        """Give the memory of words and borders back, for the worker's next task may be another's."""
        self.known.forget()
        self.paths.forget()
        pa.default_memory_pool().release_unused()

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), and how many each has."""
        texts = pc.fill_null(texts, "")
        units = pc.replace_substring(pc.replace_substring(texts, BLANK, " "), " ", " " + BLANK)
        units = pc.binary_join_element_wise(BLANK, units, "")
        units = pc.replace_substring(units, BLANK + " ", BLANK)  # blanks one after the other stay together
        units = pc.replace_substring(units, "\n", " \n ")
        if self.letter_and_stop:
            units = pc.replace_substring_regex(units, self.letter_and_stop, r"\1 \2")
        units = pc.if_else(pc.equal(texts, ""), "", units)
        return self.known.rows(pc.split_pattern(units, " "))

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids."""
        return self.batch(pa.array([text], pa.string()))[0].astype("<i4").tobytes()


@lru_cache(maxsize=2)
def compiled(path: str) -> Transducer:
    return Transducer(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _encoded(batches, model: str, keep: list[str], text: str):
    coder = compiled(model)
    try:
        for batch in in_slices(batches, 2 << 20):
            values, sizes = coder.batch(batch.column(batch.schema.get_field_index(text)))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, list_column(values, sizes)], [*keep, "ids"])
    finally:
        coder.forget()


def encode(df: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text, ids) for every row; `model` is the file's path on every worker.

    A null or empty text has no ids. Null keys and repeated rows are kept, extra columns are left behind,
    an empty table gives an empty result.
    """
    rows = clean(df, doc_id=key, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _encoded(batches, model, ["doc_id", "text"], "text"), f"doc_id {kind}, text string, ids array<int>"
    )


def _checked(batches, model: str, with_ids: bool):
    coder = decoder(model)
    for batch in in_slices(batches, 2 << 20):
        ids = batch.column(2)
        ends = ids.offsets.to_numpy()[1:] - ids.offsets[0].as_py()
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()]
        rows = coder.rows(ids.flatten().to_numpy(), ends)
        same = [a == b for a, b in zip(rows, texts, strict=True)]
        shown = [r if s else r.decode("utf-8", "replace").encode() for r, s in zip(rows, same, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.diff(ends, prepend=0), pa.int64()),
                pa.array(list_crc32(ids), pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in shown]),
                pa.array(same),
                *([ids] if with_ids else []),
            ],
            ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "round_trip", *(["ids"] if with_ids else [])],
        )


def _digest_schema(kind: str, with_ids: bool) -> str:
    return f"doc_id {kind}, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean" + ", ids array<int>" * with_ids


def digests(encoded: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """Per row of `encode`'s result: doc_id, n_pieces, ids_crc32, the sha256 of the text decoded from the
    ids, and whether that text is the one encoded (null counts as empty); with the ids too if wanted."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "text", "ids").mapInArrow(
        lambda batches: _checked(batches, model, with_ids), _digest_schema(kind, with_ids)
    )


def encoded_digests(df: DataFrame, model: str, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """`digests` of `encode`'s result, both in one pass over the rows: as two steps they would take two Python
    workers for each task, and texts and ids would pass through the JVM between them."""
    rows = clean(df, doc_id=key, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _checked(_encoded(batches, model, ["doc_id", "text"], "text"), model, with_ids),
        _digest_schema(kind, with_ids),
    )
