"""Token counts by a compiled tokenizer, without making the tokens.

The merges of a word-level BPE file are compiled to a deterministic transducer whose transitions carry
the number of tokens they add. White space resets it, so a chunk of text cut anywhere is a map of states:
what comes before its first white space depends on the state it is entered with, the middle is a number,
and what follows its last white space sets the state it is left in. Such maps compose associatively;
a prefix scan over a text's chunks gives the count of the whole. Texts of one chunk are counted a batch at a time: each
part between blanks once, all parts not met before together (`paths`).
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from lakeworks.llm.known import Known
from lakeworks.llm.merges import END, Merges
from lakeworks.llm.paths import Paths
from lakeworks.llm.texts import Memo, clean, in_slices
from lakeworks.llm.token_files import cut_rows

CHUNK = 1 << 16


class Shapes(dict):
    """ASCII as it is, and for each other character one of its kind: a letter, a digit, a blank or a sign.

    The file's pattern tells no more of them apart; kinds come from Python's own Unicode tables.
    """

    def __missing__(self, code: int) -> str:
        kind = unicodedata.category(chr(code))
        shape = chr(code) if code < 128 else "z" if kind[0] == "L" else "0" if kind[0] == "N" else "!"
        if kind[0] == "Z" or code == 0x85:
            shape = " "
        self[code] = shape
        return shape


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level files: the byte's own where it is
    a visible Latin-1 character, else the next free one from U+0100 on."""
    visible = {b for b in range(256) if chr(b).isprintable() and b != 32 and b != 0xAD}
    free = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(free)) for b in range(256)]


class Counter:
    """The tokenizer file as a transducer over the words of a text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or spec["model"]["type"] != "BPE":
            raise ValueError(f"{path} is not a word-level BPE of the kind compiled here")
        mark = spec["model"]["end_of_word_suffix"]

        def own(token: str) -> str:
            return token[: -len(mark)] + END if token.endswith(mark) else token

        ranks = {(own(a), own(b)): i for i, (a, b) in enumerate(spec["model"]["merges"])}
        tokens = {own(t) for t in spec["model"]["vocab"]}
        self.paths = Paths(tokens, Merges(tokens, lambda a, b: ranks.get((a, b))), end=True)
        self.symbols = {chr(b): symbol for b, symbol in enumerate(byte_symbols())}
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\t-\r "))
        self.shapes = Shapes()
        self.count_of = Memo(self._run, 100_000)
        self.known = Known(self._teach)

    def _symbols(self, word: str) -> str:
        """A word as the file's symbols, one for each byte."""
        if word.isascii() and word.isprintable():
            return word
        return "".join(map(self.symbols.__getitem__, word.encode().decode("latin-1")))

    def _words(self, run: str) -> tuple[int, list[str]]:
        """Special strings in a text between blanks, which count one and split it, and its words by the file's pattern."""
        if run.isascii() and "<|" not in run:
            return 0, [run] if run.isalpha() and run.islower() else self.pieces.findall(run.lower())
        special, out, start = 0, [], 0
        for found in [*self.special.finditer(run), None]:
            part = run[start : found.start() if found else len(run)]
            if part:
                part = "".join(c.lower() for c in unicodedata.normalize("NFC", part))
                out += [part[m.start() : m.end()] for m in self.pieces.finditer(part.translate(self.shapes))]
            if found:
                special, start = special + 1, found.end()
        return special, out

    def _counts(self, runs: list[str]) -> list[int]:
        """Tokens of texts between blanks."""
        found = [self._words(r) for r in runs]
        words = list({w for _, some in found for w in some})
        if words:
            _, counts, _ = self.paths.split(list(map(self._symbols, words)))
            of = dict(zip(words, counts.tolist(), strict=True))
        return [special + sum([of[w] for w in some]) for special, some in found]

    def _run(self, run: str) -> int:
        return self._counts([run])[0]

    def _teach(self, runs: list[str]) -> None:
        self.known.keep(runs, np.ones(len(runs), np.int64), self._counts(runs))

    def batch(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text (null: empty)."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
        short = pc.if_else(pa.array(sizes <= CHUNK), texts, "")
        counts, words = self.known.rows(cut_rows(short))
        through = np.concatenate(([0], np.cumsum(counts)))
        ends = np.cumsum(words)
        out = through[ends] - through[ends - words]
        for i in np.flatnonzero(sizes > CHUNK).tolist():
            out[i] = self.count(texts[i].as_py())
        return out

    def chunk(self, text: str) -> Chunk:
        """The state map of one piece of text."""
        runs = text.replace("\n", " ").split(" ")
        if len(runs) == 1:
            return Chunk(text, None, "")
        counts, _ = self.known.rows(cut_rows(pa.array([" ".join(runs[1:-1])], pa.string())))
        return Chunk(runs[0], int(counts.sum()), runs[-1])

    def compose(self, a: Chunk, b: Chunk) -> Chunk:
        """The map of two neighbouring pieces."""
        if a.inner is None and b.inner is None:
            return Chunk(a.head + b.head, None, "")
        if a.inner is None:
            return Chunk(a.head + b.head, b.inner, b.tail)
        if b.inner is None:
            return Chunk(a.head, a.inner, a.tail + b.head)
        border = a.tail + b.head
        return Chunk(a.head, a.inner + b.inner + (self.count_of[border] if border else 0), b.tail)

    def scan(self, maps: list[Chunk]) -> Chunk:
        """All maps composed, neighbours first, as a parallel scan does."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        whole = self.scan([self.chunk(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)])
        ends = [whole.head] if whole.inner is None else [whole.head, whole.tail]
        return (whole.inner or 0) + sum(self.count_of[e] for e in ends if e)


class Chunk(NamedTuple):
    """A piece's map: text before its first blank, tokens between the first and last, text after it.

    `inner` is None for a piece without a blank, which is all head.
    """

    head: str
    inner: int | None
    tail: str


@lru_cache(maxsize=2)
def compiled(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    df: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", limit: int = 2048
) -> DataFrame:
    """One row per row: key, n_bytes, n_tokens and whether the tokens exceed `limit`.

    `tokenizer` is the path of the file on every worker. A null text has no bytes and no tokens; null
    keys, repeated rows and extra columns of any name do no harm; an empty table gives an empty result.
    """

    def counted(batches):
        counter = compiled(tokenizer)
        for batch in in_slices(batches, 2 << 20):
            counts = counter.batch(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(counts > limit, pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = clean(df, doc_id=key, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def place(name: str) -> str:
    """Where a public vocabulary file lies."""
    return public_tokenizers.path(name)
