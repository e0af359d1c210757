"""Hashes of words and of runs of words, for a batch of texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

from lakeworks.llm.texts import WORD_BYTES

_SEEDED = np.random.default_rng(20240607)
#: A number for each byte and powers for its place in a word; fixed, so that hashes agree everywhere.
_BYTE = _SEEDED.integers(1, 1 << 63, 256, np.uint64)
_PLACE = 1 << 12
_POWERS = np.cumprod(np.full(_PLACE, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
_RUN = _SEEDED.integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: Bytes whose words are hashed together.
PIECE = 1 << 18


def _pieces(data: bytes):
    """Parts of about PIECE bytes that end behind a word; a longer word is in one part. `data` ends with a blank."""
    at = 0
    while at < len(data):
        cut = data.rfind(b" ", at, at + PIECE)
        cut = cut if cut >= 0 else data.find(b" ", at + PIECE)
        yield at, np.frombuffer(data, np.uint8, cut + 1 - at, at)
        at = cut + 1


def _edges(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], codes != 32, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def _values(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """What each byte adds to its word's sum; places repeat after a few thousand bytes, with another number for each round."""
    value = _POWERS[place & (_PLACE - 1)]
    value *= _BYTE[codes]
    value += (place >> 12).astype(np.uint64)
    return value


def _joined(texts: list[str | None]) -> tuple[bytes, np.ndarray]:
    raws = [(t or "").encode() + b" " for t in texts]
    return b"".join(raws).translate(WORD_BYTES), np.concatenate(([0], np.cumsum([len(r) for r in raws])))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of all texts, and where each text's words start (one more at the end)."""
    data, text_starts = _joined(texts)
    hashes, begins = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, codes in _pieces(data):
        starts, ends = _edges(codes)
        if not len(starts):
            continue
        if len(codes) > PIECE:  # one long word, summed part by part
            word = codes[starts[0] : ends[0]]
            parts = (_values(word[i : i + PIECE], np.arange(i, min(i + PIECE, len(word)))).sum(dtype=np.uint64) for i in range(0, len(word), PIECE))
            sums = np.array([sum(int(p) for p in parts) & 0xFFFFFFFFFFFFFFFF], np.uint64)
        else:
            body = codes[starts[0] :]
            place = np.arange(len(body)) - np.repeat(starts - starts[0], np.diff(np.append(starts, len(codes))))
            value = _values(body, place)
            value[body == 32] = 0
            sums = np.add.reduceat(value, starts - starts[0])
        hashes.append(mixed(sums + (ends - starts).astype(np.uint64)))
        begins.append(starts + at)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), text_starts)


def word_counts(texts: list[str | None]) -> np.ndarray:
    """How many words each text has."""
    data, text_starts = _joined(texts)
    begins = [np.zeros(0, np.int64), *(_edges(codes)[0] + at for at, codes in _pieces(data))]
    return np.diff(np.searchsorted(np.concatenate(begins), text_starts))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every `length` neighbouring words."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    # runs of 2, 4, 8 ... words by doubling, then the rest word by word
    out, done, count = words.copy(), 1, len(words) - length + 1
    while 2 * done <= length:
        out = mixed(out[: len(out) - done] * _RUN[done.bit_length()] + out[done:])
        done *= 2
    total = out[:count]
    while done < length:
        total = mixed(total * _RUN[0] + words[done : done + count])
        done += 1
    return total


def shingle_set(words: np.ndarray, length: int) -> np.ndarray:
    """The distinct hashes of `length` words, in order; shorter texts have one, of all their words."""
    if 0 < len(words) < length:
        return mixed(run_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(run_hashes(words, length))


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()
