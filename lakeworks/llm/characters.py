"""Texts of a batch as one array of code points, for counting without a loop over characters."""

from __future__ import annotations

from functools import lru_cache

import numpy as np


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, a line break after each text, and where each text starts (one more at the end)."""
    codes = np.frombuffer("".join(f"{t or ''}\n" for t in texts).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    return codes, np.concatenate(([0], np.cumsum(sizes)))


def trigrams(codes: np.ndarray, starts: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the letter trigrams and whether each counts: at least its middle and one more is a letter.

    Other characters are one and the same; a trigram that begins behind a text's last character is the next text's and
    does not count, nor do the last two positions.
    """
    alpha = letters()[codes]
    plain = np.where(alpha, codes, 0).astype(np.uint32)
    mixed = plain[:-2] * np.uint32(2654435761) ^ plain[1:-1] * np.uint32(2246822519) ^ plain[2:] * np.uint32(3266489917)
    index = np.zeros(len(codes), np.int32)
    index[:-2] = (mixed ^ (mixed >> np.uint32(15))) & np.uint32(bins - 1)
    counts = np.zeros(len(codes), bool)
    counts[:-2] = alpha[1:-1] & (alpha[:-2] | alpha[2:])
    counts[starts[1:] - 1] = False
    return index, counts
