"""CRC-32 of many spans of one byte buffer at once.

A CRC is linear: that of a span is the exclusive or of one number for each byte, which depends on the byte and on how
many bytes follow it, and of one number for the span's length. Both come from tables, so the CRCs of all words and
word pairs of a text are a table lookup for each byte and one `bitwise_xor.reduceat`. Spans beyond the tables are
folded block by block.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Bytes that may follow a byte within the tables.
REACH = 512


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """What a byte with so many bytes behind it adds, row by row after a row of zeros, and what a length adds."""
    lengths = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)
    at_end = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32) ^ lengths[1]
    rows = np.zeros((REACH + 1, 256), np.uint32)
    rows[1] = at_end
    for k in range(2, REACH + 1):  # one more zero byte behind
        rows[k] = (rows[k - 1] >> 8) ^ at_end[rows[k - 1] & 255]
    return rows.ravel(), lengths


ROWS, LENGTHS = _tables()


def _past_block(value: int) -> int:
    """The contribution `value` with REACH more bytes behind it: its own bytes count as the first four of those."""
    out = 0
    for k in range(4):
        out ^= int(ROWS[(REACH - k) * 256 + (value >> 8 * k & 255)])
    return out


def _linear(codes: np.ndarray, most: int = 1 << 16) -> int:
    """All bytes' contributions to a span of any length: blocks of REACH bytes, counted from its end, each
    reduced on its own and the sum so far moved past it."""
    total, first = 0, len(codes) % REACH
    places = (REACH - np.arange(REACH, dtype=np.int32)) * 256
    if first:
        total = int(np.bitwise_xor.reduce(ROWS[places[REACH - first :] + codes[:first]]))
    for at in range(first, len(codes), most):
        part = codes[at : at + most]
        blocks = np.arange(0, len(part), REACH)
        for value in np.bitwise_xor.reduceat(ROWS[np.tile(places, len(blocks)) + part], blocks).tolist():
            total = _past_block(total) ^ value
    return total


def _zeros(length: int) -> int:
    """The CRC of so many zero bytes."""
    whole, rest = divmod(length, 1 << 16)
    crc = zlib.crc32(bytes(rest))
    for _ in range(whole):
        crc = zlib.crc32(bytes(1 << 16), crc)
    return crc


def span_crc(codes: np.ndarray) -> int:
    """The CRC of one span of any length."""
    return _linear(codes) ^ _zeros(len(codes))


def word_and_pair_crcs(
    codes: np.ndarray, ends: np.ndarray, last: np.ndarray, group: int = 1 << 18
) -> tuple[np.ndarray, np.ndarray]:
    """CRCs of all words of a buffer, and of each word, a blank and the next word (0 where `last` holds: the word has
    no next one in its text).

    Words stand in `codes` one after the other, each with one blank behind it, which is at `ends`. Tables of
    positions are made for `group` bytes at a time; a longer word is a group of its own.
    """
    starts = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64)
    sizes = (ends - starts).astype(np.int32)
    following = np.concatenate((sizes[1:], [0])).astype(np.int32)  # of the next word
    own, first = np.zeros(len(ends), np.uint32), np.zeros(len(ends), np.uint32)
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + group, "right")))
        a, b = int(starts[at]), int(ends[to - 1]) + 1
        if b - a <= max(group, REACH) + 1:
            width = sizes[at:to] + 1
            # 0 for the byte behind a word, 1 for a word's last byte, and so on back to its first
            behind = np.repeat((ends[at:to] - a).astype(np.int32), width) - np.arange(b - a, dtype=np.int32)
            cells = np.minimum(behind, REACH) * 256 + codes[a:b]
            local = starts[at:to] - a
            own[at:to] = np.bitwise_xor.reduceat(ROWS[cells], local)
            behind += np.repeat(following[at:to] + 1, width)
            cells = np.minimum(behind, REACH) * 256 + codes[a:b]
            first[at:to] = np.bitwise_xor.reduceat(ROWS[cells], local)
        at = to
    single = own ^ LENGTHS[np.minimum(sizes, REACH)]
    pair = first ^ np.concatenate((own[1:], [0])).astype(np.uint32) ^ LENGTHS[np.minimum(sizes + 1 + following, REACH)]
    for i in np.flatnonzero(sizes > REACH).tolist():
        single[i] = span_crc(codes[starts[i] : ends[i]])
    pair[last] = 0
    for i in np.flatnonzero((sizes + 1 + following > REACH) & ~last).tolist():
        pair[i] = span_crc(codes[starts[i] : ends[i + 1]])
    return single, pair
