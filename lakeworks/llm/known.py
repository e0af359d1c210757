"""Ids of words that were met before, and the ids of whole rows gathered from them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa


class Known:
    """The ids of at most `most` words, one after the other in one array. `teach` is given the words of a batch that are
    not known yet and must `keep` each of them; when there are too many, or they are long, all others are forgotten first."""

    def __init__(self, teach: Callable[[list[str]], None], dtype=np.int32, most: int = 600_000):
        self.teach, self.dtype, self.most = teach, dtype, most
        self.forget()

    def forget(self) -> None:
        """Back to knowing the empty word only, which has no ids."""
        self.slots: dict[str, int] = {"": 0}
        self.ids = np.zeros(1 << 16, self.dtype)
        self.ends, self.used = np.zeros(1 << 14, np.int64), 0  # where each slot's ids end
        self.chars = 0

    def keep(self, words: list[str], sizes, ids) -> None:
        """Words that are new, how many ids each has, and all their ids."""
        first, need = len(self.slots), self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(need - len(self.ids), len(self.ids)), self.dtype)))
        if first + len(words) > len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros(max(len(words), len(self.ends)), np.int64)))
        self.ids[self.used : need] = ids
        self.ends[first : first + len(words)] = self.used + np.cumsum(sizes)
        self.used = need
        self.chars += sum(map(len, words))
        self.slots.update(zip(words, range(first, first + len(words)), strict=True))

    def of(self, word: str) -> np.ndarray:
        """The ids of a known word."""
        slot = self.slots[word]
        return self.ids[self.ends[slot - 1] if slot else 0 : self.ends[slot]]

    def learn(self, words: list[str]) -> None:
        """See to it that all these different words are known."""
        new = [w for w in words if w not in self.slots]
        if len(self.slots) + len(new) > self.most or self.chars > 16 * self.most:
            self.forget()
            new = [w for w in words if w]
        if new:
            self.teach(new)

    def rows(self, rows: pa.ListArray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows' words, each row's with `end` behind them if there is one, and how many each row has."""
        coded = rows.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(words)
        slot = np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))
        ends = self.ends[slot]
        sizes = ends - np.where(slot > 0, self.ends[slot - 1], 0)
        run = coded.indices.to_numpy().astype(np.int64)
        borders = (rows.offsets.to_numpy() - rows.offsets[0].as_py()).astype(np.int64)
        if end is not None:  # one more word, the end, behind each row
            run = np.insert(run, borders[1:], len(words))
            ends, sizes = np.append(ends, 0), np.append(sizes, 1)
            borders += np.arange(len(borders))
        size = sizes[run]
        through = np.cumsum(size)
        at = np.repeat(ends[run] - through, size)
        at += np.arange(len(at))
        out = self.ids[at].astype(np.int32)
        stops = np.concatenate(([0], through))[borders]
        if end is not None:
            out[stops[1:] - 1] = end
        return out, np.diff(stops)
