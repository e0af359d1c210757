"""Shortest paths through a merge automaton, for many words at once.

After every prefix of a word the merges leave exactly one last token (see `merges`). All words of a batch take one symbol
after the other together: the tokens that end at a word's symbol are found by walking a trie of reversed tokens back
through the word, longest first, and a token is taken if the token in front of it keeps their border. Borders are
computed once for each pair of tokens.
"""

from __future__ import annotations

import numpy as np

from lakeworks.llm.merges import END, Automaton, Merges, symbols_of

#: Words of more symbols are walked on their own: few are as long, and each step would hold few words.
LONG = 256


class IntMap:
    """Whole numbers by whole number: open addressing in two arrays, doubled when half full."""

    def __init__(self, bits: int = 12):
        self._clear(bits)

    def _clear(self, bits: int) -> None:
        self.bits, self.size = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys (none negative), -1 for those that are not there."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], np.int32(-1))
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            at = slot[open_]
            found = self.keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Different keys that are not there yet."""
        while 2 * (self.size + len(keys)) > len(self.keys):
            used = self.keys >= 0
            old = self.keys[used], self.values[used]
            self._clear(self.bits + 1)
            self.put(*old)
        self.size += len(keys)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several in one place the last one stays
            won = self.keys[slot] == keys
            self.values[slot[won]] = values[won]
            keys, values, slot = keys[~won], values[~won], (slot[~won] + 1) & (len(self.keys) - 1)


class Paths:
    """The tokens of words. `end` marks the last symbol of a word as another one than the same symbol elsewhere."""

    def __init__(self, tokens, merges: Merges, end: bool = False, most_pairs: int = 1 << 20):
        self.merges, self.end, self.most_pairs = merges, end, most_pairs
        self.automaton = Automaton(merges)
        parts = {t: symbols_of(t) if end else list(t) for t in tokens}
        symbols = {s for p in parts.values() for s in p} | ({s + END for p in parts.values() for s in p if END not in s} if end else set())
        #: all tokens and bare symbols; the last number stands for any symbol that no token has
        self.tokens = [*parts, *sorted(symbols - parts.keys())]
        self.unknown = len(self.tokens)
        self.tokens.append("")
        number = {s: i + 1 for i, s in enumerate(sorted(symbols))}
        self.n_symbols = len(number) + 1
        self.inner, self.last = np.zeros(0x110000, np.int32), np.zeros(0x110000 if end else 0, np.int32)
        for s, i in number.items():
            (self.last if s.endswith(END) else self.inner)[ord(s[0])] = i
        self.first = np.zeros(self.n_symbols, np.int32)  # node after a last symbol
        self.children, token_of, parents = IntMap(), [self.unknown], [False]
        edges: dict[int, int] = {}
        for t, token in enumerate(self.tokens[: self.unknown]):
            path = [number[s] for s in reversed(parts.get(token, [token]))]
            node = int(self.first[path[0]])
            if not node:
                node = self.first[path[0]] = len(token_of)
                token_of.append(-1)
                parents.append(False)
            for s in path[1:]:
                key = int(node) * self.n_symbols + s
                parents[node] = True
                if key not in edges:
                    edges[key] = len(token_of)
                    token_of.append(-1)
                    parents.append(False)
                node = edges[key]
            token_of[node] = t
        self.token_of, self.parents = np.array(token_of, np.int32), np.array(parents, bool)
        self.children.put(np.fromiter(edges, np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges)))
        #: whether the merges ever make the token; symbols are there from the start
        self.made = np.array([bool(merges.spines(t)) if len(parts.get(t, t)) > 1 else True for t in self.tokens])
        self.borders = IntMap(16)
        self.number = {t: i for i, t in enumerate(self.tokens[: self.unknown])}

    def forget(self) -> None:
        """Give back what was learnt from words."""
        self.borders = IntMap(16)
        self.merges.forget()

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the merges keep the borders between tokens."""
        keys = left.astype(np.int64) * len(self.tokens) + right
        known = self.borders.get(keys)
        new = np.unique(keys[known < 0])
        if len(new):
            if self.borders.size + len(new) > self.most_pairs:
                self.borders = IntMap(16)
                new = np.unique(keys)
            tokens, fits, n = self.tokens, self.merges.border_holds, len(self.tokens)
            holds = [fits(tokens[k // n], tokens[k % n]) if k // n != self.unknown != k % n else True for k in new.tolist()]
            self.borders.put(new, np.array(holds, np.int32))
            known = self.borders.get(keys)
        return known > 0

    def _step(self, symbols: np.ndarray, at: np.ndarray, done: int, token: np.ndarray, span: np.ndarray) -> None:
        """The last token of each word after `done` + 1 symbols, of which the last is at `at`."""
        node, index, found = self.first[symbols[at]], np.arange(len(at)), []
        for width in range(1, done + 2):
            here = self.token_of[node] if width > 1 else np.where(node > 0, self.token_of[node], self.unknown)
            ends = here >= 0
            found.append((index[ends], here[ends]))
            onward = self.parents[node]
            if width > done or not onward.any():
                break
            index, node = index[onward], node[onward].astype(np.int64)
            node = self.children.get(node * self.n_symbols + symbols[at[index] - width])
            index, node = index[node >= 0], node[node >= 0]
        open_ = np.ones(len(at), bool)
        for width in range(len(found), 0, -1):  # the longest is the likeliest to hold
            index, here = found[width - 1]
            still = open_[index]
            index, here = index[still], here[still]
            place = at[index]
            good = self.made[here] if width > done else self._fits(token[place - width], here)
            place = place[good]
            token[place], span[place] = here[good], width
            open_[index[good]] = False
        if open_.any():
            raise ValueError("no token ends at a symbol")

    def _alone(self, word: str, token: np.ndarray, span: np.ndarray) -> None:
        """One long word, symbol by symbol."""
        at = -1
        for found in self.automaton.once(word, END if self.end else ""):
            width = len(found) - (found.endswith(END) and len(found) > 1 and self.end)
            at += width
            token[at], span[at] = self.number.get(found, self.unknown), width

    def split(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words' tokens (numbers of `tokens`) one word after the other, how many each word has, and the code point
        at the end of each token. No word may be empty."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        symbols = self.inner[codes]
        if self.end:
            symbols[ends - 1] = self.last[codes[ends - 1]]
        token, span = np.zeros(len(codes), np.int32), np.zeros(len(codes), np.int32)
        for w in np.flatnonzero(sizes > LONG).tolist():
            a, b = ends[w] - sizes[w], ends[w]
            self._alone(words[w], token[a:b], span[a:b])
        short = np.flatnonzero(sizes <= LONG)
        short = short[np.argsort(-sizes[short], kind="stable")]
        starts, widths = (ends - sizes)[short], -sizes[short]
        for done in range(-int(widths[0]) if len(short) else 0):
            active = int(np.searchsorted(widths, -done))  # words of more symbols than were taken
            self._step(symbols, starts[:active] + done, done, token, span)
        closes, at, start = np.zeros(len(codes), bool), ends - 1, ends - sizes
        while len(at):
            closes[at] = True
            at = at - span[at]
            going = at >= start
            at, start = at[going], start[going]
        places = np.flatnonzero(closes)
        return token[places], np.diff(np.searchsorted(places, ends), prepend=0), codes[places]
