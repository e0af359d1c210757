"""Byte-pair merges as a deterministic automaton over symbols, built as far as texts need it.

After every prefix of a word the merges leave exactly one last token; a token may follow another only
if no merge would have crossed their border. So the automaton has one live token per prefix, and a
transition is found by trying the tokens that end at the new symbol. States are kept in a trie that is
shared by all words and thrown away when it has grown to `most_states`.
"""

from __future__ import annotations

NEVER = float("inf")


#: Marks the last symbol of a word in files that tell it from the others; no symbol of its own.
END = "\0"


def symbols_of(token: str) -> list[str]:
    parts = list(token)
    if parts[-1] == END and len(parts) > 1:
        parts[-2:] = [parts[-2] + END]
    return parts


class Merges:
    """The order in which neighbours merge: `rank(a, b)` is None where they never do."""

    def __init__(self, tokens, rank, most_pairs: int = 300_000):
        self.tokens, self.rank, self.most_pairs = tokens, rank, most_pairs
        #: what is the end of a longer token; the search for a last token stops elsewhere
        self.endings = {t[i:] for t in tokens for i in range(1, len(t))}
        self._spines: dict[str, tuple] = {}
        self._fits: dict[str, dict[str, bool]] = {}
        self.pairs = 0

    def merged(self, symbols: list[str]) -> list[tuple]:
        """Merge a short list fully; each entry is (token, left part, right part, rank)."""
        parts = [(s, None, None, -1) for s in symbols]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank(parts[i][0], parts[i + 1][0])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            a, b = parts[at], parts[at + 1]
            parts[at : at + 2] = [(a[0] + b[0], a, b, best)]
        return parts

    def spines(self, token: str) -> tuple:
        """The symbols that stand at the token's left and right border over time, each with the rank that
        takes it into a larger one; empty if the merges never make this token."""
        found = self._spines.get(token)
        if found is None:
            parts, sides = self.merged(symbols_of(token)), []
            if len(parts) == 1:
                for side in (1, 2):
                    node, until, chain = parts[0], NEVER, []
                    while node is not None:
                        chain.append((node[0], until))
                        until, node = node[3], node[side]
                    sides.append(chain)
            found = self._spines[token] = tuple(sides)
        return found

    def fits(self, a: str, b: str) -> bool:
        """Whether both tokens stay as they are when they stand side by side."""
        beside = self._fits.get(a)
        if beside is None:
            beside = self._fits[a] = {}
        known = beside.get(b)
        if known is None:
            self.pairs += 1
            if self.pairs > self.most_pairs:
                self._fits, self.pairs = {}, 0
            known = beside[b] = self._border_holds(self.spines(a), self.spines(b))
        return known

    def border_holds(self, a: str, b: str) -> bool:
        """As `fits`, without keeping the answer."""
        return self._border_holds(self.spines(a), self.spines(b))

    def forget(self) -> None:
        """Give back what was learnt from words."""
        self._spines, self._fits, self.pairs = {}, {}, 0

    def _border_holds(self, left: tuple, right: tuple) -> bool:
        if not left or not right:
            return False
        for x, x_until in left[1]:
            for y, y_until in right[0]:
                r = self.rank(x, y)
                # equal ranks merge from the left: a border merge loses to one on its left
                if r is not None and r < x_until and r <= y_until:
                    return False
        return True


class State:
    """After one prefix: the last token, how many symbols it spans, how many tokens so far."""

    __slots__ = ("count", "next", "span", "token")

    def __init__(self, token, span, count):
        self.token, self.span, self.count, self.next = token, span, count, None


class Automaton:
    """Deterministic transducer: each transition's output is the change in the number of tokens."""

    def __init__(self, merges: Merges, most_states: int = 400_000):
        self.merges, self.most_states = merges, most_states
        self.forget()

    def forget(self) -> None:
        """Back to the empty prefix; what is needed is built again."""
        self.root, self.states = State(None, 0, 0), 1

    def step(self, path: list[State], word: str, at: int, symbol: str) -> State:
        """The state after word[:at] and `symbol`; `path` holds the states of all shorter prefixes."""
        merges, start, token, end = self.merges, at, symbol, symbol[1:]
        tokens, endings, found = merges.tokens, merges.endings, [symbol]
        while start and token in endings:
            start -= 1
            token = word[start : at + 1] + end
            found.append(token)
        # the longest is the likeliest to hold
        for span in range(len(found), 0, -1):
            token, before = found[span - 1], path[at + 1 - span]
            if span == 1 or token in tokens:
                if merges.fits(before.token, token) if before.span else span == 1 or merges.spines(token):
                    return State(token, span, before.count + 1)
        raise ValueError(f"no token ends at {symbol!r}")

    def run(self, word: str, end: str = "") -> list[State]:
        """The states after every prefix, the empty one first; `end` marks the last symbol."""
        if self.states > self.most_states:
            self.forget()
        state, path, last = self.root, [self.root], len(word) - 1
        for at, symbol in enumerate(word):
            if at == last:
                symbol += end
            following = state.next.get(symbol) if state.next else None
            if following is None:
                following = self.step(path, word, at, symbol)
                if state.next is None:
                    state.next = {}
                state.next[symbol] = following
                self.states += 1
            path.append(following)
            state = following
        return path

    def once(self, word: str, end: str = "") -> list[str]:
        """As `tokens`, for a word that is not met again: no transition is kept."""
        path, last = [State(None, 0, 0)], len(word) - 1
        for at, symbol in enumerate(word):
            path.append(self.step(path, word, at, symbol + end if at == last else symbol))
        return self._back(path)

    def tokens(self, word: str, end: str = "") -> list[str]:
        """The tokens on the one path that reaches the end, first to last."""
        return self._back(self.run(word, end))

    def _back(self, path: list[State]) -> list[str]:
        at, out = len(path) - 1, []
        while at:
            out.append(path[at].token)
            at -= path[at].span
        return out[::-1]
