"""Benchmark decontamination with a suffix automaton of the test items.

The items' words go into one generalised suffix automaton. A document's words are streamed through it;
the automaton keeps the longest run that ends at the current word and stands in some item. A run of
`window` words is a hit, and so is the whole of an item that is shorter.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.texts import clean, cut_words, in_slices, joined, numbered, words_of
from lakeworks.runtime import materialise


class SuffixAutomaton:
    """All runs of words of many items, with the items that hold each window."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window, self.ids = window, [i for i, _ in items]
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        self.vocabulary: dict[bytes, int] = {}
        coded = []
        for _, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            coded.append(words)
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.holds: dict[int, set[int]] = defaultdict(set)
        self.short: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item, words in enumerate(coded):
            state = length = 0
            for word in words:
                state, length = self.advance(state, length, word)
                if length >= window:
                    self.holds[self.shorten(state, window)].add(item)
            if 0 < len(words) < window:
                self.short[self.shorten(state, len(words))].append((len(words), item))
        self.least = min([window, *(n for found in self.short.values() for n, _ in found)])

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, below: int, word: int) -> int:
        """The state of the run `below` + word, apart from longer runs that other items share."""
        to = self.next[below][word]
        if self.length[to] == self.length[below] + 1:
            return to
        twin = self._state(self.length[below] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = twin
        while below >= 0 and self.next[below].get(word) == to:
            self.next[below][word] = twin
            below = self.link[below]
        return twin

    def _extend(self, last: int, word: int) -> int:
        """Add one word after `last`, which stands for the item so far."""
        if word in self.next[last]:
            return self._split(last, word)
        made, at = self._state(self.length[last] + 1, {}, 0), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = made
            at = self.link[at]
        if at >= 0:
            self.link[made] = self._split(at, word)
        return made

    def advance(self, state: int, length: int, word: int) -> tuple[int, int]:
        """The longest run that ends with `word`."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        following = self.next[state].get(word)
        return (following, length + 1) if following is not None else (0, 0)

    def shorten(self, state: int, length: int) -> int:
        """The state of the last `length` words of a run."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans of a document, as [first, after last) words, and the items they come from."""
        known = np.fromiter(map(self.vocabulary.get, words, [0] * len(words)), np.int32, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known != 0, [0]))))
        spans, items = [], set()
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start < self.least:
                continue
            state = length = 0
            for at, word in enumerate(known[start:end].tolist(), start + 1):
                state, length = self.advance(state, length, word)
                if length >= self.window:
                    spans.append((at - self.window, at))
                    items |= self.holds[self.shorten(state, self.window)]
                if self.short:
                    up = state
                    while up > 0:
                        for size, item in self.short.get(up, ()):
                            if size <= length:
                                spans.append((at - size, at))
                                items.add(item)
                        up = self.link[up]
        return joined(spans), items


_built: dict[str, SuffixAutomaton] = {}


def _automaton(items, window: int) -> SuffixAutomaton:
    """Built once a worker for the items in use."""
    name = hashlib.sha256(repr((window, items)).encode()).hexdigest()
    if name not in _built:
        _built.clear()
        _built[name] = SuffixAutomaton(items, window)
    return _built[name]


def item_blocks(items: DataFrame, item: str, text: str, block_bytes: int):
    """The items on the driver, a block of bounded size at a time."""
    block, size = [], 0
    rows = clean(items, item=item, text=text).select(F.col("item").cast("string"), "text").orderBy("item", "text")
    for row in rows.toLocalIterator():
        block.append((row[0] or "", row[1]))
        size += len(row[1] or "") + 16
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block or not size:
        yield block


def _matched(df: DataFrame, block, window: int) -> DataFrame:
    """Each row of df with n_words, hit spans (two lists of word numbers) and item ids of one block."""
    kept = df.columns
    held = df.sparkSession.sparkContext.broadcast(block)  # at most block_bytes

    def matched(batches):
        automaton = _automaton(held.value, window)
        for batch in in_slices(batches):
            words = [words_of(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            found = [automaton.match(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(c)) for c in kept),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[a for a, _ in spans] for spans, _ in found], pa.list_(pa.int32())),
                    pa.array([[b for _, b in spans] for spans, _ in found], pa.list_(pa.int32())),
                    pa.array([[automaton.ids[i] for i in ids] for _, ids in found], pa.list_(pa.string())),
                ],
                [*kept, "n_words", "starts", "ends", "items"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(matched, f"{schema}, n_words long, starts array<int>, ends array<int>, items array<string>")


def find(
    df: DataFrame, items: DataFrame, window: int = 10, text: str = "text", key: str = "doc_id",
    item: str = "item_id", item_text: str = "text", block_bytes: int = 16 << 20,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the hit spans.

    Items go to the workers in blocks of at most `block_bytes`; one block suffices for usual benchmarks,
    and more blocks mean one pass over the documents each, put together by document. Null and empty texts
    have no words and no hits; an item without words has no window; null item ids count as the empty
    string. Rows are never merged: repeated rows each give a result. An empty table of items finds nothing.
    """
    rows = clean(df, doc_id=key, text=text)
    blocks = item_blocks(items, item, item_text, block_bytes)
    first, more = next(blocks), next(blocks, None)
    if more is None:
        hits = _matched(rows, first, window).drop("text")
        return hits.select("doc_id", "n_words", *_digest(hits))
    rows = rows.withColumn("row", F.struct(F.xxhash64("doc_id", "text"), F.monotonically_increasing_id()))
    rows = materialise(rows, "decontaminate")  # row numbers must not change between passes
    passes = _matched(rows, first, window).drop("text")
    while more is not None:
        passes, more = passes.unionByName(_matched(rows, more, window).drop("text")), next(blocks, None)
    hits = passes.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")),
    )
    return hits.select("doc_id", "n_words", *_digest(hits))


def _digest(hits: DataFrame):
    """Counts and item digest; spans of several blocks may overlap, so words are counted once."""
    spans = F.array_sort(F.arrays_zip("starts", "ends"))
    covered = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda seen, s: F.struct(
            (seen["n"] + F.greatest(F.lit(0), s["ends"] - F.greatest(seen["to"], s["starts"]))).alias("n"),
            F.greatest(seen["to"], s["ends"]).alias("to"),
        ),
        lambda seen: seen["n"],
    )
    items = F.array_sort(F.array_distinct("items"))
    return (
        covered.cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"),
        spans.alias("spans"),
    )


def remove(
    df: DataFrame, items: DataFrame, window: int = 10, text: str = "text", most_covered: float = 0.5,
    item: str = "item_id", item_text: str = "text", block_bytes: int = 16 << 20,
) -> DataFrame:
    """The documents with hit spans cut out of `text`; those with more than `most_covered` of their words
    hit go altogether. Cutting goes on until nothing is hit, since a cut brings other words together.
    All columns stay; null and empty texts are kept as they are. A document without hits is untouched.

    Each decision and each cut takes the hits of all items together, in however many blocks they come: several
    blocks mean a pass over the documents each, and then passes over the cut documents until no block hits.
    """
    names, place = df.columns, df.columns.index(text)
    df = numbered(df)
    blocks = item_blocks(items, item, item_text, block_bytes)
    first, more = next(blocks), next(blocks, None)
    if more is not None:
        left = _cut_by_blocks(df, f"c{place}", lambda: item_blocks(items, item, item_text, block_bytes), window, most_covered)
        return left.toDF(*names)
    kept, held = df.columns, df.sparkSession.sparkContext.broadcast(first)  # at most block_bytes

    def cut(batches):
        automaton = _automaton(held.value, window)
        for batch in in_slices(batches):
            texts, stays, changed = batch.column(place).to_pylist(), [], False
            for i, whole in enumerate(texts):
                words = words_of(whole)
                spans, stay = automaton.match(words)[0], True
                if spans and sum(b - a for a, b in spans) > most_covered * len(words):
                    stay, spans = False, []
                while spans:
                    whole = cut_words(whole, spans)
                    changed, spans = True, automaton.match(words_of(whole))[0]
                texts[i] = whole
                stays.append(stay)
            columns = batch.columns
            if changed:
                columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, kept).filter(pa.array(stays, pa.bool_()))

    return df.mapInArrow(cut, df.schema).toDF(*names)


def _cut_by_blocks(df: DataFrame, text: str, blocks, window: int, most_covered: float) -> DataFrame:
    """`df` (numbered columns) without the hits of all blocks. Each round joins the spans of every block on
    the same text and then cuts; only texts that a round has cut go into the next one."""
    # row numbers must not change between passes
    rows = materialise(df.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    texts, done = rows.select("row", F.col(text).alias("text")), None
    while True:
        found = None
        for block in blocks():
            hits = _matched(texts, block, window).where("size(starts) > 0").select("row", "n_words", "starts", "ends")
            found = hits if found is None else found.unionByName(hits)
        found = found.groupBy("row").agg(
            F.first("n_words").alias("n_words"), *(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends"))
        )
        share = most_covered if done is None else None  # coverage counts on the unchanged text only

        def cut(batches, share=share):
            for batch in in_slices(batches):
                left = []
                for whole, n_words, starts, ends in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
                    spans = joined(zip(starts, ends, strict=True))
                    gone = share is not None and sum(b - a for a, b in spans) > share * n_words
                    left.append(None if gone else cut_words(whole, spans))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(left, pa.string())], ["row", "text"])

        changed = texts.join(found, "row").select("row", "text", "n_words", "starts", "ends")
        changed = materialise(changed.mapInArrow(cut, "row long, text string"), "decontaminated")
        if done is not None and changed.isEmpty():
            break
        last = changed.select("row", F.col("text").alias("cut"))
        done = last if done is None else materialise(done.join(last, "row", "left_anti").unionByName(last), "decontaminated")
        texts = changed.where("text is not null")
    # a row that was cut has its last text, and none if it goes altogether
    whole = rows.join(done.withColumn("hit", F.lit(True)), "row", "left").where("hit is null or cut is not null")
    return whole.select(*(F.coalesce("cut", c).alias(c) if c == text else F.col(c) for c in df.columns))
