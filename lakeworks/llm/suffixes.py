"""Repeated passages by a sparse suffix array.

Suffixes of word sequences are kept at minimiser positions only, which the words themselves select: of
every `window` runs of `gram` words the least hash. A passage of `least` words has such a position near its
start in every document, with `prefix` words behind it. Suffixes are sorted by the hash of those words and
by document and place; equal neighbours are the same words. Each is matched with the first of its equals, and
a match is extended word by word to the left and right of its outermost suffixes. The first may hold less of
a passage than later ones share: where a suffix has several equals before or after it, the windows of `least` words
around it that the first does not hold are sorted by hash in the same way, and a window's first holder keeps it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.shingles import run_hashes, word_counts, word_hashes
from lakeworks.llm.texts import clean, cut_words, in_slices, joined
from lakeworks.runtime import materialise


@dataclass(frozen=True)
class Suffixes:
    """A repeat has `least` words or more; window + gram - 1 and window - 1 + prefix must not exceed it."""

    least: int = 50
    gram: int = 8
    window: int = 24
    prefix: int = 24


def _extreme(values: np.ndarray, width: int, choose) -> np.ndarray:
    """The least or greatest of every `width` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        values = choose(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return choose(values[: len(values) - rest], values[rest:]) if rest else values


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Places that are least in some window of `window` hashes (all of them where hashes are equal)."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    least = _extreme(grams, window, np.minimum)
    # a place is kept if the greatest of its windows' minima is its own hash
    padded = np.concatenate((np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)))
    return np.flatnonzero(_extreme(padded, window, np.maximum) == grams)


def _sampled(batches, how: Suffixes):
    """Kept suffixes: hash of their first words, document, place."""
    for batch in in_slices(batches, 1 << 19):
        words, starts = word_hashes(batch.column(2).to_pylist())
        hashes, rows, places = [], [], []
        for row, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            if b - a < how.least:
                continue
            kept = minimisers(run_hashes(words[a:b], how.gram), how.window)
            kept = kept[kept <= b - a - how.prefix]
            hashes.append(run_hashes(words[a:b], how.prefix)[kept])
            rows.append(np.full(len(kept), row))
            places.append(kept)
        if hashes:
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(hashes).view(np.int64)), batch.column(1).take(at), batch.column(0).take(at),
                    pa.array(np.concatenate(places).astype(np.int32)),
                ],
                ["hash", "doc_id", "uid", "place"],
            )


def _neighbours(batches):
    """Sorted places of one partition, each with the first of its equals, and whether there may be a third.

    The first and the last group may go on in other partitions: their heads are given as borders.
    """
    head, last = None, None  # (hash, uid, place) and doc_id of the current group's head
    begun = False
    for batch in batches:
        if not batch.num_rows:
            continue
        hashes, uids, places = (batch.column(i).to_numpy() for i in (0, 2, 3))
        at = np.arange(len(hashes))
        first = np.concatenate(([head is None or hashes[0] != head[0]], hashes[1:] != hashes[:-1]))
        group = np.maximum.accumulate(np.where(first, at, -1))
        known = group >= 0
        heads = np.where(known, uids[group], head[1] if head else 0), np.where(known, places[group], head[2] if head else 0)
        # the second of a group that ends with it has no equal but the head; what the batch does not tell may have
        pair = known & (at == group + 1) & np.concatenate((first[1:], [False]))
        if not begun:
            pair[hashes == hashes[0]] = False
        match = (heads[0] != uids) | (heads[1] != places)
        out = [pa.array(x[match]) for x in (hashes, uids, places.astype(np.int32), heads[0], heads[1].astype(np.int32), ~pair)]
        docs = batch.column(1)
        nothing = pa.nulls(int(match.sum()), docs.type)
        yield pa.RecordBatch.from_arrays([*out, nothing, pa.array(np.zeros(int(match.sum()), bool))], _MATCH)
        if not begun:
            yield _border((hashes[0], uids[0], places[0]), docs[0], docs.type)
            begun = True
        if group[-1] >= 0:
            head, last = (hashes[group[-1]], uids[group[-1]], places[group[-1]]), docs[int(group[-1])]
    if head is not None:
        yield _border(head, last, docs.type)


_MATCH = ["hash", "uid", "place", "head_uid", "head_place", "more", "doc_id", "border"]


def _border(head, doc_id, kind) -> pa.RecordBatch:
    values = [pa.array([int(head[0])], pa.int64()), pa.array([int(head[1])], pa.int64()), pa.array([int(head[2])], pa.int32())]
    return pa.RecordBatch.from_arrays(
        [*values, *values[1:], pa.array([True]), pa.array([doc_id.as_py()], kind), pa.array([True])], _MATCH
    )


def _with_first(places: DataFrame, kind: str, name: str) -> DataFrame:
    """Each place (hash, doc_id, uid, place) but the first of its equals, with that first one."""
    order = ["hash", "doc_id", "uid", "place"]
    matched = materialise(
        places.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _neighbours,
            f"hash long, uid long, place int, head_uid long, head_place int, more boolean, doc_id {kind}, border boolean",
        ),
        name,
    )
    # at most two borders a partition: heads of groups that a partition's edge has cut
    borders = matched.where("border").select("hash", "doc_id", "uid", "place").distinct()
    heads = borders.groupBy("hash").agg(F.min(F.struct("doc_id", "uid", "place")).alias("h"))
    # a border is the first of its partition only, so the rows of its group take the first of all partitions
    found = matched.join(F.broadcast(heads), "hash", "left").select(
        "uid", "place", F.coalesce("h.uid", "head_uid").alias("head_uid"),
        F.coalesce("h.place", "head_place").alias("head_place"), "more",
    )
    return found.where("uid != head_uid or place != head_place")


def _chained(rows, how: Suffixes) -> list[tuple[int, int, int, int]]:
    """Runs (first place, last place, head, head's first place) of a document's matches: neighbours that
    match the same head at the same distance."""
    runs: list[list[int]] = []
    for place, uid, head in sorted({(r["place"], r["head_uid"], r["head_place"]) for r in rows}, key=lambda r: (r[1], r[2] - r[0], r[0])):
        if runs:
            a, b, owner, start = runs[-1]
            if owner == uid and start - a == head - place and place - b <= how.window:
                runs[-1][1] = place
                continue
        runs.append([place, place, uid, head])
    return [tuple(r) for r in runs]


def _runs(batches, how: Suffixes):
    for batch in batches:
        for uid, rows in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
            runs = _chained(rows, how)
            yield pa.RecordBatch.from_arrays(
                [pa.array([uid] * len(runs), pa.int64()), *(pa.array([r[i] for r in runs], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int32())))],
                ["uid", "first", "last", "head_uid", "head_first"],
            )


def _contexts(batches, how: Suffixes):
    """Words around the wanted runs of each head document: as many on either side as a repeat needs."""
    reach = how.least
    for batch in batches:
        for uid, text, wanted in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), strict=True):
            words, _ = word_hashes([text])
            words = words.view(np.int64)
            lefts = [words[max(0, w["head_first"] - reach) : w["head_first"]] for w in wanted]
            ends = [w["head_first"] + w["span"] + how.prefix for w in wanted]
            rights = [words[e : e + reach] for e in ends]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uid] * len(wanted), pa.int64()), pa.array([w["head_first"] for w in wanted], pa.int32()),
                    pa.array([w["span"] for w in wanted], pa.int32()),
                    pa.array([x.tobytes() for x in lefts], pa.binary()), pa.array([x.tobytes() for x in rights], pa.binary()),
                ],
                ["head_uid", "head_first", "span", "left", "right"],
            )


def _extended(words: np.ndarray, runs, how: Suffixes) -> list[tuple[int, int]]:
    """Spans that a document shares with one earlier document each, as [first, after last) words."""
    spans = []
    for run in runs:
        a, b = run["first"], run["last"] + how.prefix
        left, right = (np.frombuffer(run[side], np.int64) for side in ("left", "right"))
        n = min(a, len(left))
        unlike = np.flatnonzero(words[a - n : a][::-1] != left[len(left) - n :][::-1])
        a -= int(unlike[0]) if len(unlike) else n
        n = min(len(words) - b, len(right))
        unlike = np.flatnonzero(words[b : b + n] != right[:n])
        b += int(unlike[0]) if len(unlike) else n
        if b - a >= how.least:
            spans.append((a, b))
    return spans


def _open(words: np.ndarray, places: np.ndarray, spans, how: Suffixes) -> np.ndarray:
    """Where the windows of `least` words begin that have one of the suffixes near their start and lie in no
    span: another document than the spans' may hold them too."""
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.maximum(0, places - how.window + 1), 1)
    np.add.at(edges, places + 1, -1)
    wanted = np.cumsum(edges)[: max(0, len(words) - how.least + 1)] > 0
    for a, b in spans:
        wanted[a : b - how.least + 1] = False
    return np.flatnonzero(wanted)


def _spans_and_windows(batches, how: Suffixes):
    """Spans of each document's runs (their first and end), and its open windows by hash (no end)."""
    for batch in in_slices(batches, 1 << 19):
        uids, docs, texts, runs, open_places = (batch.column(i) for i in range(5))
        words, starts = word_hashes(texts.to_pylist())
        hashes, rows, places, ends = [], [], [], []
        for row, (found, at) in enumerate(zip(runs.to_pylist(), open_places.to_pylist(), strict=True)):
            own = words[starts[row] : starts[row + 1]]
            spans = _extended(own.view(np.int64), found or [], how)
            near = _open(own, np.array(at or [], np.int64), spans, how)
            hashes += [np.zeros(len(spans), np.int64), run_hashes(own, how.least)[near].view(np.int64)]
            rows.append(np.full(len(spans) + len(near), row))
            places += [np.array([a for a, _ in spans], np.int32), near.astype(np.int32)]
            ends += [np.array([b for _, b in spans], np.int32), np.zeros(len(near), np.int32)]
        if rows:
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(hashes)), docs.take(take), uids.take(take),
                    pa.array(np.concatenate(places)), pa.array(np.concatenate(ends)),
                ],
                ["hash", "doc_id", "uid", "place", "end"],
            )


def repeats(df: DataFrame, text: str = "text", key: str = "doc_id", how: Suffixes = Suffixes()) -> DataFrame:
    """`df` with the repeated passages cut from `text`, and with n_words, n_cut and cut_spans.

    A passage of `least` words or more that also stands in a document of lesser key (null keys first; equal
    keys by hash) is cut; the first document keeps its own. Repeats within one document stay, and
    rows equal in key and text count as one document. Words are told apart by 64-bit hashes. Null, empty and shorter texts stay as they are; every row stays. Columns of
    `df` that have the result's names give way to it. An empty table gives an empty result.
    """
    made = ("n_words", "n_cut", "cut_spans")
    kept = [c for c in df.columns if c.lower() not in made]
    rows = clean(df, doc_id=key, text=text).select(F.xxhash64("doc_id", "text").alias("uid"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    sampled = materialise(
        rows.mapInArrow(lambda b: _sampled(b, how), f"hash long, doc_id {kind}, uid long, place int"), "suffixes"
    )
    pairs = _with_first(sampled, kind, "neighbours")
    runs = materialise(
        pairs.where("uid != head_uid").groupBy("uid").agg(F.collect_list(F.struct("place", "head_uid", "head_place")).alias("m"))
        .mapInArrow(lambda b: _runs(b, how), "uid long, first int, last int, head_uid long, head_first int"),
        "runs",
    )
    keyed = df.select(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("uid"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)))
    at = kept.index(text)
    spanned = runs.withColumn("span", F.expr("last - first"))
    wanted = spanned.select("head_uid", "head_first", "span").distinct().groupBy("head_uid").agg(
        F.collect_list(F.struct("head_first", "span")).alias("wanted")
    )
    around = keyed.join(wanted, keyed["uid"] == wanted["head_uid"]).select("uid", f"c{at}", "wanted").mapInArrow(
        lambda b: _contexts(b, how), "head_uid long, head_first int, span int, left binary, right binary"
    )
    around = materialise(around.dropDuplicates(["head_uid", "head_first", "span"]), "contexts")
    lists = spanned.join(around, ["head_uid", "head_first", "span"]).groupBy("uid").agg(
        F.collect_list(F.struct("first", "last", "left", "right")).alias("runs")
    )
    places = pairs.where("more").groupBy("uid").agg(F.collect_set("place").alias("open"))
    found = keyed.join(lists.join(places, "uid", "full"), "uid").select(
        "uid", F.col(f"c{kept.index(key)}").alias("doc_id"), F.col(f"c{at}").alias("text"), "runs", "open"
    )
    found = materialise(
        found.mapInArrow(lambda b: _spans_and_windows(b, how), f"hash long, doc_id {kind}, uid long, place int, end int"), "spans"
    )
    windows = _with_first(found.where("end = 0").drop("end"), kind, "windows").where("uid != head_uid")
    spans = found.where("end > 0").select("uid", F.col("place").alias("first"), "end").unionByName(
        windows.select("uid", F.col("place").alias("first"), (F.col("place") + how.least).alias("end"))
    )
    spans = spans.groupBy("uid").agg(F.collect_set(F.struct("first", "end")).alias("gone"))
    whole = keyed.join(spans, "uid", "left").drop("uid")

    def cut(batches):
        for batch in in_slices(batches):
            texts, cuts, spans = batch.column(at).to_pylist(), [], []
            words = word_counts(texts)
            for row, found in enumerate(batch.column(len(kept)).to_pylist()):
                gone = joined((s["first"], s["end"]) for s in found or [])
                if gone:
                    texts[row] = cut_words(texts[row], gone)
                cuts.append(sum(b - a for a, b in gone))
                spans.append([{"first": a, "end": b} for a, b in gone])
            columns = batch.columns[: len(kept)]
            columns[at] = pa.array(texts, columns[at].type)
            span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(words, pa.int64()), pa.array(cuts, pa.int64()), pa.array(spans, span)],
                [*(f"c{i}" for i in range(len(kept))), *made],
            )

    schema = ", ".join(f"c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(kept))
    out = whole.mapInArrow(cut, f"{schema}, n_words long, n_cut long, cut_spans array<struct<first:int,end:int>>")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), *made)
