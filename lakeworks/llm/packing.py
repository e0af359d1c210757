"""Training sequences of one size, filled from several sources to a target mixture.

Every source (of those that matter; the rest share one) is a queue of tokens. A deficit round-robin deals the room of each
window: every window adds to a queue's credit what the target gives it, a queue is served in grains as far
as its credit goes, what it was not served stays as deficit for the next window, and the last grains of a
window go to the largest deficits. Over one period of windows all deficits come back to zero, so a period's deal can be
repeated as long as no queue ends; then the shares of those left are dealt anew. So the deal is a short list
of phases, made from nothing but the queues' totals, and says of any token of a queue in which window it lies:
partitions pack their own documents, each entering the round where the partitions before it have left it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.texts import clean, in_slices, list_column
from lakeworks.llm.token_files import encoder, list_crc32
from lakeworks.runtime import materialise

#: Offsets of so many (partition, queue) pairs, of 20 bytes each, are broadcast; more are joined by a shuffle.
SMALL = 1_000_000


@dataclass(frozen=True)
class Windows:
    """Sequences have `size` tokens and are dealt in grains; `period` windows bring all deficits back to zero. There
    are `queues` at most: the sources with the most rows, and one for all the others."""

    size: int = 2048
    grain: int = 64
    period: int = 64
    queues: int = 64

    def __post_init__(self):
        if self.size % self.grain or self.queues > self.size // self.grain * self.period:
            raise ValueError("the grain must divide the size, and a period must hold a grain of every queue")


@dataclass(frozen=True)
class Phase:
    """A deal of `windows` windows from window `first` on, `times` times: served[w, q] tokens."""

    first: int
    times: int
    served: np.ndarray


def _quotas(shares: list[float], units: int) -> list[int]:
    """Whole units in proportion to the shares, one at least where there is a share."""
    total, live = sum(shares), sum(s > 0 for s in shares)
    exact = [(units - live) * s / total for s in shares]
    out = [int(e) + (s > 0) for e, s in zip(exact, shares, strict=True)]
    rest = sorted(range(len(shares)), key=lambda q: (int(exact[q]) - exact[q], q))
    for q in rest[: units - sum(out)]:
        out[q] += 1
    return out


def _period(quota: list[int], windows: int, room: int) -> np.ndarray:
    """Grains that each queue is served in each window; the quotas are grains a period and fill its windows."""
    served, credit = np.zeros((windows, len(quota)), np.int64), list(quota)
    for w in range(windows):
        left = room
        for turn in range(len(quota)):
            q = (w + turn) % len(quota)
            grains = min(max(credit[q], 0) // windows, left)
            served[w, q] = grains
            credit[q] -= grains * windows
            left -= grains
        for _ in range(left):
            q = max(range(len(quota)), key=lambda i: (credit[i], -i))
            served[w, q] += 1
            credit[q] -= windows
        credit = [c + n for c, n in zip(credit, quota, strict=True)]
    return served


def deal(totals: list[int], weights: list[float] | None, how: Windows) -> list[Phase]:
    """The phases that serve all tokens of all queues. Without weights each queue's share is what it has left, so
    that all end together. Tokens that do not fill a last window make windows of powers of two, which need no padding."""
    left, first, out = list(totals), 0, []
    while any(left):
        shares = [(weights[q] if weights else n) if n else 0 for q, n in enumerate(left)]
        if not any(shares):
            shares = [float(n > 0) for n in left]  # only queues that the target gives nothing
        quota = _quotas(shares, how.size // how.grain * how.period)
        able = [q for q, n in enumerate(quota) if n]
        times = min(left[q] // (quota[q] * how.grain) for q in able)
        if times:
            served = _period(quota, how.period, how.size // how.grain) * how.grain
            left = [n - times * int(s) for n, s in zip(left, served.sum(0), strict=True)]
            out.append(Phase(first, times, served))
            first += times * how.period
            continue
        # a queue ends soon: window by window, until one has; queues without a share stand behind those with one
        rows, credit, total = [], [0.0] * len(left), sum(shares)
        while any(left) and (not rows or all(left[q] for q in able)):
            room = min(how.size, 1 << (sum(left).bit_length() - 1))
            row = [0] * len(left)
            credit = [c + room * s / total for c, s in zip(credit, shares, strict=True)]
            while room:
                pool = [q for q in able if left[q]] or [q for q, n in enumerate(left) if n]
                q = max(pool, key=lambda i: (credit[i], -i))
                n = min(how.grain, left[q], room)
                row[q] += n
                left[q] -= n
                credit[q] -= n
                room -= n
            rows.append(row)
        out.append(Phase(first, 1, np.array(rows, np.int64)))
        first += len(rows)
    return out


class Track:
    """One queue's slices in the order of its tokens: slot i holds the tokens from `begin(i)` on, of one window."""

    def __init__(self, phases: list[Phase], queue: int):
        self.phases, start, slot = [], 0, 0
        for phase in phases:
            own = phase.served[:, queue]
            at = np.flatnonzero(own)
            if not len(at):
                continue
            before = phase.served[:, :queue].sum(1)[at]
            ends = np.concatenate(([0], np.cumsum(own[at])))
            self.phases.append((start, slot, phase.first, len(own), ends, at, before))
            start += phase.times * int(ends[-1])
            slot += phase.times * len(at)
        self.starts = np.array([p[0] for p in self.phases], np.int64)
        self.slots = np.array([p[1] for p in self.phases], np.int64)

    def slot_of(self, token: np.ndarray) -> np.ndarray:
        out, which = np.zeros(len(token), np.int64), np.searchsorted(self.starts, token, "right") - 1
        for k in np.unique(which).tolist():
            start, slot, _, _, ends, _, _ = self.phases[k]
            here = which == k
            turn, rest = np.divmod(token[here] - start, ends[-1])
            out[here] = slot + turn * (len(ends) - 1) + np.searchsorted(ends, rest, "right") - 1
        return out

    def slices(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First token and the one after the last, window and offset there, of each slot."""
        out = np.zeros((4, len(slots)), np.int64)
        which = np.searchsorted(self.slots, slots, "right") - 1
        for k in np.unique(which).tolist():
            start, slot, first, windows, ends, at, before = self.phases[k]
            here = which == k
            turn, i = np.divmod(slots[here] - slot, len(at))
            base = start + turn * ends[-1]
            out[:, here] = base + ends[i], base + ends[i + 1], first + turn * windows + at[i], before[i]
        return tuple(out)


def pieces(track: Track, begins: np.ndarray, sizes: np.ndarray):
    """Where the tokens begins .. begins + sizes of a queue lie: row, start within the row, length, window, offset."""
    first, last = track.slot_of(begins), track.slot_of(begins + sizes - 1)
    count = last - first + 1
    row = np.repeat(np.arange(len(begins)), count)
    slot = np.repeat(first, count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    a, b, window, offset = track.slices(slot)
    own = begins[row]
    start = np.maximum(a, own)
    return row, start - own, np.minimum(b, own + sizes[row]) - start, window, offset + start - a


def _packed_ids(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Rows of ids as bytes, two or four for each id."""
    offsets = np.concatenate(([0], np.cumsum(sizes))) * ids.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)])


def _tokens(batches, path: str, end: int):
    """Ids of every row with `end` behind them, and how many tokens of its queue the partition has before it."""
    encode, before = encoder(path), {}
    for batch in in_slices(batches, 2 << 20):
        ids, sizes = encode.batch(batch.column(2), end)
        queues, places = batch.column(1).to_numpy(), np.zeros(batch.num_rows, np.int64)
        for q in np.unique(queues).tolist():
            own = queues == q
            through = np.cumsum(sizes[own]) + before.get(q, 0)
            places[own] = through - sizes[own]
            before[q] = int(through[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(places), pa.array(sizes), _packed_ids(ids.astype(encode.known.dtype), sizes)],
            ["doc_id", "queue", "place", "n_tokens", "ids"],
        )


def _packed(batches, tracks: list[Track], with_ids: bool):
    for batch in in_slices(batches, 2 << 20):
        queues, places, sizes, offsets, ids = (batch.column(i) for i in range(1, 6))
        queues, sizes = queues.to_numpy(), sizes.to_numpy()
        begins, found = places.to_numpy() + offsets.to_numpy(), []
        for q in np.unique(queues).tolist():
            rows = np.flatnonzero(queues == q)
            row, *rest = pieces(tracks[q], begins[rows], sizes[rows])
            found.append((rows[row], *rest))
        row, start, length, window, offset = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((start, row))
        row, start, length, window, offset = (x[order] for x in (row, start, length, window, offset))
        # pieces in the order of rows and tokens: together they are the rows' ids as they stand
        at = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
        width = int(at[-1] - at[0]) // int(sizes.sum())
        numbers = np.frombuffer(ids.buffers()[2], f"<u{width}", int(sizes.sum()), int(at[0])).astype(np.int32)
        rows = list_column(numbers, length)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(sizes[row]),
                pa.array(queues[row]), pa.array(window), pa.array(offset), rows if with_ids else pa.array(list_crc32(rows), pa.int64()),
            ],
            ["doc_id", "start", "length", "doc_tokens", "queue", "sequence_id", "offset", "ids" if with_ids else "ids_crc32"],
        )


def pack(
    df: DataFrame,
    tokenizer: str,
    target: Mapping[str, float] | None = None,
    how: Windows = Windows(),
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    end: int = 1,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents in sequences: doc_id, start (the document's ids before the piece), length, doc_tokens, queue,
    sequence_id, offset and ids, or their checksum instead (`ids_crc32`, of little-endian 32-bit numbers). Every id, `end`
    behind each document's own among them, lies in exactly one piece.

    `target` names the wanted shares of sources; all sources that it does not name share one queue, which gets what the shares
    leave of 1 (nothing at all: it comes after the others). Without it a source's share is what it has. Sources beyond
    `queues` and null ones share the queue 0. A null or empty text is its end alone; repeated rows are packed as
    often as they come, null keys too; an empty table gives an empty result.
    """
    rows = clean(df, doc_id=key, source=source, text=text).withColumn("source", F.col("source").cast("string"))
    if target is None:
        largest = rows.where("source is not null").groupBy("source").count().orderBy(F.desc("count"), "source")
        names = [r.source for r in largest.limit(how.queues - 1).collect()]
        weights = None
    else:
        names = list(target)
        weights = [max(0.0, 1.0 - sum(target.values())), *target.values()]
    if len(names) >= how.queues:
        raise ValueError(f"{len(names)} sources have shares, but there are only {how.queues - 1} queues for them")
    queue = F.array_position(F.array(*map(F.lit, names)).cast("array<string>"), F.col("source"))
    queued = rows.select("doc_id", F.coalesce(queue, F.lit(0)).cast("int").alias("queue"), "text")
    kind = queued.schema["doc_id"].dataType.simpleString()
    made = queued.mapInArrow(
        lambda b: _tokens(b, tokenizer, end), f"doc_id {kind}, queue int, place long, n_tokens long, ids binary"
    )
    # small row groups: the writer holds one for each task
    sparse = {"parquet.block.size": str(8 << 20), "compression": "zstd"}
    tokens = materialise(made.withColumn("part", F.spark_partition_id()), "packing", **sparse)
    sums = materialise(tokens.groupBy("queue", "part").agg(F.sum("n_tokens").alias("n")), "packing-sums")
    totals, pairs = [0] * (len(names) + 1), 0
    for r in sums.groupBy("queue").agg(F.sum("n").alias("n"), F.count("*").alias("parts")).collect():  # a row a queue
        totals[r.queue], pairs = r.n, pairs + r.parts
    tracks = [Track(phases, q) for phases in [deal(totals, weights, how)] for q in range(len(totals))]
    running = F.expr("sum(n) over (partition by queue order by part rows between unbounded preceding and current row) - n")
    offsets = sums.select("queue", "part", running.alias("offset"))
    placed = tokens.join(F.broadcast(offsets) if pairs <= SMALL else offsets, ["queue", "part"])
    return placed.select("doc_id", "queue", "place", "n_tokens", "offset", "ids").mapInArrow(
        lambda b: _packed(b, tracks, with_ids),
        f"doc_id {kind}, start long, length long, doc_tokens long, queue int, sequence_id long, offset long, "
        + ("ids array<int>" if with_ids else "ids_crc32 long"),
    )


def sequences(packed: DataFrame, how: Windows = Windows(), padding: int = 0) -> DataFrame:
    """The ids of each sequence (sequence_id, ids, n_tokens), padded to the size unless their number is a power of two."""
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]))
    whole = packed.groupBy("sequence_id").agg(ids.alias("ids")).withColumn("n_tokens", F.size("ids"))
    short = (F.col("n_tokens") < how.size) & (F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) != 0)
    gap = F.array_repeat(F.lit(padding), F.when(short, how.size - F.col("n_tokens")).otherwise(0))
    return whole.select("sequence_id", F.concat("ids", gap).alias("ids"), "n_tokens")
