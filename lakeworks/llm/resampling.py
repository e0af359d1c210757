"""Importance resampling towards a target distribution, on hashed words and word pairs.

Every run of one or two words is a feature, its CRC-32 modulo the number of buckets its bucket (`position_crc`).
A bucket's gain is the log ratio of its smoothed shares in the target and in the corpus; a row's weight is the mean
gain of its features. Weights with Gumbel noise from a digest of the key are drawn without replacement by taking
the highest, so every row has its chance and no run differs from another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.position_crc import word_and_pair_crcs
from lakeworks.llm.texts import WORD_BYTES, clean, in_slices
from lakeworks.runtime import materialise

#: Bytes of a text that are looked at together; a longer text has several pieces.
PIECE = 1 << 20
_ENDED = WORD_BYTES[:10] + b" " + WORD_BYTES[11:]


@dataclass(frozen=True)
class Draw:
    """`percent` of the rows with `least_words` words or more are drawn."""

    buckets: int = 10_000
    percent: int = 25
    least_words: int = 20
    seed: int = 7
    scale: int = 1000


def _compact(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of many texts, each with one blank behind it; where they end; and where in `raw` each ended.
    `raw` has blanks between words, a blank at its end, and line breaks where texts end."""
    codes = np.frombuffer(raw, np.uint8)
    word = codes > 32
    behind = np.concatenate(([False], word[:-1])) & ~word
    kept = codes[word | behind].copy()
    kept[kept <= 32] = 32
    return kept, np.flatnonzero(kept == 32), np.flatnonzero(behind)


def _pieces(raw: bytes) -> Iterator[tuple[bytes, bool]]:
    """Parts of one long text cut between words, each but the first with the last word of the one before in front;
    and whether it is the last."""
    at, held = 0, b""
    while True:
        end = at + PIECE
        if end < len(raw):
            cut = raw.rfind(b" ", at, end)
            cut = cut if cut >= 0 else raw.find(b" ", end)
        else:
            cut = -1
        if cut < 0:
            yield held + raw[at:] + b" \n", True
            return
        part = held + raw[at : cut + 1]
        body = part.rstrip(b" ")
        held = body[body.rfind(b" ") + 1 :] + b" " if body else b""
        yield part, False
        at = cut + 1


def _long(raw: bytes, buckets: int) -> tuple[int, list[np.ndarray]]:
    """Words and feature buckets of one long text."""
    n, out, first = 0, [], True
    for part, end in _pieces(raw):
        codes, ends, _ = _compact(part)
        if len(ends):
            last = np.zeros(len(ends), bool)
            last[-1] = True  # its pair is found with the next piece
            single, pair = word_and_pair_crcs(codes, ends, last)
            new = single if first else single[1:]  # the first word was the last one of the piece before
            out += [new % buckets, pair[~last] % buckets]
            n, first = n + len(new), False
    return n, out


def feature_buckets(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and features of each text, and the buckets of all features, text by text."""
    raws = [t.encode().translate(_ENDED) if t else b"" for t in texts]
    n_words, parts, at = np.zeros(len(raws), np.int64), [], 0
    while at < len(raws):
        to, size = at, 0
        while to < len(raws) and (to == at or size + len(raws[to]) <= PIECE):
            size += len(raws[to])
            to += 1
        if size > PIECE:  # one long text
            n_words[at], found = _long(raws[at], buckets)
            parts += found
            at = to
            continue
        codes, ends, stood = _compact(b"\n".join([*raws[at:to], b""]))
        borders = np.cumsum([len(r) + 1 for r in raws[at:to]]) - 1
        through = np.searchsorted(stood, borders, "right")  # words up to each text's end
        own = np.diff(np.concatenate(([0], through)))
        n_words[at:to] = own
        last = np.zeros(len(ends), bool)
        last[through[own > 0] - 1] = True
        if len(ends):
            single, pair = word_and_pair_crcs(codes, ends, last)
            both = np.empty((len(ends), 2), np.uint32)
            both[:, 0], both[:, 1] = single % buckets, pair % buckets
            wanted = np.ones((len(ends), 2), bool)
            wanted[:, 1] = ~last
            parts.append(both[wanted])
        at = to
    sizes = np.maximum(0, 2 * n_words - 1)
    return n_words, sizes, np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _features(batches, how: Draw, at: int):
    """The batch's columns, its words and the buckets of its features."""
    kind = _kind(how.buckets)
    for batch in in_slices(batches, PIECE):
        n_words, sizes, found = feature_buckets(batch.column(at).to_pylist(), how.buckets)
        offsets = np.concatenate(([0], np.cumsum(sizes))) * np.dtype(kind).itemsize
        # 64-bit offsets: texts of one batch may have more than 2 GB of features
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(found.astype(kind))]
        )
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(n_words), packed.cast(pa.binary())], [*batch.schema.names, "n_words", "buckets"]
        )


def _counted(batches, how: Draw):
    """One row for each bucket that a partition has features in."""
    kind, total = _kind(how.buckets), np.zeros(how.buckets, np.int64)
    for batch in batches:
        for packed in batch.column(0):
            data = packed.as_buffer()
            if data:
                total += np.bincount(np.frombuffer(data, kind), minlength=how.buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])


def bucket_counts(features: DataFrame, how: Draw) -> dict[int, int]:
    """Features in each bucket, over all rows: `buckets` numbers at most, added up before they come to the driver."""
    parts = features.select("buckets").mapInArrow(lambda b: _counted(b, how), "bucket long, n long")
    return {r.bucket: r.n for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(corpus: dict[int, int], target: dict[int, int], how: Draw) -> np.ndarray:
    """The gain of every bucket, as a whole number of 1/scale."""
    of_corpus, of_target = float(sum(corpus.values()) + how.buckets), float(sum(target.values()) + how.buckets)

    def gain(b: int) -> int:
        ratio = (target.get(b, 0) + 1.0) * of_corpus / ((corpus.get(b, 0) + 1.0) * of_target)
        return math.floor(how.scale * math.log(ratio))

    return np.array([gain(b) for b in range(how.buckets)], np.int64)


def _weighed(batches, gain: np.ndarray, how: Draw):
    kind = _kind(how.buckets)
    for batch in in_slices(batches, 4 * PIECE):
        packed = batch.column(batch.schema.get_field_index("buckets"))
        sizes, sums = np.zeros(len(packed), np.int64), np.zeros(len(packed), np.int64)
        for i, one in enumerate(packed):
            found = np.frombuffer(one.as_buffer(), kind)
            sizes[i], sums[i] = len(found), gain[found].sum()
        names = [n for n in batch.schema.names if n != "buckets"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(batch.schema.get_field_index(n)) for n in names), pa.array(sizes), pa.array(sums // np.maximum(sizes, 1))],
            [*names, "n_features", "weight"],
        )


def _numbered(batches):
    """Rows of a sorted partition with their place in it, from 1 on."""
    at = 0
    for batch in batches:
        places = np.arange(at + 1, at + 1 + batch.num_rows)
        at += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "place"])


def _schema(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *more])


def _ranked(df: DataFrame, target: DataFrame, how: Draw, text: str, key: str, target_text: str) -> DataFrame:
    """uid, doc_id, n_words, n_features, weight, score, rank; uid numbers the rows of `df` as they come."""
    rows = clean(df, doc_id=key, text=text).withColumn("uid", F.monotonically_increasing_id())
    made = rows.mapInArrow(lambda b: _features(b, how, 1), _schema(rows, "n_words long", "buckets binary"))
    features = materialise(made.drop("text"), "features")
    others = clean(target, text=target_text)
    wanted = others.mapInArrow(lambda b: _features(b, how, 0), _schema(others, "n_words long", "buckets binary"))
    gain = gains(bucket_counts(features, how), bucket_counts(wanted, how), how)
    weighed = features.mapInArrow(
        lambda b: _weighed(b, gain, how), _schema(features.drop("buckets"), "n_features long", "weight long")
    )
    digest = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-how.scale) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = materialise(
        weighed.withColumn("score", F.col("weight") + noise).withColumn("short", F.col("n_words") < how.least_words), "weights"
    )
    order = [F.col("short"), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("uid")]
    in_order = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(
        in_order.mapInArrow(_numbered, _schema(scored, "place long")).withColumn("part", F.spark_partition_id()), "ranks"
    )
    # one row a partition
    counts = sorted(tuple(r) for r in placed.groupBy("part").agg(F.count("*"), F.count_if(~F.col("short"))).collect())
    before, offsets = 0, []
    for part, n, _ in counts:
        offsets.append((part, before))
        before += n
    drawn = how.percent * sum(c[2] for c in counts) // 100
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, "part int, before long"))
    rank = F.col("before") + F.col("place")
    return placed.join(starts, "part").select(
        "uid", "doc_id", "n_words", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank")
    )


def ranked(
    df: DataFrame, target: DataFrame, how: Draw = Draw(), text: str = "text", key: str = "doc_id", target_text: str = "text"
) -> DataFrame:
    """Per row of `df`: doc_id, n_words, n_features, weight, score and, if it is drawn, its rank (else null).

    Rows are drawn by falling score, ties by lesser key (null first), then in the order of the input; rows with too few words
    are not drawn. A row without words has weight 0; a null key counts as the empty one in the noise. Repeated rows
    are rows of their own. An empty target counts as one without preferences beyond smoothing; an empty `df` gives an
    empty result.
    """
    return _ranked(df, target, how, text, key, target_text).drop("uid")


def drawn(
    df: DataFrame, target: DataFrame, how: Draw = Draw(), text: str = "text", key: str = "doc_id", target_text: str = "text"
) -> DataFrame:
    """The drawn rows of `df` with weight, score and rank; columns of `df` with these names give way."""
    made = ("weight", "score", "rank")
    kept = [c for c in df.columns if c.lower() not in made]
    rows = materialise(df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept))), "rows")
    numbers = _ranked(rows, target, how, f"c{kept.index(text)}", f"c{kept.index(key)}", target_text).where("rank is not null")
    marked = rows.withColumn("uid", F.monotonically_increasing_id()).join(numbers.select("uid", *made), "uid")
    return marked.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), *made)
