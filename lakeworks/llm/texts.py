"""Helpers shared by the operators: names, tables, vocabulary files and Arrow columns."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a text by their role: A-Z in lower case; ASCII other than letters and digits parts words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def small_batches(spark: SparkSession) -> None:
    """Pass rows to Python in batches of a thousand where the session has Spark's default of ten thousand:
    rows hold whole texts, and a batch lies in memory on both sides."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """The same columns as c0, c1, ...: whatever they are called, they clash with nothing."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def clean(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: clashing extra columns are left behind."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def text_bytes(text: str | Column) -> Column:
    """UTF-8 bytes; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters (in lower case), ASCII digits and all characters beyond ASCII."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def word_places(text: str) -> list[tuple[int, int]]:
    """Where each word lies in the text's UTF-8 bytes."""
    return [m.span() for m in re.finditer(rb"[^ ]+", text.encode().translate(WORD_BYTES))]


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words [a, b) of each span and what stands between them."""
    raw, places, kept, at = text.encode(), word_places(text), [], 0
    for a, b in spans:
        kept.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def joined(spans) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap made one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def list_column(values: np.ndarray, sizes) -> pa.Array:
    """One list per row, from all values and each row's size, without copies."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _row_bytes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of each row; columns other than texts count by their mean."""
    total = np.zeros(batch.num_rows)
    for column in batch.columns:
        kind = column.type
        if pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) or pa.types.is_large_binary(kind):
            width = np.int64 if pa.types.is_large_string(kind) or pa.types.is_large_binary(kind) else np.int32
            offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1]
            total += np.diff(offsets)
        else:
            total += column.nbytes / batch.num_rows
    return total


def in_slices(batches: Iterator[pa.RecordBatch], most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of few enough bytes that what is made of them fits a small worker; a longer row is a batch of its own."""
    for batch in batches:
        if batch.nbytes <= most_bytes or batch.num_rows == 1:
            if batch.num_rows:
                yield batch
            continue
        through, start = np.cumsum(_row_bytes(batch)), 0
        while start < batch.num_rows:
            before = through[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(through, before + most_bytes, "right")))
            yield batch.slice(start, end - start)
            start = end


class Memo(dict):
    """Results by word, at most twice `most`: when full, what was not asked for since the last time goes."""

    def __init__(self, compute: Callable, most: int = 120_000):
        super().__init__()
        self.compute, self.most, self.older = compute, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) < 200:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
