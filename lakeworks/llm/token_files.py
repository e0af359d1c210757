"""Token files: ids as Parquet list columns, written for selective reads.

A token store is a folder with `ids` (one row per document, in ascending order of its key, the ids as a
dictionary or delta encoded list column, small row groups, page indexes) and `shards` (one row per
file: its number, its documents, the ids before it). A document's offset is its file's plus its own, so
writing needs no count before the ids are made.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm.known import Known
from lakeworks.llm.texts import clean, in_slices, list_column

#: Layouts of the id column. Dictionary pages bit-pack ids by how many differ in a row group; delta pages
#: suit ids that rise.
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.writer.version": "v1"},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "v2"},
}


@lru_cache(maxsize=2)
def tokenizer_at(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Where the ASCII of a text cannot be lowered before the library does: marks join letters, special strings differ by case.
_AS_IS = r"\p{M}|<\|"
#: Latin letters that stay one letter in lower case (so not I with a dot), and stops, which no word goes on over.
_LETTER_AND_STOP = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}])([.,;:!?])"


def cut_rows(texts: pa.Array) -> pa.ListArray:
    """Each text (null: empty) as parts that the file's rules never look across, plain letters in lower case."""
    texts = pc.fill_null(texts, "")
    texts = pc.if_else(pc.match_substring_regex(texts, _AS_IS), texts, pc.ascii_lower(texts))
    texts = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), _LETTER_AND_STOP, r"\1 \2")
    return pc.split_pattern(texts, " ")


class Encoder:
    """Ids of texts by the library, each different word once.

    The file's words end at blanks and between a letter and a stop, so a text is cut there, and the cut words of a
    batch are numbered by Arrow. Words that are not known yet go to the library, runs of letters many at a time: ids
    that end a word part them again. All known ids lie in one array, from which a batch's ids are gathered.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        self.tokenizer = tokenizer_at(path)
        mark = json.loads(self.tokenizer.to_str())["model"]["end_of_word_suffix"]
        ids = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(ids.values()) + 1, bool)
        self.ends_word[[i for token, i in ids.items() if token.endswith(mark)]] = True
        self.known = Known(self._teach, np.uint16 if len(self.ends_word) <= 1 << 16 else np.uint32, most)

    def _each(self, runs: list[str]) -> None:
        for at in range(0, len(runs), 1000):
            some = runs[at : at + 1000]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            self.known.keep(some, [len(f) for f in found], [i for f in found for i in f])

    def _words(self, words: list[str]) -> None:
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(some):
                self.known.keep(some, np.diff(ends, prepend=0), ids)
            else:  # a letter that the file's rules do not take for one
                self._each(some)

    def _teach(self, words: list[str]) -> None:
        self._words([w for w in words if w.isalpha()])
        self._each([w for w in words if not w.isalpha()])

    def batch(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), each text's with `end` behind them, and how many each has."""
        return self.known.rows(cut_rows(texts), end)

    def __call__(self, texts: list[str | None], end: int) -> list[bytes]:
        ids, sizes = self.batch(pa.array(texts, pa.string()), end)
        ends = np.cumsum(sizes)
        return [ids[b - n : b].astype("<u4").tobytes() for b, n in zip(ends, sizes, strict=True)]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_token_store(
    df: DataFrame,
    where: str,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    end: int = 2,
    encoding: str = "dictionary",
    row_group_bytes: int = 8 << 20,
    rows_per_page: int = 1000,
) -> None:
    """Encode `text` (null: empty) with the file at `tokenizer`, append `end`, and write the store.

    Rows are in ascending order of `key`, null keys first, equal keys by a hash of the text and as they come; every row
    is kept, so repeated rows are written as often as they come. A key with very many rows fills several files. An empty
    table makes an empty store.
    """
    spark = df.sparkSession

    def encoded(batches):
        encode = encoder(tokenizer)
        before = 0
        for batch in in_slices(batches, 4 << 20):
            ids, sizes = encode.batch(batch.column(1), end)
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(starts),
                    pa.array(sizes),
                    list_column(ids, sizes),
                ],
                ["doc_id", "shard_start", "n_tokens", "ids"],
            )

    rows = clean(df, doc_id=key, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("turn"))
    made = (
        rows.repartitionByRange("doc_id", "hash", "turn")
        .sortWithinPartitions("doc_id", "hash", "turn")
        .select("doc_id", "text")
        .mapInArrow(encoded, f"doc_id {kind}, shard_start long, n_tokens long, ids array<int>")
        .withColumn("shard", F.spark_partition_id())
    )
    options = {
        **ENCODINGS[encoding],
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.row.count.limit": str(rows_per_page),
        "compression": "zstd",
    }
    made.write.options(**options).parquet(f"{where}/ids")
    shards = (
        spark.read.parquet(f"{where}/ids").groupBy("shard").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n"))
    )
    counted = sorted(tuple(r) for r in shards.collect())  # one row for each file
    totals, before = [], 0
    for shard, docs, tokens in counted:
        totals.append((shard, docs, before))
        before += tokens
    spark.createDataFrame(totals, "shard int, n_docs long, ids_before long").coalesce(1).write.parquet(f"{where}/shards")


def read_tokens(spark: SparkSession, where: str, columns: tuple[str, ...] = ("ids",)) -> DataFrame:
    """The store's rows: doc_id, start (ids of all documents before), n_tokens and the wanted columns.

    Without `ids` only the small columns are read; a filter on doc_id skips files, row groups and pages.
    """
    rows = spark.read.parquet(f"{where}/ids").select("doc_id", "shard", "shard_start", "n_tokens", *columns)
    shards = spark.read.parquet(f"{where}/shards").select("shard", "ids_before")
    return rows.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("ids_before") + F.col("shard_start")).alias("start"), "n_tokens", *columns
    )


def list_crc32(ids: pa.ListArray) -> list[int]:
    """The checksum of each list of 32-bit ids as little-endian bytes."""
    raw = memoryview(ids.values.to_numpy().astype("<i4", copy=False)).cast("B")
    ends = (ids.offsets.to_numpy().astype(np.int64) * 4).tolist()
    return [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def with_crc32(tokens: DataFrame) -> DataFrame:
    """The checksum of each row's ids as little-endian unsigned 32-bit numbers, instead of the ids."""
    kept = [c for c in tokens.columns if c != "ids"]

    def summed(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            crc = list_crc32(ids)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(crc, pa.int64())],
                [*kept, "ids_crc32"],
            )

    schema = ", ".join(f"{c} {tokens.schema[c].dataType.simpleString()}" for c in kept)
    return tokens.mapInArrow(summed, f"{schema}, ids_crc32 long")
