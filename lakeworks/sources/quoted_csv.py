"""CSV files whose quoted values hold line breaks, read in as many tasks as they have ranges.

Spark's own reader gives such a file to one task, for a line break tells nothing before it is known whether it stands
inside quotes. Here files are read as lines, which split freely. What a line does to the state "inside quotes" is one
of four maps: it may keep it, turn it over, or leave it open or shut whatever it was. The maps of a range's
lines compose to one map, and a scan over each file's ranges tells in which state every range begins. Then each task
puts the records together that start in its range; pieces of a record on both sides of a border are joined, two
rows a range at most. Records are parsed by `from_csv`.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.runtime import materialise

#: Maps of the state: shut whatever it was, turned over, kept, open whatever it was.
SHUT, TURNED, KEPT, OPEN = 0, 1, 2, 3
#: Ranges that begin inside quotes are broadcast up to this number; more are joined by a shuffle.
FEW = 100_000

#: Options that are about whole files or rows and not for the parser of one record.
_OWN = {"header", "multiline", "mode", "inferschema", "samplingratio"}


def fits(options: dict) -> bool:
    """Whether these options describe files that lines can be told in: UTF-8, ASCII or ISO-8859-1, plain line breaks, a
    separator of one character, no comments."""
    low = {k.lower(): v for k, v in options.items()}
    encoding = str(low.get("encoding", low.get("charset", "UTF-8"))).upper()
    simple = encoding in ("UTF-8", "UTF8", "US-ASCII", "ISO-8859-1")
    sep, quote = str(low.get("sep", low.get("delimiter", ","))), str(low.get("quote", '"'))
    return simple and len(sep) == len(quote) == 1 and not {"comment", "linesep", "unescapedquotehandling"} & low.keys()


def _patterns(options: dict) -> tuple[str, str]:
    """What a line looks like that ends inside quotes: one that begins outside them, and one that begins inside.

    All loops are possessive: a line is run over once, and no stack grows with it."""
    low = {k.lower(): v for k, v in options.items()}
    s, q = (re.escape(str(low.get(n, d))) for n, d in (("sep", low.get("delimiter", ",")), ("quote", '"')))
    escape = str(low.get("escape", "\\"))
    body = rf"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    if escape != str(low.get("quote", '"')):
        e = re.escape(escape)
        body = rf"[^{q}{e}]*+(?:{e}[\s\S][^{q}{e}]*+)*+{e}?+"
    lead = r"[ \t]*+" if str(low.get("ignoreleadingwhitespace", "false")).lower() == "true" else ""
    field = rf"(?:{lead}{q}{body}{q}[^{s}]*+|(?!{lead}{q})[^{s}]*+)"
    opened = rf"(?:{field}{s})*+{lead}{q}{body}\z"
    return rf"\A{opened}", rf"\A(?:{body}\z|{body}{q}[^{s}]*+{s}{opened})"


def _runs(files: pa.Array, blocks: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of rows of the same range."""
    coded = files.dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((np.diff(coded) != 0) | (np.diff(blocks) != 0)) + 1
    edges = [0, *cuts.tolist(), len(blocks)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _composed(codes: np.ndarray) -> int:
    """One map for lines one after the other."""
    fixed = np.flatnonzero((codes == SHUT) | (codes == OPEN))
    after = codes[fixed[-1] + 1 :] if len(fixed) else codes
    turned = int((after == TURNED).sum()) & 1
    if len(fixed):
        return OPEN if (codes[fixed[-1]] == OPEN) ^ turned else SHUT
    return TURNED if turned else KEPT


def _states(codes: np.ndarray, inside: bool) -> np.ndarray:
    """Whether each line ends inside quotes, if the first begins so or not."""
    turns = np.cumsum(codes == TURNED)
    fixed = np.where((codes == SHUT) | (codes == OPEN), np.arange(len(codes)), -1)
    last = np.maximum.accumulate(fixed)
    base = np.where(last >= 0, codes[last] == OPEN, inside)
    return base ^ ((turns - np.where(last >= 0, turns[last], 0)) % 2 == 1)


def _range_maps(batches):
    """One map for each range and batch, numbered in order."""
    turn = 0
    for batch in batches:
        files, blocks, codes = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for a, b in _runs(files, blocks) if batch.num_rows else []:
            turn += 1
            yield pa.RecordBatch.from_arrays(
                [files.slice(a, 1), pa.array([int(blocks[a])], pa.int64()), pa.array([turn], pa.int64()), pa.array([_composed(codes[a:b])], pa.int32())],
                ["file", "block", "turn", "map"],
            )


_RECORD = ["file", "block", "part", "first", "record"]
WHOLE, HEAD, TAIL = 0, 1, 2


def _records(batches, header: bool):
    """Records that start and end in their range; what stands of others at a range's head and tail."""
    here, held, kind, first = None, [], WHOLE, False  # range, lines of the record that is open, where it started

    def row(part: int, top: bool, lines) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([here[0]]), pa.array([here[1]], pa.int64()), pa.array([part], pa.int32()), pa.array([top]), pa.array([b"\n".join(lines)], pa.binary())],
            _RECORD,
        )

    for batch in batches:
        files, blocks = batch.column(0), batch.column(1).to_numpy()
        codes, values, begins = batch.column(2).to_numpy(), batch.column(3), batch.column(4)
        for a, b in _runs(files, blocks) if batch.num_rows else []:
            place = (files[a].as_py(), int(blocks[a]))
            if place != here:
                if here and held:
                    yield row(HEAD if kind == HEAD else TAIL, first, held)
                here, held, first, inside = place, [], False, bool(begins[a].as_py())
                kind, top = (HEAD if inside else WHOLE), header and place[1] == 0
            after = _states(codes[a:b], inside)
            before = np.concatenate(([inside], after[:-1]))
            inside = bool(after[-1])
            alone, rest = ~before & ~after, np.flatnonzero(before | after)
            if top:  # the first record that is not blank is the header
                for i in range(b - a):
                    if before[i] or after[i]:
                        break  # it goes on over several lines
                    alone[i] = False
                    if values[a + i].as_py().strip():
                        top = False
                        break
            if alone.any():
                whole = values.slice(a, b - a).filter(pa.array(alone))
                n = len(whole)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([here[0]] * n), pa.array(np.full(n, here[1])), pa.array(np.zeros(n, np.int32)), pa.array(np.zeros(n, bool)), whole], _RECORD
                )
            for i in rest.tolist():
                if not before[i]:
                    first, top = top, False
                held.append(values[a + i].as_py())
                if not after[i]:
                    if kind == HEAD or not first:
                        yield row(kind, False, held)
                    held, kind, first = [], WHOLE, False
    if here and held:
        yield row(HEAD if kind == HEAD else TAIL, first, held)


def quoted_records(spark: SparkSession, path: str | list[str], options: dict) -> DataFrame:
    """The records of all files as text (column `record`), without headers and blank lines. Rows are in no order."""
    low = {k.lower(): v for k, v in options.items()}
    encoding = str(low.get("encoding", low.get("charset", "UTF-8")))
    header = str(low.get("header", "true")).lower() == "true"
    # only the line feed parts lines, so a carriage return stays and lines can be put together again
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )

    def text(raw: Column) -> Column:
        return raw.cast("string") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(raw.cast("binary"), encoding)

    opened, going = _patterns(options)
    line = text(F.col("value"))
    quoted = F.contains("value", F.lit(str(low.get("quote", '"'))))
    code = F.when(quoted, F.when(line.rlike(opened), 1).otherwise(0) + F.when(line.rlike(going), 2).otherwise(0)).otherwise(KEPT)
    coded = lines.select("file", "block", code.cast("int").alias("code"), F.col("value").cast("binary").alias("value"))
    maps = coded.select("file", "block", "code").mapInArrow(_range_maps, "file string, block long, turn long, map int")
    # (ranges, files): small beside the lines
    maps = materialise(maps, "quote-maps")
    order = "partition by file order by block, turn rows between unbounded preceding and 1 preceding"
    fixed = F.expr(f"last(if(map in ({SHUT}, {OPEN}), struct(n, map), null), true) over ({order})")
    turns = F.expr(f"coalesce(sum(if(map = {TURNED}, 1, 0)) over ({order}), 0)")
    numbered = maps.withColumn("n", F.expr("sum(if(map = 1, 1, 0)) over (partition by file order by block, turn)"))
    states = numbered.select("file", "block", "turn", fixed.alias("fixed"), turns.alias("turns"))
    odd = (F.col("turns") - F.coalesce(F.col("fixed.n"), F.lit(0))) % 2 == 1
    entered = states.withColumn("inside", F.coalesce(F.col("fixed.map") == OPEN, F.lit(False)) != odd)
    inside = materialise(
        entered.groupBy("file", "block").agg(F.min_by("inside", "turn").alias("inside")).where("inside"), "inside-quotes"
    )
    if inside.count() <= FEW:
        marked = coded.join(F.broadcast(inside), ["file", "block"], "left")
    else:  # lines come back in order after the shuffle
        turned = coded.withColumn("turn", F.monotonically_increasing_id()).join(inside, ["file", "block"], "left")
        marked = turned.repartition("file", "block").sortWithinPartitions("file", "block", "turn")
    found = marked.select("file", "block", "code", "value", F.coalesce("inside", F.lit(False)).alias("inside")).mapInArrow(
        lambda b: _records(b, header), "file string, block long, part int, first boolean, record binary"
    )
    found = materialise(found, "csv-records")
    pieces = found.where(F.col("part") != WHOLE)
    pieces = pieces.withColumn("n", F.expr(f"sum(if(part = {TAIL}, 1, 0)) over (partition by file order by block, part)"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "record"))), lambda p: p["record"])
    joined = pieces.groupBy("file", "n").agg(parts.alias("parts"), F.max("first").alias("first")).where("not first")
    glued = F.aggregate(F.slice("parts", 2, F.size("parts")), F.get("parts", F.lit(0)), lambda a, p: F.concat(a, F.lit(b"\n"), p))
    records = found.where(F.col("part") == WHOLE).select("record").unionByName(joined.select(glued.alias("record")))
    # what is left of a line end of two bytes
    records = records.select(F.regexp_replace(text(F.col("record")), r"\r\z", "").alias("record"))
    return records.where(F.length(F.trim("record")) > 0)


def read_quoted_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, **options) -> DataFrame:
    """CSV with line breaks inside quotes, parsed like the reader with `multiLine`, in many tasks; rows are in no order. A
    column named by `columnNameOfCorruptRecord` gets the text of records that do not fit. Lines end with a line feed,
    or a carriage return before it, and a value that is never closed ends before the file's last one; options that `fits` refuses need the reader with `multiLine`."""
    if not fits(options):
        raise ValueError("these options do not tell where lines end; read with multiLine=True")
    parser = {k: str(v) for k, v in options.items() if k.lower() not in _OWN}
    mode = str({k.lower(): v for k, v in options.items()}.get("mode", "PERMISSIVE")).upper()
    records = quoted_records(spark, path, options)
    corrupt = parser.get("columnNameOfCorruptRecord", "_corrupt_record")
    drop = mode == "DROPMALFORMED"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]) if drop and corrupt not in schema.names else schema
    options = {"multiLine": "true", "mode": "PERMISSIVE" if drop else mode, **parser}
    rows = records.select(F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide), options).alias("row"))
    found = rows.select(*(F.col(f"row.`{f.name}`").alias(f.name) for f in wide))
    return found.where(F.col(f"`{corrupt}`").isNull()).select(*(F.col(f"`{n}`") for n in schema.names)) if drop else found
