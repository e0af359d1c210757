"""Document fingerprints by winnowing, in built-in functions.

A text is cut into units at white space and after `LONG` characters, beyond which each character up to the next white
space is a unit; so are characters of scripts without spaces. Every run of `K` units has a hash; of every `W` neighbouring
hashes the least is kept, the rightmost of equal ones, with its position. Two texts that share a run of
K + W - 1 units share a fingerprint, wherever it stands. A hash and its position are one number that
compares as wanted, so a window's choice is a plain minimum, found by doubling: the minima of 2n
neighbours are minima of two minima of n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.llm.texts import clean

K, W = 4, 8
#: Units of a text that are numbered together; longer texts have several overlapping parts.
PART = 1 << 20
PLACES = 1 << 21
#: Most characters of a unit; those that follow without white space are units of one.
LONG = 48
#: Thai to Khmer, kana to Han, Hangul and Han beyond the basic plane: no white space between words.
UNSPACED = r"[\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{AC00}-\x{D7AF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"


def bound(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _within(unit: Column) -> Column:
    """The units of what stands between white space."""
    rest = F.split(F.substring(unit, F.lit(LONG + 1), F.length(unit)), "")
    return F.when(F.length(unit) > LONG, F.concat(F.array(F.substring(unit, 1, LONG)), rest)).otherwise(F.array(unit))


def _units(text: Column) -> Column:
    wide = rf"\s|(?<={UNSPACED})(?!\s|\z)|(?<!\s)(?={UNSPACED})"
    mixed = (F.octet_length(text) > F.length(text)) & text.rlike(UNSPACED)
    return bound(
        F.when(mixed, F.split(text, wide)).otherwise(F.split(text, r"\s")),
        lambda units: F.when(
            F.exists(units, lambda u: F.length(u) > LONG),
            F.flatten(F.transform(units, lambda u: _within(u))),
        ).otherwise(units),
    )


def _minima(values: Column) -> Column:
    """The kept values among numbered hashes: the minimum of each window, once."""

    def doubled(a: Column, span: int) -> Column:
        if span == W:
            return F.array_distinct(a)
        left, right = F.slice(a, 1, F.size(a) - span), F.slice(a, span + 1, F.size(a) - span)
        return bound(F.zip_with(left, right, lambda x, y: F.least(x, y)), lambda b: doubled(b, 2 * span))

    return F.when(F.size(values) <= W, F.array(F.array_min(values))).otherwise(doubled(values, 1))


def _part(units: Column, start: Column, count: Column) -> Column:
    """Kept (hash, position) pairs of the hashes start .. start + count - 1."""

    def numbered(i: Column) -> Column:
        at = (start + i).cast("int")
        run = F.xxhash64(*(F.get(units, at + j) for j in range(K)))
        return F.shiftleft(F.shiftrightunsigned(run, 22), 21).bitwiseOR(F.lit(PLACES - 1) - i)

    values = F.transform(F.sequence(F.lit(0).cast("long"), count - 1), numbered)
    return bound(
        values,
        lambda v: F.transform(
            _minima(v),
            lambda kept: F.struct(
                F.shiftright(kept, 21).alias("h"),
                (start + (PLACES - 1) - kept.bitwiseAND(F.lit(PLACES - 1))).alias("p"),
            ),
        ),
    )


def fingerprints(text: Column) -> Column:
    """The text's kept (h, p) pairs: 42-bit hashes and their positions in units.

    A text with fewer than K units has one hash, of all its units; the empty text has the empty unit, and
    a null text counts as empty.
    """

    def of(units: Column) -> Column:
        hashes = F.greatest(F.lit(1), F.size(units) - (K - 1)).cast("long")
        parts = F.sequence(F.lit(0).cast("long"), F.floor((hashes - 1) / PART))
        found = F.transform(
            parts, lambda s: _part(units, s * PART, F.least(hashes - s * PART, F.lit(PART + W - 1).cast("long")))
        )
        # in order of position: what two parts share stands side by side
        return bound(
            F.flatten(found), lambda f: F.filter(f, lambda x, i: (i == 0) | (F.get(f, i - 1)["p"] != x["p"]))
        )

    return bound(F.coalesce(text, F.lit("")), lambda t: bound(_units(t), of))


def shown(found: Column) -> Column:
    """Fingerprints as text: hash:position pairs in the order of the text."""
    return F.array_join(F.transform(found, lambda f: F.concat(F.lower(F.hex(f["h"])), F.lit(":"), f["p"])), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two fingerprints, wherever they stand."""
    x, y = F.transform(a, lambda f: f["h"]), F.transform(b, lambda f: f["h"])
    return bound(
        F.struct(F.array_distinct(x).alias("x"), F.array_distinct(y).alias("y")),
        lambda s: bound(
            F.size(F.array_intersect(s["x"], s["y"])).cast("double"),
            lambda both: both / (F.size(s["x"]) + F.size(s["y"]) - both),
        ),
    )


def _buckets(ids: DataFrame, count: int):
    """Ranges of descending keys with about as many rows each, and the largest key of each range.

    The bounds are approximate quantiles, `count` numbers; null keys are a range after all others.
    """
    shares = F.array(*(F.lit(i / count) for i in range(count - 1, 0, -1)))
    # array_distinct keeps the descending order of the shares
    row = ids.agg(F.array_distinct(F.percentile_approx("doc_id", shares, F.lit(max(10000, 10 * count))))).first()
    limits = list(row[0] or [])
    step = max(1, int(len(limits) ** 0.5))
    coarse, every = limits[::step], F.array(*(F.lit(x) for x in limits)) if limits else F.array(F.lit(0))
    # how many bounds lie above the key: first among every step-th bound, then among those in between
    above = F.size(F.filter(F.array(*(F.lit(x) for x in coarse)), lambda x: x > F.col("doc_id"))) if coarse else F.lit(0)
    base = F.greatest(F.lit(0), above - 1) * step
    fine = F.size(F.filter(F.slice(every, base + 1, F.lit(step)), lambda x: x > F.col("doc_id"))) if limits else F.lit(0)
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(limits) + 1)).otherwise(base + fine)
    heads = {r[0]: r[1] for r in ids.groupBy(bucket.alias("bucket")).agg(F.max("doc_id")).collect()}  # a row a range
    return bucket, heads


def with_next(df: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with their fingerprints and the next row's text and fingerprints, in descending
    order of doc_id (null last, equal keys by text hash); after the last row comes the first.

    Rows are dealt to ranges of keys, and each range's first row goes to the range before it too, as a
    guest at its end. So the texts are shuffled once, and no task sees more than its ranges.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket, heads = _buckets(df.select("doc_id"), 3 * partitions)
    order = sorted(heads)
    before = dict(zip(order, [order[-1], *order[:-1]], strict=True)) if order else {}
    slots = range(max(order, default=0) + 1)
    kind = df.schema["doc_id"].dataType
    head = F.element_at(F.array(*(F.lit(heads.get(b)).cast(kind) for b in slots)), F.col("bucket") + 1)
    previous = F.element_at(F.array(*(F.lit(before.get(b, 0)) for b in slots)), F.col("bucket") + 1)
    own = F.struct(F.col("bucket").alias("to"), F.lit(False).alias("guest"))
    guest = F.struct(previous.alias("to"), F.lit(True).alias("guest"))
    dealt = (
        df.withColumn("bucket", bucket)
        .withColumn("place", F.explode(F.when(F.col("doc_id").eqNullSafe(head), F.array(own, guest)).otherwise(F.array(own))))
        .select("doc_id", "text", "place.to", "place.guest")
        .repartition(partitions, "to")
        .withColumn("found", fingerprints(F.col("text")))
    )
    turn = Window.partitionBy("to").orderBy(
        F.col("guest"), F.col("doc_id").desc_nulls_last(), F.xxhash64(F.coalesce("text", F.lit("")))
    )
    return (
        dealt.withColumn("next_text", F.lead("text").over(turn))
        .withColumn("next_found", F.lead("found").over(turn))
        .where(~F.col("guest"))
        .drop("to", "guest")
    )


def compare_with_next(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and the likenesses to it and to the next row.

    The edited text has the last half of the code points (rounded down) replaced by the first as many, or
    all, of the next row's. Null texts count as empty; the only row of a table is its own next row;
    repeated rows each give a result; an empty table gives none.
    """
    rows = clean(df, doc_id=key, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    size = F.length("text")
    half = F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half))
    paired = with_next(rows).withColumn("edited", edited).withColumn("edited_found", fingerprints(F.col("edited")))
    return paired.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        shown(F.col("found")).alias("fingerprint"),
        shown(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(F.col("found"), F.col("edited_found")).alias("near_edited"),
        likeness(F.col("found"), F.col("next_found")).alias("near_next"),
    )
