"""Fill-in-the-middle texts by one counted match.

A text is n units long, which `regexp_count` tells. Two cuts among its n + 1 borders come from a digest of the
row's key. The row's own pattern says how many units the prefix and the middle take, unit{a}+ and unit{b-a}+: the
counts are exact and the quantifiers possessive, so the match runs once over the text, keeps no way back and needs no
stack, however many units there are. Its three groups go straight into the output's order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE = r"[^\n]*\n|[^\n]+"


@dataclass(frozen=True)
class Form:
    """`rate` of a hundred texts are rearranged, `spm` of a hundred of those with the suffix first. The marks stand
    before prefix, suffix and middle; a text that holds one of them stays plain. `unit` must match wherever a
    text goes on, and never the empty string."""

    unit: str = LINE
    seed: int = 7
    rate: int = 100
    spm: int = 50
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")


def _number(digest: Column, group: int) -> Column:
    """The digest's group of eight hex digits as an unsigned number."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def _literal(text: str) -> str:
    """Text that a replacement takes as it is."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def rearranged(text: Column, a: Column, b: Column, spm: Column, how: Form) -> Column:
    """`text` with what follows its first `a` and `b` units put in the order of its form."""
    pattern = F.concat(
        F.lit(rf"\A((?:{how.unit}){{"), a.cast("string"), F.lit(rf"}}+)((?:{how.unit}){{"), (b - a).cast("string"), F.lit(r"}+)((?s:.*))\z")
    )
    p, s, m = map(_literal, how.marks)
    return F.regexp_replace(text, pattern, F.when(spm, F.lit(f"{s}$3{p}$1{m}$2")).otherwise(F.lit(f"{p}$1{s}$3{m}$2")))


def restored(output: Column, form: Column, how: Form = Form()) -> Column:
    """The text that `fill_in_middle` has made `output` from. Each mark stands there once, for the text has none
    and no end of a mark begins another."""
    p, s, m = how.marks

    def between(first: str, then: str | None) -> Column:
        rest = F.substring_index(output, first, -1)
        return F.substring_index(rest, then, 1) if then else rest

    return (
        F.when(form == "psm", F.concat(between(p, s), between(m, None), between(s, m)))
        .when(form == "spm", F.concat(between(p, m), between(m, None), between(s, p)))
        .otherwise(output)
    )


def fill_in_middle(df: DataFrame, text: str = "text", key: str = "doc_id", how: Form = Form()) -> DataFrame:
    """`df` with n (units), form (plain, psm or spm), prefix_chars and middle_chars (code points; null where plain)
    and output, the rearranged text.

    Cuts and form depend on `key` and the seed alone, so equal keys are cut at the same shares; a null key counts as
    the empty one. A null or empty text is plain, its output empty. All rows stay, repeated ones too; columns of `df`
    that have a result's name give way to it. An empty table gives an empty result.
    """
    if len({m[:1] for m in how.marks}) != 1 or any(m[:1] in m[1:] or sum(o.startswith(m) for o in how.marks) != 1 for m in how.marks):
        raise ValueError("marks must begin with the same character, hold it once, and none may begin another")
    made = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = [c for c in df.columns if c.lower() not in made]
    body = F.coalesce(F.col("t"), F.lit(""))
    rows = df.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"),
        F.sha2(F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256).alias("digest"),
    )
    counted = rows.withColumn("n", F.regexp_count(body, F.lit(how.unit)).cast("long"))
    h1, h2, h3, h4 = (_number(F.col("digest"), g) for g in range(4))
    cut = counted.select(
        "*", F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)).alias("a"), F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)).alias("b"),
        ((body == "") | F.greatest(*(F.contains(body, F.lit(mark)) for mark in how.marks)) | (h3 % 100 >= how.rate)).alias("plain"),
        (h4 % 100 < how.spm).alias("spm"),
    )
    out = cut.withColumn("output", F.when(F.col("plain"), body).otherwise(rearranged(body, F.col("a"), F.col("b"), F.col("spm"), how)))
    p, s, m = (F.locate(mark, F.col("output")) for mark in how.marks)
    prefix_end = F.when(F.col("spm"), m).otherwise(s)
    return out.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)),
        "n",
        F.when(F.col("plain"), "plain").when(F.col("spm"), "spm").otherwise("psm").alias("form"),
        F.when(~F.col("plain"), prefix_end - p - len(how.marks[0])).cast("long").alias("prefix_chars"),
        F.when(~F.col("plain"), F.length("output") - m - (len(how.marks[2]) - 1)).cast("long").alias("middle_chars"),
        "output",
    )
