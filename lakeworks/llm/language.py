"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior: the likelihood of the text's letter trigrams under each
language, the language its markup declares, the country suffix of its address, and how the other rows of
its host read. Host priors are soft counts from a grouped aggregation, smoothed towards the address
suffix's and those towards the whole table's. A row's own text never counts in its own prior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm.characters import code_points, trigrams
from lakeworks.llm.texts import in_slices
from lakeworks.runtime import materialise

BINS = 1 << 14
#: Country suffixes whose pages are mostly in one language (fixed values).
SUFFIX_LANGUAGE = {
    "at": "de", "ar": "es", "au": "en", "cl": "es", "co": "es", "de": "de", "es": "es", "fr": "fr",
    "ie": "en", "mx": "es", "nz": "en", "pe": "es", "uk": "en", "us": "en",
}


@dataclass(frozen=True)
class Fusion:
    """Weights of the evidence: chances that markup and suffix name the right language, rows that a
    parent's prior counts for, the share of a trigram's log-likelihood that counts (trigrams overlap),
    and the least posterior that is accepted."""

    declared: float = 0.9
    suffix: float = 0.8
    pull: float = 20.0
    temper: float = 0.3
    least: float = 0.5


def train(df: DataFrame, text: str, label: str) -> tuple[list[str], np.ndarray]:
    """Languages and the log-probability of each trigram bin in each, from all rows with a label.

    Tasks send one count for each language and bin they saw; the driver gets the sums, which are at most
    languages times bins. A last row stands for no known language: all bins alike.
    """
    rows = df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label")).dropna()

    def counted(batches):
        seen: dict[str, np.ndarray] = {}
        for batch in in_slices(batches):
            texts, labels = (batch.column(i).to_pylist() for i in (0, 1))
            for language in set(labels):
                codes, starts = code_points([t.lower() for t, x in zip(texts, labels, strict=True) if x == language])
                index, counts = trigrams(codes, starts, BINS)
                seen.setdefault(language, np.zeros(BINS, np.int64))
                seen[language] += np.bincount(index[counts], minlength=BINS)
        for language, found in seen.items():
            bins = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(bins), pa.string()), pa.array(bins), pa.array(found[bins])], ["label", "bin", "n"]
            )

    sums = rows.mapInArrow(counted, "label string, bin long, n long").groupBy("label", "bin").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for language, bin_, n in sums.collect():
        counts.setdefault(language, np.zeros(BINS))[bin_] = n
    languages = sorted(counts)
    model = [np.log((counts[x] + 0.5) / (counts[x].sum() + 0.5 * BINS)) for x in languages]
    return languages, np.array([*model, np.full(BINS, -np.log(BINS))], np.float32)


def likelihoods(spark: SparkSession, at: int, model: np.ndarray, temper: float, name: str):
    """A step over batches that adds a list column to them: the tempered log-likelihood of the text in column `at` in
    each language and in none, then the share of each language by these alone, then the number of trigrams."""
    shared = spark.sparkContext.broadcast(model)  # languages times BINS

    def measured(batches):
        table = shared.value
        for batch in in_slices(batches, 2 << 20):
            codes, starts = code_points([t.lower() if t else "" for t in batch.column(at).to_pylist()])
            index, counts = trigrams(codes, starts, BINS)
            sums = [np.add.reduceat(np.where(counts, line[index], 0), starts[:-1], dtype=np.float64) for line in table]
            likely = np.stack(sums, 1) * temper
            flat = np.hstack([likely, _shares(likely)[:, :-1], np.add.reduceat(counts.astype(float), starts[:-1])[:, None]])
            ends = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, name])

    return measured


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _shares(scores: np.ndarray) -> np.ndarray:
    """Shares of each row from its log scores."""
    parts = np.exp(scores - scores.max(1, keepdims=True))
    return parts / parts.sum(1, keepdims=True)


def identify(
    df: DataFrame, languages: list[str], model: np.ndarray, text: str = "text", host: str | Column | None = None,
    declared: Column | None = None, suffix: Column | None = None, fusion: Fusion = Fusion(),
) -> DataFrame:
    """`df` with `language` (null if none is likely enough), `posterior` and `accepted`.

    `host`, `declared` (a language code) and `suffix` (the last label of the address) are optional
    evidence; null means none. A text without letters, empty or null has no text evidence, and alone it is
    not accepted. Every row stays; columns of `df` that have the result's names give way to it. An
    empty table gives an empty result.
    """
    if not languages:
        raise ValueError("no language to tell: train on rows with labels")
    size, made = len(languages), ("language", "posterior", "accepted")
    kept = [c for c in df.columns if c.lower() not in made]
    clues = (F.col(f"`{host}`") if isinstance(host, str) else host, suffix, declared)
    clues = (F.coalesce((F.lit("") if x is None else x).cast("string"), F.lit("")) for x in clues)
    work = df.select(*(F.col(f"`{c}`") for c in kept), *clues)
    work = work.toDF(*(f"c{i}" for i in range(len(kept))), "host", "suffix", "declared")
    measured = likelihoods(df.sparkSession, kept.index(text), model, fusion.temper, "found")
    own = [F.col(c) for c in work.columns[: len(kept)]]
    host_, suffix_, declared_, found = (F.col(c) for c in ("host", "suffix", "declared", "found"))

    # soft counts: how the rows with letters read, by host; last their number
    counts = [F.sum(found[size + 1 + i]) for i in range(size)] + [F.count("*").cast("double")]
    read = work.mapInArrow(measured, f"{_schema(work)}, found array<double>")
    hosts = read.where(found[2 * size + 1] > 0).groupBy(suffix_.alias("s"), host_.alias("h")).agg(F.array(*counts).alias("here"))
    hosts = materialise(hosts, "language-hosts")

    def total() -> Column:
        return F.array(*(F.sum(F.col("here")[i]) for i in range(size + 1)))

    whole = np.array(hosts.agg(total()).first()[0], dtype=object)
    whole = np.where(whole == None, 0.0, whole).astype(float)  # noqa: E711  an empty table has no sums
    base = (whole[:size] + 1) / (whole[:size].sum() + size)
    priors = hosts.join(hosts.groupBy("s").agg(total().alias("near")), "s").select(
        F.col("s").alias("suffix"), F.col("h").alias("host"), "here", "near"
    )
    none = F.array(*[F.lit(0.0)] * (size + 1))
    joined = work.join(priors, ["suffix", "host"], "left").select(
        *own, suffix_, declared_, F.coalesce("here", none).alias("here"), F.coalesce("near", none).alias("near")
    )

    def fused(batches):
        for batch in measured(batches):  # in the same worker: two steps over Arrow would take two workers for each task
            said = [batch.column(len(kept) + i).to_pylist() for i in (0, 1)]
            lists = [batch.column(len(kept) + i).flatten().to_numpy() for i in (2, 3, 4)]
            own_host, own_suffix, given = (x.reshape(batch.num_rows, -1) for x in lists)
            likely, share, told = given[:, : size + 1], given[:, size + 1 : -1], given[:, -1] > 0
            self_ = np.hstack([share, np.ones((len(share), 1))]) * told[:, None]  # a row is no prior of its own
            own_host, own_suffix = np.maximum(own_host - self_, 0), np.maximum(own_suffix - self_, 0)
            prior = (own_suffix[:, :size] + fusion.pull * base) / (own_suffix[:, size:] + fusion.pull)
            prior = (own_host[:, :size] + fusion.pull * prior) / (own_host[:, size:] + fusion.pull)
            scores = np.log(prior) + likely[:, :size]
            # no language: rare beforehand, and clues say nothing about it
            none = np.log(0.01) + likely[:, size]
            named = ([SUFFIX_LANGUAGE.get(x.lower(), "") for x in said[0]], [x.lower() for x in said[1]])
            for clue, chance in zip(named, (fusion.suffix, fusion.declared), strict=True):
                place = np.array([languages.index(x) if x in languages else -1 for x in clue], int)
                for i in range(size):
                    other = (1 - chance) / max(1, size - 1)
                    scores[:, i] += np.where(place < 0, 0.0, np.log(np.where(place == i, chance, other)))
                none = none - np.where(place < 0, 0.0, np.log(size))
                told = told | (place >= 0)
            shares = _shares(np.hstack([scores, none[:, None]]))[:, :size]
            best = shares.max(1)
            accepted = told & (best >= fusion.least)
            told_as = [languages[i] if a else None for i, a in zip(shares.argmax(1), accepted, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(told_as, pa.string()), pa.array(best), pa.array(accepted)],
                [*batch.schema.names[: len(kept)], *made],
            )

    schema = _schema(work.select(*own))
    return joined.mapInArrow(fused, f"{schema}, language string, posterior double, accepted boolean").toDF(*kept, *made)


def declared_in(html: Column) -> Column:
    """The language that an HTML root declares, as a two-letter code."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2})", 1)), F.lit(""))


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def visible(html: Column) -> Column:
    """An HTML page's text: scripts, styles, comments and tags become blanks, as do entities."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&[#\w]{1,31};", " ")
