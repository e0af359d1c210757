"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded; a gated attention gives it a weight against the
document's other passages; the weighted sum of the encodings is scored. Only documents have labels, and
the weights are learnt from them with the rest. The model is fitted on a bounded sample of labelled
documents and then scores every passage of every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.characters import code_points, letters
from lakeworks.llm.texts import clean, in_slices

PASSAGE = 1000
FEATURES = 20


@dataclass(frozen=True)
class Fit:
    """How the model is fitted. At most `most_documents` labelled documents (one text of each key, by least
    key hash, then further texts of the same keys) are used, with all their passages, and equal texts of a key
    once; scoring knows no such bound."""

    most_documents: int = 6000
    width: int = 16
    attention: int = 8
    rounds: int = 400
    rate: float = 0.02
    decay: float = 1e-4


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of PASSAGE code points, and where each text's passages start.

    An empty text has one passage, the empty one.
    """
    codes, starts = code_points(texts)
    sizes = np.diff(starts)
    per_text = np.maximum(1, -(-(sizes - 1) // PASSAGE))
    firsts = np.concatenate(([0], np.cumsum(per_text)))
    begin = np.repeat(starts[:-1], per_text) + PASSAGE * (np.arange(firsts[-1]) - np.repeat(firsts[:-1], per_text))
    length = np.diff(np.concatenate((begin, [len(codes)]))).astype(np.float64)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int32), begin) / length

    alpha, blank = letters()[codes], (codes == 32) | (codes == 10) | (codes == 9)
    upper = (codes >= 65) & (codes <= 90) | (codes >= 0xC0) & (codes <= 0xDE)
    digit = (codes >= 48) & (codes <= 57)
    mark = (codes == 44) | (codes == 46)
    symbol = ~(alpha | blank | digit | mark)
    before_blank = np.concatenate((blank[1:], [True]))
    same = np.concatenate(([False], codes[1:] == codes[:-1])) & ~blank
    # words: what stands between blanks, told apart by a sum over their code points and places
    heads = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    inside = np.where(blank, 0, 1).astype(np.int64)
    columns = [
        np.minimum(length / PASSAGE, 1), share(alpha), share(upper), share(digit), share(codes == 32), share(codes == 10),
        share(mark), share(symbol), share(codes == 124), share(codes > 127), share(symbol & before_blank),
        share(upper & ~before_blank), share((codes == 33) | (codes == 63)), share(same),
        share((codes == 40) | (codes == 41) | (codes == 47) | (codes == 64) | (codes == 58)),
    ]
    words = np.zeros((5, len(begin)))
    if len(heads):
        owner = np.searchsorted(begin, heads, "right") - 1
        place = np.arange(len(codes)) - np.maximum.accumulate(np.where(np.isin(np.arange(len(codes)), heads, assume_unique=True), np.arange(len(codes)), 0))
        folded = np.where(upper, codes + 32, codes).astype(np.int64)
        value = np.add.reduceat(folded * (place + 1) * (place + 7919) * inside, heads)
        long = np.add.reduceat(inside, heads)
        count = np.maximum(np.bincount(owner, minlength=len(begin)), 1)
        again = np.concatenate(([False], (value[1:] == value[:-1]) & (owner[1:] == owner[:-1])))
        distinct = np.bincount(np.unique(np.stack((owner, value)), axis=1)[0], minlength=len(begin))
        caps = upper[heads] & upper[np.minimum(heads + 1, len(codes) - 1)]
        for i, x in enumerate((long / 10, again, caps, long <= 3)):
            words[i] = np.bincount(owner, x.astype(np.float64), len(begin)) / count
        words[4] = distinct / count
    return np.stack([*columns, *words], 1), firsts


class Attention:
    """The model; weights are a dictionary of arrays."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @classmethod
    def fitted(cls, features: np.ndarray, firsts: np.ndarray, labels: np.ndarray, fit: Fit) -> Attention:
        """Gradient descent on the log loss of whole documents."""
        rng, (width, gates) = np.random.default_rng(7), (fit.width, fit.attention)
        w = {
            "mean": features.mean(0), "scale": features.std(0) + 1e-6,
            "E": rng.normal(0, 0.3, (features.shape[1], width)), "e": np.zeros(width),
            "V": rng.normal(0, 0.3, (width, gates)), "U": rng.normal(0, 0.3, (width, gates)), "a": rng.normal(0, 0.3, gates),
            "c": rng.normal(0, 0.3, width), "b": np.zeros(1),
        }
        model, moments = cls(w), {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in w.items()}
        bags = np.repeat(np.arange(len(labels)), np.diff(firsts))
        x = (features - w["mean"]) / w["scale"]
        for step in range(1, fit.rounds + 1):
            h, tanh, gate, share, z, p = model._forward(x, firsts)
            d = (p - labels) / len(labels)
            dz = d[:, None] * w["c"]
            dh = share[:, None] * dz[bags]
            ds = share * ((h - z[bags]) * dz[bags]).sum(1)
            dt, dg = ds[:, None] * w["a"] * gate * (1 - tanh**2), ds[:, None] * w["a"] * tanh * gate * (1 - gate)
            dh += dt @ w["V"].T + dg @ w["U"].T
            de = dh * (1 - h**2)
            slopes = {
                "E": x.T @ de, "e": de.sum(0), "V": h.T @ dt, "U": h.T @ dg, "a": (ds[:, None] * tanh * gate).sum(0),
                "c": z.T @ d, "b": np.array([d.sum()]),
            }
            for k, slope in slopes.items():
                (first, second), slope = moments[k], slope + fit.decay * w[k]
                first += 0.1 * (slope - first)
                second += 0.001 * (slope**2 - second)
                w[k] -= fit.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        return model

    def _forward(self, x: np.ndarray, firsts: np.ndarray):
        w = self.weights
        h = np.tanh(x @ w["E"] + w["e"])
        tanh, gate = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        score = (tanh * gate) @ w["a"]
        sizes = np.diff(firsts)
        share = np.exp(score - np.repeat(np.maximum.reduceat(score, firsts[:-1]), sizes))
        share /= np.repeat(np.add.reduceat(share, firsts[:-1]), sizes)
        z = np.add.reduceat(share[:, None] * h, firsts[:-1])
        return h, tanh, gate, share, z, 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"][0], -30, 30)))

    def score(self, features: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        return self._forward((features - self.weights["mean"]) / self.weights["scale"], firsts)[-1]


def held_out(key: Column) -> Column:
    """Whether a row's label is kept from fitting; a null key's is not."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def fit_model(df: DataFrame, labels: DataFrame, label: str, text: str, key: str, fit: Fit) -> Attention | None:
    """The model fitted on documents whose label may be learnt; None without both kinds of label."""
    known = labels.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{label}`").cast("double").alias("label"))
    known = known.dropna().where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.most_documents)  # a bounded sample
    rows = clean(df, doc_id=key, text=text).withColumn("digest", F.xxhash64("text"))
    # a key's first text comes before the further texts of any key, so no key takes the place of another
    texts = rows.select("doc_id", "digest").join(F.broadcast(chosen), "doc_id").distinct()
    firsts = texts.groupBy("doc_id").agg(F.min("digest").alias("first"))
    texts = texts.join(F.broadcast(firsts), "doc_id").orderBy(
        F.col("digest") != F.col("first"), F.xxhash64("doc_id", "digest"), "doc_id", "digest"
    )
    texts = texts.limit(fit.most_documents).select("doc_id", "digest", "label")
    rows = rows.join(F.broadcast(texts), ["doc_id", "digest"]).select("label", "text", "doc_id", "digest")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def measured(batches):
        seen = set()  # at most most_documents
        for batch in in_slices(batches, 2 << 20):
            names, new = list(zip(*(batch.column(i).to_pylist() for i in (2, 3)), strict=True)), []
            for i, name in enumerate(names):
                if name not in seen:
                    seen.add(name)
                    new.append(i)
            if not new:
                continue
            batch = batch.take(pa.array(new))
            found, firsts = passages(batch.column(1).to_pylist())
            bags = [found[a:b].ravel().tolist() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in (0, 2, 3)), pa.array(bags, pa.list_(pa.float64()))], ["label", "doc_id", "digest", "bag"]
            )

    sample = rows.mapInArrow(measured, f"label double, doc_id {kind}, digest long, bag array<double>")
    sample = sample.dropDuplicates(["doc_id", "digest"]).select("label", "bag").collect()
    sample = sorted((float(r[0]), tuple(r[1])) for r in sample)
    truth = np.array([label for label, _ in sample])
    if len(set(truth.tolist())) < 2:
        return None
    bags = [np.array(b).reshape(-1, FEATURES) for _, b in sample]
    return Attention.fitted(np.concatenate(bags), np.concatenate(([0], np.cumsum([len(b) for b in bags]))), truth, fit)


def score_quality(
    df: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id", fit: Fit = Fit()
) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted.

    Every passage of a text counts; null and empty texts are one empty passage. Null keys and labels are not
    learnt from; repeated rows each get their score; without both kinds of label every score is 0.5.
    An empty table gives an empty result.
    """
    model = fit_model(df, labels, label, text, key, fit)
    rows = clean(df, doc_id=key, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scored(batches):
        for batch in in_slices(batches, 2 << 20):
            texts = batch.column(1).to_pylist()
            scores = model.score(*passages(texts)) if model else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    found = rows.mapInArrow(scored, f"doc_id {kind}, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
