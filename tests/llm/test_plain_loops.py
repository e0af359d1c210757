"""Language identification and quality scores against plain loops over characters and rows."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeworks.llm import language, quality
from lakeworks.llm.language import BINS, SUFFIX_LANGUAGE, Fusion


def trigram_bins(text):
    """Bins of a text's trigrams whose middle and one other character are letters."""
    codes = [ord(c) if c.isalpha() else 0 for c in text.lower() + "\n"]
    out = []
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b and (a or c):
            mixed = (a * 2654435761 ^ b * 2246822519 ^ c * 3266489917) & 0xFFFFFFFF
            out.append((mixed ^ mixed >> 15) & (BINS - 1))
    return out


def softmax(scores):
    top = max(scores)
    parts = [math.exp(s - top) for s in scores]
    return [p / sum(parts) for p in parts]


def told(rows, languages, model, fusion=Fusion()):
    """(language, posterior, accepted) of rows (text, host, suffix, declared)."""
    size, here, near, whole = len(languages), defaultdict(Counter), defaultdict(Counter), Counter()
    likely, shares, some = [], [], []
    for text, host, suffix, _ in rows:
        bins = trigram_bins(text or "")
        likely.append([fusion.temper * sum(float(line[b]) for b in bins) for line in model])
        shares.append(softmax(likely[-1])[:size])
        some.append(bool(bins))
        if bins:
            for table in (here[suffix or "", host or ""], near[suffix or ""], whole):
                for i, s in enumerate(shares[-1]):
                    table[i] += s
                table["n"] += 1
    base = [(whole[i] + 1) / (sum(whole[j] for j in range(size)) + size) for i in range(size)]
    out = []
    for (_, host, suffix, declared), own, share, any_ in zip(rows, likely, shares, some):
        prior = base
        for table in (near[suffix or ""], here[suffix or "", host or ""]):
            n = max(0, table["n"] - any_)
            prior = [(max(0, table[i] - share[i] * any_) + fusion.pull * prior[i]) / (n + fusion.pull) for i in range(size)]
        scores, none = [math.log(prior[i]) + own[i] for i in range(size)], math.log(0.01) + own[size]
        for name, chance in ((SUFFIX_LANGUAGE.get((suffix or "").lower()), fusion.suffix), ((declared or "").lower(), fusion.declared)):
            if name in languages:
                any_ = True
                none -= math.log(size)
                scores = [s + math.log(chance if x == name else (1 - chance) / (size - 1)) for s, x in zip(scores, languages)]
        found = softmax([*scores, none])[:size]
        best = max(found)
        accepted = any_ and best >= fusion.least
        out.append((languages[found.index(best)] if accepted else None, best, accepted))
    return out


def test_language_like_a_plain_loop(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(110).collect()
    rng = random.Random(8)
    rows = [
        (i, r.text[: rng.choice([0, 3, 30, 300])] if i % 9 else None, rng.choice(["a", "b", None]), rng.choice(["de", "fr", "zz", None]), rng.choice(["en", "xx", None, None]))
        for i, r in enumerate(docs)
    ]
    train = spark.createDataFrame([(r.text[:400], r.lang) for r in docs], "text string, lang string").repartition(3)
    languages, model = language.train(train, "text", "lang")
    counts = {x: Counter(b for r in docs if r.lang == x for b in trigram_bins(r.text[:400])) for x in languages}
    for x, line in zip(languages, model, strict=False):
        total = sum(counts[x].values()) + 0.5 * BINS
        assert all(line[b] == pytest.approx(math.log((n + 0.5) / total), rel=1e-5) for b, n in counts[x].items())
    df = spark.createDataFrame(rows, "id long, text string, h string, s string, d string").repartition(4)
    found = {r.id: r for r in language.identify(df, languages, model, host="h", suffix=F.col("s"), declared=F.col("d")).collect()}
    for (i, *_), want in zip(rows, told([r[1:] for r in rows], languages, model), strict=True):
        assert (found[i].language, found[i].accepted) == (want[0], want[2])
        assert found[i].posterior == pytest.approx(want[1], abs=1e-6)


def upper(c):
    return "A" <= c <= "Z" or 0xC0 <= ord(c) <= 0xDE


def passage_features(text):
    text, out = (text or "") + "\n", []
    count = max(1, -(-(len(text) - 1) // 1000))
    for k in range(count):
        a, b = 1000 * k, 1000 * (k + 1) if k < count - 1 else len(text)
        marks, words = Counter(), []
        for i in range(a, b):
            c, blank = text[i], text[i] in " \n\t"
            last = i + 1 == len(text) or text[i + 1] in " \n\t"
            symbol = not (c.isalpha() or blank or "0" <= c <= "9" or c in ",.")
            for n, hit in enumerate((
                c.isalpha(), upper(c), "0" <= c <= "9", c == " ", c == "\n", c in ",.", symbol, c == "|", ord(c) > 127, symbol and last,
                upper(c) and not last, c in "!?", not blank and i > 0 and text[i - 1] == c, c in "()/@:",
            )):
                marks[n] += hit
            if not blank and (i == 0 or text[i - 1] in " \n\t"):
                end = next(j for j in range(i, len(text)) if text[j] in " \n\t")
                folded = "".join(chr(ord(x) + 32) if upper(x) else x for x in text[i:end])
                words.append((folded, upper(c) and upper(text[min(i + 1, len(text) - 1)])))
        n = max(1, len(words))
        out.append([
            min(1, (b - a) / 1000), *(marks[i] / (b - a) for i in range(14)), sum(len(w) / 10 for w, _ in words) / n,
            sum(x[0] == y[0] for x, y in zip(words, words[1:])) / n, sum(c for _, c in words) / n, sum(len(w) <= 3 for w, _ in words) / n,
            len({w for w, _ in words}) / n,
        ])
    return out


def test_quality_like_a_plain_loop():
    rng = random.Random(2)
    bits = ["the ", "the ", "A", "Ab ", "ÀÉ ", "x", ", ", ". ", "!!", "||", "12 ", "\n", "\t", "(a/b) ", "日本", "é", "%% ", "WORD "]
    texts = [None, "", " ", "a", "no blanks" * 300] + ["".join(rng.choices(bits, k=rng.choice([5, 80, 900, 1700]))) for _ in range(25)]
    features, firsts = quality.passages(texts)
    plain = [passage_features(t) for t in texts]
    assert np.diff(firsts).tolist() == list(map(len, plain))
    assert np.allclose(features, np.array([f for found in plain for f in found]), atol=1e-12)
    seeded, d, g = np.random.default_rng(5), 6, 3
    w = {
        "mean": features.mean(0), "scale": features.std(0) + 1e-6, "E": seeded.normal(size=(quality.FEATURES, d)), "e": seeded.normal(size=d),
        "V": seeded.normal(size=(d, g)), "U": seeded.normal(size=(d, g)), "a": seeded.normal(size=g), "c": seeded.normal(size=d), "b": np.array([0.3]),
    }
    for found, score in zip(plain, quality.Attention(w).score(features, firsts), strict=True):
        encoded, weights = [], []
        for f in found:
            x = [(v - m) / s for v, m, s in zip(f, w["mean"], w["scale"])]
            h = [math.tanh(sum(x[i] * w["E"][i][j] for i in range(len(x))) + w["e"][j]) for j in range(d)]
            gate = sum(
                w["a"][k] * math.tanh(sum(h[j] * w["V"][j][k] for j in range(d))) / (1 + math.exp(-sum(h[j] * w["U"][j][k] for j in range(d))))
                for k in range(g)
            )
            encoded.append(h)
            weights.append(gate)
        shares = softmax(weights)
        z = [sum(s * h[j] for s, h in zip(shares, encoded)) for j in range(d)]
        assert score == pytest.approx(1 / (1 + math.exp(-(sum(v * c for v, c in zip(z, w["c"])) + w["b"][0]))), abs=1e-9)
