"""Toxicity by a classifier chain: linear models in a row, each fed with the probabilities of those before it.

The table labels documents for two categories: `poor` (quality is 0) and `toxic`. The
chain predicts poor, then toxic from its own features and the probability of poor.
While training, a later model sees earlier probabilities made out of fold, so that it
learns how far to trust them. Features are terms: whole words, the first letters of words
(STEMS of them) that one, two or MANY distinct words share, and the text's style in steps:
its length, how many of its words and lines are distinct, its most frequent word, symbols,
capitals and letters. Terms are used if significantly more frequent in a category's
documents; those for an out-of-fold model are chosen without the fold.

The sample is bounded: about PER_CLASS labelled documents of each class of `toxic`, those
whose hash is below a threshold set by the class's size. Their terms are counted by Spark;
the driver gets at most TERMS terms for each category and fold and, for each document of
the sample, which of them it holds. Predictions read whole texts.
Defined cases: a null text is an empty one; with no label of either class nothing is
toxic; labels that are null or contradict each other for an id are left out (a null
quality only for `poor`); repeated rows are judged alike; equal z-scores rank by term; an
empty table gives no rows; a text of any length is one set of terms; columns beside doc_id
and text are ignored by `detect` and passed on by `keep`.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonara.llm.common import checkpointed, forget, lean, map_rows

PER_CLASS, TERMS, FOLDS = 4000, 400, 5
STEMS, MANY, PARTS = (4, 6), 3, 8
LEAST_DOCS, LEAST_Z, L2, STEPS = 4, 5.0, 1e-5, 400
WORD = re.compile(r"[^\W\d_]+")
CATEGORIES = ("poor", "toxic")
ALL = -1  # the fold that is left out when none is


def style_of(text: str) -> set[str]:
    """The text's style, each measure in PARTS steps (the number of words in powers of two)."""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    times = Counter(words)
    share = {
        "distinct": len(times) / n, "top": max(times.values(), default=0) / n, "lines": len(set(lines)) / max(1, len(lines)), "symbols": 4 * sum(map(text.count, "#*$%&|<>")) / n,
        "upper": sum(map(str.isupper, text)) / max(1, len(text)), "letters": sum(map(str.isalpha, text)) / max(1, len(text)),
    }
    return {f"#words {n.bit_length()}", *(f"#{k} {min(PARTS, int(x * PARTS))}" for k, x in share.items())}


def terms_of(text: str | None) -> set[str]:
    if not text:
        return set()
    found = set(WORD.findall(text.lower()))
    out = found | style_of(text)
    for k in STEMS:
        shared = Counter(w[:k] for w in found if len(w) > k)
        out.update(f"^{m} {stem}" for stem, n in shared.items() for m in range(1, min(n, MANY) + 1))
    return out


def chosen(sample: DataFrame) -> dict[tuple[int, str], list[str]]:
    """Of a sample (fold, poor, toxic, terms), for each fold left out and each category: the terms with a large z-score of the
    difference of their document shares, the largest first."""
    kinds = [(f, c, y) for f in range(FOLDS) for c in CATEGORIES for y in (0, 1)]
    counted = [F.count(F.when((F.col("fold") == f) & (F.col(c) == y), 1)).alias(f"{c}{y}_{f}") for f, c, y in kinds]
    size = sample.agg(*counted).head().asDict()
    counts = sample.select("fold", *CATEGORIES, F.explode("terms").alias("term")).groupBy("term").agg(*counted)
    found = []
    for left_out in (ALL, *range(FOLDS)):
        folds = [f for f in range(FOLDS) if f != left_out]
        for c in CATEGORIES:
            n0, n1 = (sum(size[f"{c}{y}_{f}"] for f in folds) for y in (0, 1))
            if n0 and n1:
                a0, a1 = (sum((F.col(f"{c}{y}_{f}") for f in folds[1:]), F.col(f"{c}{y}_{folds[0]}")) for y in (0, 1))
                share = (a0 + a1) / (n0 + n1)
                z = F.round((a1 / n1 - a0 / n0) / F.sqrt(F.greatest(share * (1 - share) * (1 / n0 + 1 / n1), F.lit(1e-18))), 9)
                clear = (a1 >= LEAST_DOCS) & (a1 / n1 >= 4 * a0 / n0) & (z >= LEAST_Z)
                found.append(F.when(clear, F.struct(F.lit(left_out).alias("left_out"), F.lit(c).alias("category"), z.alias("z"))))
    if not found:
        return {}
    each = counts.select("term", F.explode(F.array_compact(F.array(*found))).alias("f")).select("term", "f.*")
    best = Window.partitionBy("left_out", "category").orderBy(F.col("z").desc(), "term")
    out: dict[tuple[int, str], list[str]] = {}
    for r in sorted(each.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= TERMS).collect(), key=lambda r: r["k"]):
        out.setdefault((r["left_out"], r["category"]), []).append(r["term"])
    return out


def logistic(x: np.ndarray, y: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights (the last is the intercept), by accelerated gradient descent with an L2 penalty. Documents hold few of the terms,
    so only what is not zero is multiplied."""
    n, d = x.shape
    rows, cols = x.nonzero()
    values = x[rows, cols].astype(float)
    rate = 4.0 / max(1e-9, (values @ values) / n + 1 + 4 * L2)
    w = last = np.zeros(d + 1)
    for k in range(steps):
        ahead = w + k / (k + 3) * (w - last)
        miss = 1 / (1 + np.exp(-np.clip(np.bincount(rows, values * ahead[cols], n) + ahead[-1], -30, 30))) - y
        grad = np.append(np.bincount(cols, values * miss[rows], d) / n + L2 * ahead[:-1], miss.mean())
        last, w = w, ahead - rate * grad
    return w.astype(np.float32)


def apply(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def features(sets: list[set[str]], at: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(sets), len(at)), np.float32)
    for k, s in enumerate(sets):
        x[k, [at[w] for w in s & at.keys()]] = 1
    return x


class Chain:
    def __init__(self, terms: dict[tuple[int, str], list[str]], sets: list[set[str]], targets: dict[str, np.ndarray], folds: np.ndarray):
        """targets: for each category 1, 0, or NaN where it is not known."""
        at = {f: {w: k for k, w in enumerate(sorted({w for c in CATEGORIES for w in terms.get((f, c), [])}))} for f in (ALL, *range(FOLDS))}
        self.at, self.models = at[ALL], []
        if not terms.get((ALL, "toxic")):
            return
        x = {f: features(sets, own) for f, own in at.items()}
        earlier = np.zeros((len(sets), 0), np.float32)
        for name in CATEGORIES:
            known, y = ~np.isnan(targets[name]), np.nan_to_num(targets[name]).astype(np.float32)
            seen = {f: x[f] * np.isin(sorted(at[f]), terms.get((f, name), [])) for f in at}  # a category's model sees its own terms
            out_of_fold = np.zeros((len(sets), 1), np.float32)
            for f in range(FOLDS):
                held, own = folds == f, np.hstack([seen[f], earlier])
                if held.any() and (known & ~held).any():
                    out_of_fold[held, 0] = apply(logistic(own[known & ~held], y[known & ~held]), own[held])
            own = np.hstack([seen[ALL], earlier])
            self.models.append(logistic(own[known], y[known]) if known.any() else np.zeros(own.shape[1] + 1, np.float32))
            earlier = np.hstack([earlier, out_of_fold])

    def held(self, text: str | None) -> set[str]:
        """The terms of a text that the models know; the others are not kept."""
        return terms_of(text) & self.at.keys()

    def predict(self, sets: list[set[str]]) -> np.ndarray:
        """Probabilities of CATEGORIES."""
        if not self.models:
            return np.zeros((len(sets), len(CATEGORIES)))
        x = features(sets, self.at)
        for w in self.models:
            x = np.hstack([x, apply(w, x)[:, None]])
        return x[:, -len(CATEGORIES) :]


def fitted(docs: DataFrame, labels: DataFrame) -> Chain:
    agreed = lambda c: F.when(F.min(c) == F.max(c), F.min(c))
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(agreed("toxic").alias("toxic"), agreed("quality").alias("quality")).filter("toxic is not null")
    size = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31)
    share = F.when(F.col("toxic") == 1, PER_CLASS / max(1, size.get(1, 0))).otherwise(PER_CLASS / max(1, size.get(0, 0)))
    poor = F.when(F.col("quality").isNotNull(), (F.col("quality") == 0).cast("int"))
    ids = known.filter(drawn < share).select("doc_id", F.col("toxic").cast("int").alias("toxic"), poor.alias("poor"), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"))

    def start():
        forget()
        return lambda ids, folds, poor, toxic, texts: ((i, f, q, y, sorted(terms_of(t))) for i, f, q, y, t in zip(ids, folds, poor, toxic, texts) if t)

    # about 2 x PER_CLASS ids are broadcast
    sample = checkpointed(map_rows(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), ["doc_id", "fold", "poor", "toxic", "text"], "doc_id long, fold int, poor int, toxic int, terms array<string>", start))
    terms = chosen(sample)
    every = sorted({w for own in terms.values() for w in own})
    held = F.array_intersect("terms", F.lit(every)) if every else F.array().cast("array<string>")
    got = sorted(sample.select("doc_id", "fold", "poor", "toxic", held.alias("terms")).collect(), key=lambda r: (r["doc_id"], r["terms"]))
    return Chain(terms, [set(r["terms"]) for r in got], {c: np.array([np.nan if r[c] is None else r[c] for r in got], float) for c in CATEGORIES}, np.array([r["fold"] for r in got], np.int64))


def scored(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, a probability for each category, and toxic."""

    def start():
        def each(ids, texts):
            for i, p in zip(ids, chain.predict([chain.held(t) for t in texts]).tolist()):
                yield i, *p, p[-1] >= 0.5

        return each

    return map_rows(docs, ["doc_id", "text"], ", ".join(["doc_id long", *(f"p_{c} double" for c in CATEGORIES), "toxic boolean"]), start)


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_poor, p_toxic, toxic for every document."""
    return scored(docs, fitted(docs, labels))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    chain = fitted(docs, labels)

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        forget()
        parts = [texts.slice(k, 256).to_pylist() for k in range(0, len(texts), 256)]
        return pa.array([bool(p < 0.5) for part in parts for p in chain.predict([chain.held(t) for t in part])[:, -1]], pa.bool_())

    return lean(docs).filter(clean("text"))
