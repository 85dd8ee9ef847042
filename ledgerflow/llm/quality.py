"""Quality rules: hashed word and character n-gram logistic regression.

A document is described by the relative frequencies of its hashed word 1- and
2-grams and character 2- and 3-grams (all share ``2**bits`` slots).  MLlib's logistic regression learns the quality label from a bounded
sample of labelled rows (``max_rows``; the sample is drawn by a hash of the id,
so it is the same on every run); a second fold of that sample fits Platt's
calibration.  The learned weights (``2**bits`` doubles, a fixed size) travel to
the tasks, where whole texts are scored in Arrow batches: the margin is the
mean weight of the text's n-grams, so scoring is a table lookup per n-gram.

Defined results: a null text counts as an empty one; a text without words has
no n-grams and scores the calibrated intercept (the base rules reject it
anyway); repeated rows and rows with equal ids are scored one by one; an empty
table gives an empty result; extra columns are ignored by :func:`score_quality`
and passed through by :func:`keep_good`.  With no labelled rows, or labels of a
single kind, no model can be learned: every document gets probability 1 and only
the base rules decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import filter_rows, fold, map_rows, near_share, setup, shared_table
from ledgerflow.llm.words import (char_gram_slots, code_points, raw_word_hashes, repeated_window_words, slots64,
                                  window_hashes)

#: Fixed thresholds of the rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_PROBABILITY = 0.5

BITS = 13
MAX_ROWS = 6000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
WINDOW = 5


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    words = raw_word_hashes(code_points(text))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACES):
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup,
            repeated_window_words(words, WINDOW))


def fails_base(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def gram_slots(text: str, bits: int = BITS) -> list[np.ndarray]:
    """Slots of each n-gram family of a text; each family is normalised by itself."""
    points = code_points(text)
    words = raw_word_hashes(points)
    if not len(words):
        return []
    out = [slots64(words, bits), slots64(window_hashes(words, 2), bits)]
    out += [char_gram_slots(points, n, bits) for n in (2, 3)]
    return [x for x in out if len(x)]


def vectorise(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Sparse feature vector: relative frequencies summed over the families."""
    total = np.zeros(1 << bits)
    for s in gram_slots(text, bits):
        total += np.bincount(s, minlength=1 << bits) / len(s)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass(frozen=True)
class QualityModel:
    """Weights over ``2**bits`` slots, intercept, and Platt's slope and offset.
    ``weights`` None: nothing could be learned and every probability is 1."""

    weights: np.ndarray | None
    intercept: float
    slope: float
    offset: float
    bits: int = BITS

    def margin(self, text: str | None) -> float:
        return self.intercept + sum(float(self.weights[s].mean()) for s in gram_slots(text or "", self.bits))

    def probability(self, text: str | None) -> float:
        if self.weights is None:
            return 1.0
        z = self.slope * self.margin(text) + self.offset
        return float(1 / (1 + np.exp(-max(-60.0, min(60.0, z)))))

    def keeps(self, text: str | None) -> bool:
        counts = base_counts(text)
        return not fails_base(counts[0], counts[4]) and self.probability(text) >= MIN_PROBABILITY


def sample_labelled(docs: DataFrame, labels: DataFrame, column: str, max_rows: int, salt: str,
                    learn=None) -> DataFrame:
    """``(doc_id, text, y)`` of about ``max_rows`` labelled rows, by a hash of the id.

    The ids of the sample are bounded by ``max_rows``, so they are broadcast and
    the texts are filtered where they are read: no text is shuffled."""
    lab = labels.select(F.col("doc_id").alias("__id"), F.col(column).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("__id").isNotNull())
    if learn is not None:
        lab = lab.where(learn("__id"))
    n = lab.count()
    lab = lab.where(near_share("__id", salt, max_rows / max(1, n))).groupBy("__id").agg(F.min("y").alias("y"))
    return docs.select("doc_id", "text").join(F.broadcast(lab), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "y")


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, bits: int = BITS) -> QualityModel:
    """Learn from about ``max_rows`` labelled documents; four fifths fit the
    regression, one fifth (``crc32(doc_id) mod 5 = 4``) the calibration."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector, VectorUDT

    setup(docs.sparkSession)
    nothing = QualityModel(None, 0.0, 1.0, 0.0, bits)

    def features(rows):
        vs = [vectorise(t or "", bits) for t in rows["text"]]
        return {"y": rows["y"], "hold": rows["hold"], "at": [v[0] for v in vs], "val": [v[1] for v in vs]}

    sample = sample_labelled(docs, labels, "quality", max_rows, "quality").withColumn("hold", fold("doc_id", 5) == 4)
    feats = shared_table(map_rows(sample, features, "y int, hold boolean, at array<int>, val array<double>"),
                         "quality-features")
    if {r["y"] for r in feats.where("not hold").select("y").distinct().collect()} != {0, 1}:
        return nothing
    as_vector = F.udf(lambda a, v: SparseVector(1 << bits, a, v), VectorUDT())
    fit = feats.where("not hold").coalesce(6).select(
        F.col("y").cast("double").alias("label"), as_vector("at", "val").alias("features"))
    lr = LogisticRegression(maxIter=15, regParam=0.01, standardization=True).fit(fit)
    weights, intercept = lr.coefficients.toArray(), float(lr.intercept)

    def margin(rows):
        return {"y": rows["y"], "m": [intercept + float(np.dot(weights[a], v)) for a, v in zip(rows["at"], rows["val"])]}

    held = map_rows(feats.where("hold").select("y", "at", "val"), margin, "y int, m double").collect()
    slope, offset = platt(np.array([r["m"] for r in held]), np.array([r["y"] for r in held]))
    return QualityModel(weights, intercept, slope, offset, bits)


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of Platt's calibration (Newton steps on two parameters,
    targets smoothed by the class counts).  Too few rows of a class: (1, 0)."""
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if min(n0, n1) < 3:
        return 1.0, 0.0
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margin, np.ones_like(margin)])
    w = np.array([1.0, 0.0])

    def loss(w):
        z = x @ w
        return float((np.logaddexp(0, z) - target * z).sum() + 0.5e-3 * (w[0] - 1) ** 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        grad = x.T @ (p - target) + np.array([1e-3 * (w[0] - 1), 0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-9])
        step, scale = np.linalg.solve(hess, grad), 1.0
        while scale > 1e-6 and loss(w - scale * step) > loss(w):
            scale /= 2
        w = w - scale * step
        if np.abs(step).max() < 1e-9:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, probability double")


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per document: the base counts, the verdict and the calibrated
    probability of good quality."""
    setup(docs.sparkSession)

    def score(rows):
        base = [base_counts(t) for t in rows["text"]]
        failed = [fails_base(b[0], b[4]) for b in base]
        prob = [model.probability(t) for t in rows["text"]]
        out = dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), map(list, zip(*base))))
        return out | {"doc_id": rows["doc_id"], "base_failed": failed, "probability": prob,
                      "kept": [not f and p >= MIN_PROBABILITY for f, p in zip(failed, prob)]}

    return map_rows(docs.select("doc_id", "text"), score, SCHEMA)


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents the rules keep, all columns untouched."""
    setup(docs.sparkSession)
    return filter_rows(docs, "text", lambda texts: [model.keeps(t) for t in texts])
