"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text becomes the normalised TF-IDF vector of its hashed character 2- and
3-grams (lower case; whatever is no letter counts as one space).  Document
frequencies are counted over all learning rows.  For every language a bounded
sample of its rows (``ROWS_PER_LANGUAGE`` at most, drawn by a hash of id and text) is
clustered into ``CENTROIDS`` spherical k-means centroids, one task per language,
so that variants and genres of a language may lie apart.  A text gets the
language of the centroid with the greatest cosine; it is *rejected* if it lies
farther from that centroid than ``SLACK`` times the distance within which 99 %
of the centroid's own rows lie.

Only text and language of learning rows are used to learn; a prediction sees
nothing but the text.

Defined results: a null text or one without a letter is ``und`` with score 0;
without any learning row every text is ``und``; if no n-gram matches, the most
frequent language is named with score 0; equal cosines go to the more frequent
language; rows with a null language teach nothing; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_rows, setup, shared_table
from ledgerflow.llm.words import Letters, char_gram_slots, code_points

BITS = 13
CENTROIDS = 4
ROWS_PER_LANGUAGE = 400
SLACK = 1.25
UNKNOWN = "und"


@functools.cache
def letters() -> Letters:
    return Letters({})


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    points = code_points(text)
    return bool(letters().letter[np.minimum(points, 0xFFFF)].any()) or any(chr(p).isalpha() for p in points[points > 0xFFFF])


def gram_counts(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams of a text and how often each occurs."""
    t = letters()
    points = code_points(" " + text + " ")
    low = np.minimum(points, 0xFFFF)
    letter = t.letter[low] | (points > 0xFFFF)
    chars = np.where(letter, np.where(points > 0xFFFF, points, t.lower[low]), np.uint32(32)).astype(np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    chars = chars[keep]
    slots = np.concatenate([char_gram_slots(chars, n, bits) for n in (2, 3)])
    counts = np.bincount(slots, minlength=1 << bits)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass(frozen=True)
class LanguageModel:
    """Inverse document frequencies, and per centroid its language, vector and reach."""

    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    reach: np.ndarray

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, n = gram_counts(text)
        v = np.log1p(n) * self.idf[at]
        return at, v / max(1e-12, float(np.sqrt(v @ v)))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine (0 to 1) and whether the distance rejects it."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        at, v = self.vector(text)
        cos = self.centroids[:, at] @ v
        best = int(np.argmax(cos))
        return self.languages[best], float(min(1.0, max(0.0, cos[best]))), bool(1 - cos[best] > SLACK * self.reach[best])


def document_frequencies(texts: DataFrame, bits: int = BITS) -> tuple[np.ndarray, int]:
    """In how many texts each slot occurs, and the number of texts; every task
    counts its own rows and sends one table of fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros((1 << bits) + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df[gram_counts(text or "", bits)[0]] += 1
                n += 1
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["slot", "n"])

    out = np.zeros((1 << bits) + 1, np.int64)
    for r in texts.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[r["slot"]] = r["n"]
    return out[:-1], int(out[-1])


def cluster(vectors: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means (farthest-first start): unit centroids and each one's
    reach, the cosine distance within which 99 % of its members lie."""
    def norm(x):
        return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)

    centres = norm(vectors.mean(axis=0))[None, :]
    while len(centres) < min(k, len(vectors)):
        centres = np.vstack([centres, vectors[np.argmin((vectors @ centres.T).max(axis=1))]])
    for _ in range(rounds):
        of = np.argmax(vectors @ centres.T, axis=1)
        centres = norm(np.stack([vectors[of == c].mean(axis=0) if (of == c).any() else centres[c] for c in range(len(centres))]))
    cos = vectors @ centres.T
    of = np.argmax(cos, axis=1)
    reach = [float(np.quantile(1 - cos[of == c, c], 0.99)) if (of == c).any() else 1.0 for c in range(len(centres))]
    return centres, np.array(reach)


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
                  rows_per_language: int = ROWS_PER_LANGUAGE, centroids: int = CENTROIDS) -> LanguageModel:
    """Learn from the rows of ``docs`` that have a text and a language."""
    setup(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return LanguageModel(np.ones(1 << BITS), [], np.zeros((0, 1 << BITS)), np.zeros(0))
    df, n = document_frequencies(rows)
    idf = np.log((n + 1) / (df + 1)) + 1.0
    draw = F.pmod(F.xxhash64(F.lit("language"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("text")), F.lit(1_000_003))
    share = F.create_map(*[F.lit(x) for lang, c in counts.items() for x in (lang, int(min(1.0, 2 * rows_per_language / c) * 1_000_003) + 1)])
    # About twice the rows asked for, then the first of them: a repeated id cannot make a group larger.
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))
    sample = rows.withColumn("draw", draw).where(F.col("draw") < F.element_at(share, F.col("lang"))).withColumn("nth", first)
    sample = sample.where(F.col("nth") <= rows_per_language).select("lang", "text")

    def grams(part):
        got = [gram_counts(t) for t in part["text"]]
        return {"lang": part["lang"], "at": [g[0] for g in got], "n": [g[1] for g in got]}

    def centroids_of(key, part: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(part), 1 << BITS), np.float32)
        for i, (at, c) in enumerate(zip(part["at"], part["n"])):
            x[i, at] = np.log1p(c) * idf[at]
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        x = x[sorted(range(len(x)), key=lambda i: x[i].tobytes())]  # the result does not depend on the order of the rows
        centres, reach = cluster(x, centroids)
        return pd.DataFrame({"lang": key[0], "centre": [c.astype(float).tolist() for c in centres], "reach": reach})

    small = shared_table(map_rows(sample, grams, "lang string, at array<int>, n array<int>"), "language-sample")
    learned = small.groupBy("lang").applyInPandas(centroids_of, "lang string, centre array<double>, reach double").collect()
    learned.sort(key=lambda r: (-counts[r["lang"]], r["lang"]))
    return LanguageModel(idf, [r["lang"] for r in learned], np.array([r["centre"] for r in learned]).reshape(-1, 1 << BITS),
                         np.array([r["reach"] for r in learned]))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` of every document."""
    setup(docs.sparkSession)

    def run(rows):
        got = [model.predict(t) for t in rows["text"]]
        return {"doc_id": rows["doc_id"], "lang_pred": [g[0] for g in got], "score": [g[1] for g in got], "rejected": [g[2] for g in got]}

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run,
                    "doc_id long, lang_pred string, score double, rejected boolean")
