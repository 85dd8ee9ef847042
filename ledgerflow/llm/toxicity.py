"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

The features of a text are rates, so they do not grow with its length: densities
of two lexicons, the density of lexicon words close to a second-person pronoun,
capitals, punctuation, and obfuscation (letters mixed with digits or symbols,
stretched letters).  One lexicon is a small fixed list of insults; the other is
learned: words that labelled toxic rows use far more often than clean ones.

Learning uses a bounded sample of labelled rows (``max_rows``, drawn by a hash
of the id) in three disjoint parts, so that no part judges what it was made
from: half for the lexicon, three eighths for the trees (MLlib), one eighth for
the isotonic regression (MLlib).  Labels are read only where ``learn`` allows.
Every whole text is then described in Arrow batches and scored on the JVM.

Defined results: a null text counts as an empty one, whose features are all
zero; repeated rows and equal ids are scored one by one; an empty table gives
an empty result; extra columns are ignored by :func:`score_toxicity` and passed
through by :func:`keep_clean`.  If the sample holds labels of one kind only,
nothing can be learned and every score is that label (0 without any labels).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ledgerflow.llm.common import SLICE_ROWS, map_rows, setup, shared_table
from ledgerflow.llm.quality import sample_labelled
from ledgerflow.llm.words import Letters, code_points, hash_words, word_starts

MAX_ROWS = 16000
MAX_LEXICON = 4096
MIN_TOXIC_ROWS = 4
MIN_LOG_ODDS = 2.0
THRESHOLD = 0.5
NEAR_WORDS = 5

# Insults of the seed lexicon.
SEED_LEXICON = ("idiot", "moron", "stupid", "dumb", "loser", "pathetic", "worthless", "scum", "trash", "disgusting",
                "clown", "imbecile", "vermin", "garbage", "filthy", "hate", "kill", "ugly", "freak", "coward")
# Second-person pronouns of English, German, French and Spanish.
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
                 "tu", "te", "toi", "ton", "ta", "vous", "votre", "usted", "ustedes", "vosotros", "tú", "ti", "tus")
# Characters that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "€": "e"}

FEATURES = ("learned_density", "learned_weight", "learned_top", "learned_distinct", "seed_density", "near_second_person",
            "second_person_density", "capital_share", "shout_density", "exclamation_density", "question_density",
            "punctuation_density", "obfuscation_density", "stretch_density", "log_words")

@functools.cache
def letters() -> Letters:
    return Letters(LOOKALIKES)


def plain_words(text: str) -> dict[str, np.ndarray]:
    """Per word: the hash of its plain form (lower case, letters for look-alikes,
    no punctuation: ``1d.i0t!`` is ``idiot``; 0 without a letter), where it begins,
    and its letters, capitals, mixed-in marks and stretched letters."""
    t = letters()
    points = code_points(text)
    low = np.minimum(points, 0xFFFF)
    starts, inside = word_starts(points)
    letter, digit = t.letter[low], t.digit[low]
    solid = letter | digit
    within = np.zeros(len(points), dtype=bool)
    within[1:-1] = t.symbol[low[1:-1]] & solid[:-2] & solid[2:]
    lower = t.lower[low]
    triple = np.zeros(len(points), dtype=bool)
    triple[2:] = letter[2:] & (lower[2:] == lower[1:-1]) & (lower[1:-1] == lower[:-2])
    if not len(starts):
        return {"hash": np.empty(0, np.uint64)}
    per = {n: np.add.reduceat(x, starts, dtype=np.int64) for n, x in (
        ("letters", letter), ("capitals", t.capital[low]), ("marks", digit | within), ("stretched", triple))}
    h = hash_words(lower, solid | within, starts)
    h[per["letters"] == 0] = 0
    return per | {"hash": h, "starts": starts, "points": points, "letter": letter}


def word_hash(word: str) -> int:
    """Hash of a plain word, as :func:`plain_words` gives it."""
    return int(plain_words(word)["hash"][0])


def hash_set(words) -> np.ndarray:
    return np.sort(np.array([word_hash(w) for w in words], dtype=np.uint64))


def find(sorted_hashes: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place of each hash in ``sorted_hashes``, -1 where it is absent."""
    if not len(sorted_hashes):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(sorted_hashes, h), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == h, at, -1)


class Lexicon:
    """The learned words' hashes (sorted) and weights, with the fixed lists."""

    def __init__(self, weights: dict[int, float]):
        pairs = sorted((h & 0xFFFFFFFFFFFFFFFF, w) for h, w in weights.items())
        self.hashes = np.array([h for h, _ in pairs], dtype=np.uint64)
        self.weights = np.array([w for _, w in pairs] + [0.0])  # the last one is for "absent" (-1)
        self.seed, self.second = hash_set(SEED_LEXICON), hash_set(SECOND_PERSON)


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The dense features, in the order of ``FEATURES``."""
    w = plain_words(text) if text else {"hash": ()}
    h, n = w["hash"], len(w["hash"])
    if not n:
        return [0.0] * len(FEATURES)
    at = find(lexicon.hashes, h)
    weight, learned = lexicon.weights[at], at >= 0
    seed, second = find(lexicon.seed, h) >= 0, find(lexicon.second, h) >= 0
    hit = learned | seed
    near = 0
    if second.any() and hit.any():
        edge = np.zeros(n + 1, dtype=np.int64)
        spots = np.flatnonzero(second)
        np.add.at(edge, np.maximum(spots - NEAR_WORDS, 0), 1)
        np.add.at(edge, np.minimum(spots + NEAR_WORDS + 1, n), -1)
        near = int(((np.cumsum(edge)[:-1] > 0) & hit).sum())
    marks = int((~w["letter"] & (w["points"] > 32) & (w["points"] < 127)
                 & ((w["points"] < 48) | (w["points"] > 57))).sum())
    shout = (w["letters"] > 1) & (w["capitals"] == w["letters"])
    mixed = (w["letters"] > 0) & (w["marks"] > 0)
    return [float(learned.sum()) / n, float(weight.sum()) / n, float(weight.max()),
            float(np.log1p(len(set(at[learned].tolist())))), float(seed.sum()) / n, near / n, float(second.sum()) / n,
            float(w["capitals"].sum()) / max(1, int(w["letters"].sum())), float(shout.sum()) / n,
            text.count("!") / n, text.count("?") / n, marks / len(text), float(mixed.sum()) / n,
            float((w["stretched"] > 0).sum()) / n, float(np.log(n))]


@dataclass(frozen=True)
class ToxicityModel:
    """The learned lexicon (at most ``MAX_LEXICON`` words), the trees and the
    calibration; ``trees`` None: every score is ``constant``."""

    lexicon: dict[int, float]
    trees: object | None
    isotonic: object | None
    constant: float = 0.0


def learn_lexicon(sample: DataFrame) -> dict[int, float]:
    """Words (by hash) with a log odds ratio of at least ``MIN_LOG_ODDS`` between
    toxic and clean rows (smoothed by half a row), counted once per row."""
    def distinct_words(rows):
        hs = [np.unique(plain_words(t or "")["hash"]).view(np.int64) for t in rows["text"]]
        return {"word": np.concatenate(hs), "y": np.repeat(np.array(rows["y"], np.int32), [len(h) for h in hs])}

    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    counts = (map_rows(sample.select("text", "y"), distinct_words, "word long, y int").where("word <> 0").groupBy("word")
              .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).where(F.col("a") >= MIN_TOXIC_ROWS))
    odds = F.log((F.col("a") + 0.5) / (n1 - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (n0 - F.col("b") + 0.5))
    top = counts.select("word", odds.alias("w")).where(F.col("w") >= MIN_LOG_ODDS).orderBy(F.desc("w"), "word").limit(MAX_LEXICON)
    return {r["word"]: float(r["w"]) for r in top.collect()}


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn=None, max_rows: int = MAX_ROWS, trees: int = 20,
                 depth: int = 4) -> ToxicityModel:
    """Learn lexicon, trees and calibration from about ``max_rows`` labelled
    rows for which ``learn(id column)`` holds."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    spark = docs.sparkSession
    setup(spark)
    part = F.pmod(F.xxhash64(F.lit("toxicity-part"), F.col("doc_id")), F.lit(8))
    sample = shared_table(sample_labelled(docs, labels, "toxic", max_rows, "toxicity", learn)
                          .withColumn("part", part.cast("int")), "toxicity-sample")
    kinds = [r["y"] for r in sample.select("y").distinct().collect()]
    lexicon = learn_lexicon(sample.where("part < 4")) if len(kinds) == 2 else {}
    if len(kinds) < 2:
        return ToxicityModel({}, None, None, float(kinds[0]) if kinds else 0.0)
    # At most max_rows / 2 short rows, in one partition and by id: the trees' split points
    # come from samples per partition, and reruns should learn the same trees.
    x = shared_table(_described_rows(sample.where("part >= 4"), lexicon).select("row.doc_id", "row.y", "row.part", "x")
                     .repartition(1).sortWithinPartitions("doc_id", "x"), "toxicity-features")
    x = x.select(F.col("y").cast("double").alias("label"), "part", array_to_vector("x").alias("features"))
    fit = x.where("part < 7")
    if fit.select("label").distinct().count() < 2:
        return ToxicityModel({}, None, None, 0.0)
    gbt = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7, minInstancesPerNode=5).fit(fit)
    held = gbt.transform(x.where("part = 7")).select("label", vector_to_array("probability")[1].alias("p"))
    iso = None
    if held.select("label").distinct().count() == 2:
        iso = IsotonicRegression(featuresCol="p", labelCol="label").fit(held)
    return ToxicityModel(lexicon, gbt, iso)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, predicted`` for every document."""
    return _scored(docs.select("doc_id", "text"), model).select(
        F.col("row")["doc_id"].alias("doc_id"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Documents scored below the threshold, with all their columns."""
    return _scored(docs, model).where(F.col("score") < THRESHOLD).select(
        [F.col("row").getField(c).alias(c) for c in docs.columns])


def _scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``row`` (the whole input row as a struct, so that no column of it can
    clash with a name used here) and ``score``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    setup(docs.sparkSession)
    if model.trees is None:
        return docs.select(F.struct(*docs.columns).alias("row"), F.lit(model.constant).alias("score"))
    x = model.trees.transform(_described_rows(docs, model.lexicon).withColumn("features", array_to_vector("x")))
    x = x.select("row", vector_to_array("probability")[1].alias("p"))
    if model.isotonic is None:
        return x.select("row", F.col("p").alias("score"))
    # A hundredth of the trees' own probability keeps the order within a step of the calibration.
    mixed = F.lit(0.99) * F.col("prediction") + F.lit(0.01) * F.col("p")
    return model.isotonic.transform(x).select("row", F.when(F.col("prediction") >= THRESHOLD, F.greatest(F.lit(THRESHOLD), mixed))
                                              .otherwise(F.least(F.lit(THRESHOLD - 1e-9), mixed)).alias("score"))


def _described_rows(docs: DataFrame, lexicon: dict[int, float]) -> DataFrame:
    """``row`` and the feature array ``x`` of every document."""
    at = docs.columns.index("text")
    wide = StructType([StructField("row", docs.schema, False), StructField("x", ArrayType(DoubleType()))])
    arrow = to_arrow_schema(wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Lexicon(lexicon)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                x = pa.array([features(t, table) for t in part.column(at).to_pylist()], type=arrow.field("x").type)
                row = pa.StructArray.from_arrays(part.columns, fields=list(arrow.field("row").type))
                yield pa.RecordBatch.from_arrays([row, x], schema=arrow)

    return docs.mapInArrow(run, wide)
