"""MinHash near-dedup by dart throwing (DartMinHash, Christiani 2020).

A document is the weighted set of its word shingles (``SHINGLE`` words; fewer
words form one shorter shingle), weighted by how often they occur.  Every
element owns a fixed Poisson process of *darts* in the plane (weight x rank),
generated from the element's hash alone: the weight axis is cut into dyadic
regions ``[2**v - 1, 2**(v+1) - 1)``, and region ``v`` throws darts at rate
``2**v`` along the rank axis, each at a hashed weight inside the region.  A set
is hit by the darts that lie below its elements' weights; those of rank below
``theta = (k ln k + 2k) / total weight`` are about ``k ln k + 2k`` whatever the
length of the text.  Each dart belongs to one of ``k`` coordinates by its hash
and the earliest dart of a coordinate is the signature value, so two sets agree
in a coordinate with probability equal to their weighted Jaccard similarity.
Coordinates left empty (0.1 expected) are filled by doubling ``theta``.

Bands of ``ROWS`` coordinates make the join keys: ``BANDS`` bands find a pair at
the threshold 0.8 with probability ``1 - (1 - 0.8**ROWS)**BANDS`` = 0.9997
(0.999999 at 0.85).
Candidates are then checked by their exact weighted Jaccard similarity.

Skew and pairs.  Exact copies (equal word sequences) are collapsed first by a
partially aggregated ``groupBy``.  Inside a bucket one *centre*, the text with the most
bucket neighbours, is compared with every other one (a star, linear in the bucket),
and components of the verified links are built.  Pairs that this leaves open share a
bucket, hence a centre, and lie in different components.  They are found by an exact
prefix join on what sets a text apart from the centre:

* ``D(x)`` holds the shingles that x has and the centre lacks or the other way round
  (repeated ones numbered), so ``|x ^ y| = |D(x) ^ D(y)|``, and x, y reach the
  threshold t only if that is at most ``(1 - t) / (1 + t) * (|x| + |y|)``;
* an open pair has a shingle in both ``D(x)`` and ``D(y)``: if it had none, both
  differences together would stay below that bound, and both texts would have been linked
  to the centre;
* with all differences ordered rarest first, everything that x or y has before
  their first common shingle belongs to ``x ^ y``.  So it is enough to join a text by
  its first ``(1 - t) / t * |x|`` differences, not counting those no other text of the centre has, and to keep
  matches whose places, and the lengths behind them, allow the bound.  What all copies have in common is in no
  difference, and changes that many share stand last, beyond that prefix.

No bound is estimated and nothing is capped: every open pair that reaches the threshold is among the
candidates, each of them compared exactly.  Joined are only texts outside a posting's
largest component with those inside it or with each other.

Defined results: a text that is null or has no word is compared with nothing
and stays alone; a document is its id and its text, so rows equal in both count as one document and
rows of one id with different texts are judged each; a null id sorts
last and is never the representative of a class that has an id; an empty table
gives an empty result; extra columns are ignored (``dedup`` keeps them).
"""

from __future__ import annotations

import functools
import operator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import WORD, map_rows, setup, shared_table
from ledgerflow.llm.graph import components
from ledgerflow.llm.words import GOLDEN, code_points, mix64, mix_short, raw_word_hashes, window_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 34
ROWS = 7
#: Bits in which differences are counted modulo 2.
PARITY = 512

_U = np.uint64


def _unit(h: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1]."""
    return ((h >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53


def shingles(text: str | None, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of a text and how often each occurs."""
    return np.unique(window_hashes(raw_word_hashes(code_points(text or "")), n), return_counts=True)


#: Poisson(1) distribution function; a uniform number's place in it is a Poisson(1) count.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 19.0)])))


def dart_signature(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """``k`` signature values (64-bit) of a non-empty weighted set."""
    weights = weights.astype(np.float64)
    theta = (k * np.log(k) + 2 * k) / float(weights.sum())
    while True:
        ranks, darts = _darts(elements, weights, theta)
        slot = (darts % _U(k)).astype(np.int64)
        first = np.full(k, np.inf)
        np.minimum.at(first, slot, ranks)
        won = ranks == first[slot]
        out = np.zeros(k, np.uint64)
        out[slot[won]] = darts[won]
        if np.isfinite(first).all():
            return mix64(out ^ GOLDEN)
        theta *= 2


def _darts(elements: np.ndarray, weights: np.ndarray, theta: float) -> tuple[np.ndarray, np.ndarray]:
    """Rank and hash of every dart of rank below ``theta`` that hits the set.

    Region ``v`` is cut along the rank axis into cells of area 1, each with a
    Poisson(1) number of darts at hashed places."""
    ranks, darts = [], []
    for v in range(int(np.floor(np.log2(1 + weights.max()))) + 1):
        size, low = 2.0**v, 2.0**v - 1
        inside = weights > low
        seed = mix64(elements[inside] ^ _U(0x51ED270B * (v + 1)))
        w = weights[inside]
        cells = int(np.ceil(theta * size))
        block = np.arange(cells, dtype=np.uint64)
        h = mix64(seed[:, None] + GOLDEN * (block + _U(1))[None, :]).ravel()
        count = np.searchsorted(_POISSON, _unit(h), side="right")
        cell = np.repeat(np.arange(len(h)), count)
        nth = np.arange(len(cell)) - np.repeat(np.cumsum(count) - count, count)
        d = mix_short(h[cell] + GOLDEN * (nth.astype(np.uint64) + _U(1)))
        rank = (cell % cells + _unit(mix_short(d))) / size
        hit = rank < theta
        if v or (w < 1).any():
            hit &= low + _unit(mix64(d)) * size <= w[cell // cells]
        ranks.append(rank[hit])
        darts.append(d[hit])
    return np.concatenate(ranks), np.concatenate(darts)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser over sum of the greater weights of two shingle tables."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][ia], b[1][ib]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both) if len(a[0]) and len(b[0]) else 0.0


SIGNED = "id long, d string, h binary, keys array<long>"


def text_digest(text_col: str) -> Column:
    """A text as it stands; with the id it names a document."""
    return F.md5(F.col(text_col).cast("binary"))


def signed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, d, h, keys)`` of every row: the digest of its text, 128 bits of its word
    sequence (null for a text without words), and its band keys."""
    k = BANDS * ROWS

    def run(rows):
        out = {"id": rows["id"], "d": rows["d"], "h": [], "keys": []}
        for t in rows["text"]:
            s = shingles(t)
            if not len(s[0]):
                out["h"].append(None)
                out["keys"].append(np.empty(0, np.int64))
                continue
            sig = dart_signature(*s, k).reshape(BANDS, ROWS)
            key = np.zeros(BANDS, np.uint64)
            for r in range(ROWS):
                key = mix64(key * _U(0x9DDFEA08EB382D69) + sig[:, r])
            out["h"].append(xxhash.xxh3_128_digest(b" ".join(t.encode("utf-8", "surrogatepass").split())))
            out["keys"].append(key.view(np.int64))
        return out

    return map_rows(docs.select(F.col(id_col).cast("long").alias("id"), text_digest(text_col).alias("d"), F.col(text_col).alias("text")), run, SIGNED)


def _texts_of(nodes: DataFrame, reps: DataFrame, docs: DataFrame, tag: str) -> DataFrame:
    """``(node, text)`` of the distinct texts in ``nodes``, written once."""
    some = reps.join(nodes, "node", "left_semi").select("node", F.col("id").alias("of"), F.col("d").alias("as"))
    rows = docs.hint("merge").join(some, (docs["d"] == some["as"]) & docs["id"].eqNullSafe(some["of"]))
    return shared_table(rows.select("node", "text").dropDuplicates(["node"]), tag)


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    left, right = (texts.select(F.col("node").alias(c), F.col("text").alias(f"t{c}")).hint("merge") for c in ("a", "b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb").sortWithinPartitions("a")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose texts reach the threshold."""
    def run(rows):
        out = {"a": [], "b": []}
        last, known = None, None
        for a, b, ta, tb in zip(rows["a"], rows["b"], rows["ta"], rows["tb"]):
            if a != last:
                last, known = a, shingles(ta)
            if weighted_jaccard(known, shingles(tb)) >= THRESHOLD:
                out["a"].append(a)
                out["b"].append(b)
        return out

    return map_rows(_with_texts(pairs, texts), run, "a long, b long")


def difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """What two shingle tables do not share, as hashes of (shingle, number of its occurrence)."""
    every = np.unique(np.concatenate([a[0], b[0]]))
    n = np.zeros((2, len(every)), dtype=np.int64)
    for i, (elements, weights) in enumerate((a, b)):
        n[i, np.searchsorted(every, elements)] = weights
    low, count = n.min(axis=0), np.abs(n[0] - n[1])
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return mix64(np.repeat(every, count) + GOLDEN * (nth.astype(np.uint64) + _U(1)))


def _differences(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(centre, x, size, d, parity)`` of pairs (a: centre, b: x): the weight of x, its difference and that modulo 2."""
    def run(rows):
        out = {"centre": rows["a"], "x": rows["b"], "size": [], "d": [], "parity": []}
        last, known = None, None
        for a, ta, tb in zip(rows["a"], rows["ta"], rows["tb"]):
            if a != last:
                last, known = a, shingles(ta)
            other = shingles(tb)
            out["size"].append(int(other[1].sum()))
            d = difference(known, other)
            out["d"].append(d.view(np.int64))
            odd = np.bincount((d >> _U(20)).astype(np.int64) % PARITY, minlength=PARITY) & 1
            out["parity"].append(np.packbits(odd.astype(np.uint8)).view(np.int64))
        return out

    return map_rows(_with_texts(pairs, texts), run, "centre long, x long, size long, d array<long>, parity array<long>")


def _odd_bits(a: str, b: str) -> Column:
    """Bits in which two parities differ."""
    words = [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(PARITY // 64)]
    return functools.reduce(operator.add, words)


def _other_pairs(stars: DataFrame, comps: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b)`` of one centre in different components that may reach the threshold (see the module's text)."""
    label = comps.select(F.col("node").alias("x"), F.col("component").alias("comp"))
    lab = stars.select(F.col("a").alias("centre"), F.col("b").alias("x")).join(label, "x", "left").withColumn("comp", F.coalesce("comp", "x"))
    open_ = lab.join(lab.groupBy("centre").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("centre"), "centre")
    open_ = shared_table(open_.select("centre", "x", "comp"), "open-texts")
    diffs = shared_table(_differences(open_.select(F.col("centre").alias("a"), F.col("x").alias("b")), texts), "differences")

    # Differences that another text of the centre has too, rarest first; the others stand before them.
    each = diffs.select("centre", "x", F.explode("d").alias("e"))
    common = each.groupBy("centre", "e").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    known = each.join(common, ["centre", "e"]).groupBy("centre", "x").agg(F.sort_array(F.collect_list(F.struct("f", "e"))).alias("s"))
    most = F.floor(F.col("size") * F.lit((1 - THRESHOLD) / THRESHOLD) + F.lit(1e-6)).cast("int")  # of x alone in any pair
    texts_ = diffs.select("centre", "x", "size", "parity", F.size("d").alias("m")).join(known, ["centre", "x"]).withColumn("own", F.col("m") - F.size("s"))
    texts_ = texts_.withColumn("most", most).where("own <= most").join(open_, ["centre", "x"])
    posts = texts_.select("centre", "x", "comp", "size", "m", "parity", "most", "own", F.posexplode(F.expr("slice(s, 1, most + 1 - own)")).alias("i", "c"))
    posts = shared_table(posts.select("centre", F.col("c.e").alias("e"), "x", "comp", "size", "m", "parity", "most", (F.col("own") + F.col("i")).alias("before")), "postings")

    # One side lies outside the posting's largest component; one has at most half of what the pair may differ in before the match.
    of = posts.groupBy("centre", "e", "comp").agg(F.count(F.lit(1)).alias("n"))
    of = of.groupBy("centre", "e").agg(F.max(F.struct("n", "comp"))["comp"].alias("big"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    posts = shared_table(posts.join(of, ["centre", "e"]), "mixed-postings")
    outside = F.col("comp") != F.col("big")
    heads = posts.where("2 * before <= most").select("centre", "e", F.when(outside, 1).otherwise(2).alias("side"), "x", "comp", "size", "m", "parity", "before")
    tails = posts.select("centre", "e", F.explode(F.when(outside, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("side"),
                         *[F.col(c).alias(f"{c}2") for c in ("x", "comp", "size", "m", "parity", "before")])
    least = F.col("before") + F.col("before2") + F.abs((F.col("m") - F.col("before")) - (F.col("m2") - F.col("before2")))
    bound = F.lit((1 - THRESHOLD) / (1 + THRESHOLD)) * (F.col("size") + F.col("size2")) + F.lit(1e-6)
    met = heads.join(tails, ["centre", "e", "side"]).where((F.col("comp") != F.col("comp2")) & (least <= bound) & (_odd_bits("parity", "parity2") <= bound))
    return met.select(F.least("x", "x2").alias("a"), F.greatest("x", "x2").alias("b")).distinct()


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, d, h, class_id, kept)``, one row per row of ``docs``: the digests of its text and of its words, the
    least id of all documents that links reach (its own for a text without words), and
    whether it is the document of the class that stays, the one of least id, then least ``d``."""
    setup(docs.sparkSession)
    signed = shared_table(signed_texts(docs, id_col, text_col), "signed")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_digest(text_col).alias("d"), F.col(text_col).alias("text"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "d", "keys"))
    reps = signed.where("h is not null").groupBy("h").agg(first.alias("r"))
    reps = shared_table(reps.select(F.monotonically_increasing_id().alias("node"), "h", "r.no_id", "r.id", "r.d", "r.keys"), "distinct-texts")
    bands = reps.select("node", F.posexplode("keys").alias("band", "key"))
    buckets = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = shared_table(bands.join(buckets, ["band", "key"]), "bucket-members")
    met = members.groupBy("node").agg(F.sum("n").alias("met"))
    centres = members.join(met, "node").groupBy("band", "key").agg(F.max(F.struct(F.col("met"), (-F.col("node")).alias("c")))["c"].alias("c"))
    star = members.join(centres.select("band", "key", (-F.col("c")).alias("a")), ["band", "key"]).where("node <> a")
    star = shared_table(star.select("a", F.col("node").alias("b")).distinct(), "star-pairs")
    texts = _texts_of(_ends(star), reps, rows, "candidate-texts")
    links = shared_table(_verified(star, texts), "star-links")
    comps = components(links)
    more = shared_table(_other_pairs(star, comps, texts), "other-pairs")
    if not more.isEmpty():
        comps = components(links.union(shared_table(_verified(more, texts), "other-links")))
    named = reps.join(comps, "node", "left").select("h", F.coalesce("component", "node").alias("class"), "no_id", "id", "d")
    named = shared_table(named, "text-classes")
    stays = named.groupBy("class").agg(F.min(F.struct("no_id", "id", "d")).alias("r"))
    of = shared_table(named.select("h", "class").join(stays, "class").select("h", F.col("r.id").alias("class_id"), F.col("r.d").alias("stays")), "classes")
    out = signed.select("id", "d", "h").join(of, "h", "left")
    kept = F.col("h").isNull() | (F.col("id").eqNullSafe(F.col("class_id")) & (F.col("d") == F.col("stays")))
    return out.select("id", "d", "h", F.when(F.col("h").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), kept.alias("kept"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document of each class that stays, all columns untouched, in one row; rows
    without words stay as they are."""
    classes = near_duplicate_classes(docs, id_col, text_col).where("h is not null and kept")
    stays = shared_table(classes.groupBy("id", "d").agg(F.count(F.lit(1)).alias("n")), "documents-that-stay")
    stays = stays.select(F.col("id").alias("__lf_id"), F.col("d").alias("__lf_d"), F.col("n").alias("__lf_n"))
    # Texts are moved by the same plan at every size, whatever the table of classes would allow.
    joined = docs.withColumn("__lf_text", text_digest(text_col)).hint("merge").join(
        stays, (F.col("__lf_text") == F.col("__lf_d")) & docs[id_col].eqNullSafe(F.col("__lf_id")))
    once = joined.where("__lf_n = 1").select(docs.columns)
    repeated = joined.where("__lf_n > 1").dropDuplicates(["__lf_id", "__lf_d"]).select(docs.columns)
    wordless = docs.where(~F.coalesce(F.col(text_col).rlike(WORD), F.lit(False)))
    return once.union(repeated).union(wordless)
