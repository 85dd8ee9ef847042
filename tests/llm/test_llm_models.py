"""Operators without SQL: brute-force versions, exact round trips, held-out accuracy, edge rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import CLASH, DOC, edge_documents
from pyspark.sql import functions as F

from ledgerflow.llm import graph, langid, minhash, mixing, quality, queries, spm, toxicity
from ledgerflow.llm.common import fold, read_table

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return read_table(spark, SF, "labels")


@pytest.fixture(scope="module")
def edges(spark):
    """The edge rows with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(edge_documents(), DOC)
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()})


@pytest.fixture(scope="module")
def models(docs, labels):
    return (quality.fit_quality(docs, labels),
            toxicity.fit_toxicity(docs, labels, learn=lambda c: fold(c, 5) != 0),
            langid.fit_languages(docs.where(fold("doc_id", 4) != 2)))


def brute_counts(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    n, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if n[w] > 1:
            covered.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_quality_counts_verdicts_and_accuracy(docs, labels, models):
    got = quality.score_quality(docs, models[0]).join(labels, "doc_id", "left").join(docs.select("doc_id", "text"), "doc_id").collect()
    right = total = 0
    for r in got:
        counts = brute_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert r.base_failed == failed and (not failed or not r.kept)
        if r.quality is not None and not failed:
            total, right = total + 1, right + (r.kept == bool(r.quality))
    assert right / total > 0.97


def test_toxicity_held_out(docs, labels, models):
    got = toxicity.score_toxicity(docs, models[1]).join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, r.toxic) for r in got if crc(r.doc_id) % 5 == 0]
    assert np.mean([p == t for p, t in held]) > 0.9


def test_language_held_out(docs, models):
    got = langid.identify(docs, models[2]).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r.lang_pred == r.lang for r in got if crc(r.doc_id) % 4 == 2]
    assert len(held) > 200 and np.mean(held) > 0.95
    junk = models[2].predict("zzqqkk xxjjww " * 20)
    assert junk[2] and junk[0] in models[2].languages


def test_edge_rows(spark, edges, models):
    n = edges.count()
    q = {r.doc_id: r for r in quality.score_quality(edges, models[0]).collect()}
    assert q[4].n_words == q[5].n_words == q[6].n_words == 0 and not q[4].kept
    kept = quality.keep_good(edges, models[0])
    assert kept.columns == edges.columns and {r.doc_id for r in kept.collect()} <= {r.doc_id for r in edges.collect()}
    t = toxicity.score_toxicity(edges, models[1]).collect()
    assert len(t) == n and {r.doc_id: r.predicted for r in t}[13] == 1
    clean = toxicity.keep_clean(edges, models[1])
    assert clean.columns == edges.columns and clean.dtypes == edges.dtypes
    assert 13 not in {r.doc_id for r in clean.collect()} and clean.where("doc_id = 2").first()["kept"] == 1
    lang = {r.doc_id: r.lang_pred for r in langid.identify(edges, models[2]).collect()}
    assert lang[4] == lang[5] == lang[6] == lang[9] == "und" and lang[12] != "und"
    one = minhash.dedup(edges)
    assert one.columns == edges.columns
    ids = sorted(r.doc_id for r in one.select("doc_id").collect() if r.doc_id is not None)
    assert ids == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13] and one.where("doc_id is null").count() == 0


def test_nothing_to_learn_and_empty_tables(spark, edges):
    none = edges.limit(0)
    labels = spark.createDataFrame([(1, None, None), (2, 1, 0), (None, 0, 1)], LABELS)
    for docs in (edges, none):
        q, t = quality.fit_quality(docs, labels), toxicity.fit_toxicity(docs, labels)
        assert q.weights is None and t.trees is None and t.constant == 0.0
        assert toxicity.score_toxicity(docs, t).where("score <> 0").count() == 0
        assert quality.score_quality(docs, q).where("kept and base_failed").count() == 0
        assert toxicity.keep_clean(docs, t).columns == docs.columns
    model = langid.fit_languages(none)
    assert {r.lang_pred for r in langid.identify(edges, model).collect()} == {"und"}
    assert langid.identify(none, model).count() == 0
    assert spm.encode_digests(none).count() == 0 and minhash.dedup(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    off = []
    for _ in range(150):
        e = np.unique(rng.integers(0, 2**63, 500).astype(np.uint64))
        w = rng.integers(1, 6, len(e))
        cut = rng.integers(20, 400)
        a, b = (e[:420], w[:420]), (e[cut:], w[cut:] + (np.arange(len(e) - cut) % 9 == 0))
        j = minhash.weighted_jaccard(a, b)
        same = (minhash.dart_signature(*a, 238) == minhash.dart_signature(*b, 238)).mean()
        off.append((same - j) / np.sqrt(j * (1 - j) / 238 + 1e-9))
    assert abs(np.mean(off)) < 0.35 and 0.8 < np.std(off) < 1.3


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, 500 + i) for i in range(50)] + [(900, 900), (7, 8), (8, 7), (7, 8)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[500 + i] == 5 for i in range(50))
    assert (got[7], got[8]) == (7, 7) and 900 not in got


def test_spans_and_library_agree(spark, edges):
    enc = spm.encoder(spm.default_model())
    rows = {(r.doc_id, r.text): r for r in spm.encode_documents(edges).join(edges.select("doc_id", "text"), "doc_id", "left").collect()}
    for (_, text), r in rows.items():
        if text is None and r.doc_id != 4:
            continue
        data = (text or "").encode()
        assert list(r.ids) == enc.lib.encode(text or "") and r.decoded == enc.lib.decode(list(r.ids))
        assert list(r.begins) == sorted(r.begins) and all(b <= e for b, e in zip(r.begins, r.ends))
        assert not data or (r.begins[0] == 0 and r.ends[-1] == len(data))
        plain = [(data[b:e].decode(), enc.lib.id_to_piece(i)) for i, b, e in zip(r.ids, r.begins, r.ends) if not enc.lib.is_byte(i)]
        assert all(s.replace(" ", spm.MARK) in (p, p.removeprefix(spm.MARK)) for s, p in plain)
    for r in spm.encode_digests(edges, keep_ids=True).collect():
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()


def test_character_map_follows_the_librarys_normaliser():
    import sentencepiece

    for rule in ("nmt_nfkc", "nfkc_cf"):
        lib = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        spec = spm.NormaliserSpec.parse(dict(spm._fields(lib.serialized_model_proto()))[3])
        ours = spm.Normaliser(spec)
        assert ours.map.units
        for text in ("ﬁx  Ⅳ ①　ｱｲ", "Ａ b\tc d ﷺ", "  in  and out  ", "é é ﬀ 가 가", "​ x 😀 ㍿", "ªº½ İß", "", " "):
            norm, come = ours(text)
            want, offsets = lib.normalize(text, with_offsets=True)
            assert norm.decode() == want
            data, chars = norm.decode(), np.cumsum([0] + [len(c.encode()) for c in norm.decode()])
            source = np.cumsum([0] + [len(c.encode()) for c in text])
            if data:
                assert [int(np.searchsorted(source, come[b])) for b in chars[:-1]] == list(offsets)[:len(data)]


def brute_mix(rows):
    """``(doc_id, source, size) -> copies`` by serving the queues one document at a time."""
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 2 * sizes[s]}
        if not over:
            target.update(share)
            break
        target.update({s: 2.0 * sizes[s] for s in over})
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
    turns = []
    for s in order:
        queue = sorted((r for r in rows if r[1] == s), key=lambda r: hashlib.md5(f"mix{r[0]}".encode()).hexdigest())
        served = 0
        for _ in range(2):
            for r in queue:
                served += r[2]
                turns.append((served / target[s] if target[s] else 0.0, r))
    copies, used = Counter(), 0
    for _, r in sorted(turns, key=lambda t: t[0]):
        used += r[2]
        if used > sum(target.values()) + 1e-6:
            break
        copies[r] += 1
    return target, copies


def test_mix_against_a_queue(spark):
    rng = np.random.default_rng(4)
    rows = [(i, ["a", "b", None, "big", "\U0001F600", "￿"][int(rng.choice(6, p=[.1, .1, .1, .5, .1, .1]))], int(rng.integers(1, 60))) for i in range(600)]
    df = spark.createDataFrame([(i, "w " * n, None, s, None) for i, s, n in rows], DOC)
    target, copies = brute_mix(rows)
    got = mixing.mix(df).collect()
    assert {(r.doc_id, r.source, r.size): r.copies for r in got} == {r: copies[r] for r in rows}
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert abs(r.target - target[r.source]) < 1e-6 and r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    assert mixing.mixed_documents(df).count() == sum(copies.values())


def test_pipeline_against_its_parts(spark):
    """The pipeline's rows, recomputed on the driver from the stages' decisions."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    q = quality.fit_quality(docs, labels)
    rows = [r for r in docs.collect() if q.keeps(r.text)]
    left = spark.createDataFrame(rows, docs.schema)
    t = toxicity.fit_toxicity(left, labels, learn=lambda c: fold(c, 5) != 0)
    toxic = {r.doc_id for r in toxicity.score_toxicity(left, t).collect() if r.predicted}
    rows = [r for r in rows if r.doc_id not in toxic]
    sets = {r.doc_id: Counter(zip(*[r.text.split()[k:] for k in range(5)])) for r in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b:
                both = sum((sets[a] & sets[b]).values())
                if both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                    x, y = sorted((root(a), root(b)))
                    up[y] = x
    rows = [r for r in rows if root(r.doc_id) == r.doc_id]
    _, copies = brute_mix([(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in rows])
    want = Counter({k[0]: n for k, n in copies.items() if n})
    got = corpus_pipeline.run(spark, sf).collect()
    assert Counter(r.doc_id for r in got) == want
    text, enc = {r.doc_id: r.text for r in rows}, spm.encoder(spm.default_model())
    assert all(list(r.ids) == enc.lib.encode(text[r.doc_id]) for r in got)


def test_registered():
    import __spark_entry__

    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in __spark_entry__.queries()) == 1
    assert "pipeline" in __spark_entry__.queries() and set(queries.ORACLE) <= set(queries.QUERIES)
