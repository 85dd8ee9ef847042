"""Token-id files, centroid clustering, vector codes and the pair search: brute force, edge rows, files as others read them."""

import io
import random
import zlib

import numpy as np
import pytest
import zstandard
from llm_data import CLASH, DOC, edge_documents
from pyspark.sql import functions as F

from ledgerflow.llm import lloyd, minhash, mixing, pq, tokenfiles
from ledgerflow.llm import queries as Q
from ledgerflow.llm.common import read_table, shared_path

SF = "/root/testdata/sf0.001"
EMB = "vec_id long, embedding array<float>, label int, v int, id string, row int, n long"


def library_ids(text):
    enc = tokenfiles.encoder(tokenfiles.default_tokenizer())
    return enc.lib.encode(text or "", add_special_tokens=False).ids + [tokenfiles.END_ID]


def brute_digests(rows):
    """Of ``(doc_id, text)`` rows whose ids are unique: what the files must hold."""
    out, start = {}, 0
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = np.array(library_ids(text), dtype="<u4")
        out[d] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_token_files_query_against_the_library(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in Q.QUERIES["op11_tokenfiles"](spark, SF).collect()}
    assert got == brute_digests(rows)


ODD = ["I'LL don't 'S ''s x's123 '", "a<|endoftext|>b <|startoftext|>", "é É ẞ ΑΣ Σ ﬁ ①②½ 日本 😀👍🏽 é ́x ​ \xa0 y z \x1c\x1d q\x85w",
       "\x00 \x7f ~ \x01a", "ab" * 400, "foo_bar-baz...!!?? 12345 6.7e8", "", " \t\n", "İstanbul ſ K", "ªº²³ ŉ Ǆ ȼ", "tab\tvt\x0bff\x0ccr\r\n"]


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(tokenfiles, "MEMO_WORDS", 7)
    monkeypatch.setattr(tokenfiles, "MEMO_PIECES", 7)
    monkeypatch.setattr(tokenfiles, "SEGMENT", 5)
    enc = tokenfiles.IdEncoder(tokenfiles.default_tokenizer())
    assert enc.by_word and enc.width == 2
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice(" \nab'.1é日İ́\x1c\x85<|>_S") for _ in range(60)) for _ in range(300)]
    for t in texts:
        assert enc.encode(t) == np.array(enc.lib.encode(t, add_special_tokens=False).ids, dtype="<u2").tobytes()
    assert len(enc.plain_ids) <= 7 and len(enc.plain_ids.older) <= 7


def test_descriptions_that_do_not_go_by_words():
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        assert not tokenfiles.word_wise(json.load(f))
    enc = tokenfiles.IdEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert enc.encode(" two  words") == np.array(enc.lib.encode(" two  words", add_special_tokens=False).ids, dtype="<u2").tobytes()


def test_token_files_edges_shards_and_wanted_documents(spark, monkeypatch):
    rows = [*edge_documents(), (None, None, None, None, None), (-5, "first of all", None, None, None)]
    docs = spark.createDataFrame(rows, DOC).withColumns({k: F.lit(v) for k, v in CLASH.items()})
    path = shared_path(spark, "test-token-files")
    tokenfiles.write_token_files(docs, path, shard_ids=150_000)
    files = [(r.shard, bytes(r.content)) for r in tokenfiles.token_files(spark, path).collect()]
    assert len(files) > 1 and len({s for s, _ in files}) == len(files)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenfiles.stored_digests(spark, path).collect())
    want = sorted((r[0], len(library_ids(r[1])), zlib.crc32(np.array(library_ids(r[1]), dtype="<u4").tobytes())) for r in rows if r[0] is not None)
    assert sorted((d, n, c) for _, d, n, c in got if d is not None) == want and len(got) == len(rows)
    ids = [d for _, d, _, _ in got]
    assert ids == sorted((d for d in ids if d is not None)) + [None, None] and ids[0] == -5
    assert [s for s, *_ in got] == np.cumsum([0] + [n for _, _, n, _ in got])[:-1].tolist()

    # Any zstandard program reads the frames one after the other, over the index and the seek table.
    whole = b""
    for _, data in sorted(files):
        whole += zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert len(whole) == 2 * sum(n for _, _, n, _ in got)

    # Only the frames of wanted documents are decompressed.
    shard = tokenfiles.Shard(max(files, key=lambda x: len(tokenfiles.Shard(x[1]).ids))[1])
    assert len(shard.ids) > 1 and len(shard.entries) == shard.end[-1] + 1 and shard.entries["raw"][-1] == 0
    asked = []
    monkeypatch.setattr(shard, "frame", lambda k, f=shard.frame: asked.append(k) or f(k))
    shard.document(1)
    assert asked == list(range(shard.first[1], shard.end[1]))
    some = tokenfiles.read_tokens(spark, path, spark.createDataFrame([(7,), (10,), (999,)], "doc_id long")).collect()
    assert {r.doc_id: list(r.ids) for r in some} == {7: library_ids("one two"), 10: library_ids("x" * 300_000)}
    assert tokenfiles.read_tokens(spark, path).count() == tokenfiles.token_index(spark, path).count() == len(rows)

    # A changed byte is found by the frame's checksum or by the frame itself.
    data = bytearray(files[0][1])
    data[int(tokenfiles.Shard(bytes(data)).offsets[0]) + 8] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tokenfiles.Shard(bytes(data)).document(0)


def test_frames_of_a_long_document(monkeypatch):
    monkeypatch.setattr(tokenfiles, "FRAME_IDS", 10)
    ids = [np.arange(n, dtype="<u2") for n in (25, 1, 10, 30)]
    framed = [tokenfiles.frames_of(x.tobytes(), 2) for x in ids]
    data = tokenfiles.shard_bytes([3, 4, None, 9], [len(x) for x in ids], 2, [f for f, _, _ in framed],
                                  [x for _, s, _ in framed for x in s], [x for _, _, s in framed for x in s]) + tokenfiles.SEEKABLE_MAGIC
    shard = tokenfiles.Shard(data)
    assert shard.ids == [3, 4, None, 9] and (shard.end - shard.first).tolist() == [3, 1, 1, 3]
    assert all((shard.document(i) == x).all() for i, x in enumerate(ids))


def test_token_files_of_an_empty_table(spark):
    path = shared_path(spark, "test-no-token-files")
    tokenfiles.write_token_files(spark.createDataFrame([], DOC), path)
    assert tokenfiles.stored_digests(spark, path).count() == 0 and tokenfiles.read_tokens(spark, path).count() == 0


def edge_vectors(n=320):
    rng = np.random.default_rng(7)
    vecs = [(rng.standard_normal(64) * rng.choice([0.05, 0.3])).astype(np.float32).tolist() for _ in range(n)]
    rows = [(i if i % 50 else None, v, None if i % 7 == 0 else i % 3) for i, v in enumerate(vecs)]
    rows += [(400, vecs[3], 1), (400, vecs[3], 1), (401, vecs[3], None), (5, vecs[9], 2), (6, [0.0] * 64, 0), (7, [1e30] + [0.0] * 63, 0),
             (500, None, 1), (501, [None] + [0.1] * 63, 1), (502, [float("nan")] + [0.1] * 63, 1), (503, [float("inf")] * 64, 1), (504, [], 1)]
    return [(*r, 1, "x", 2, 3) for r in rows]


def test_vector_edges(tables, agree):
    rows = edge_vectors()
    folder, con = tables(embeddings=(EMB, rows))
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT vec_id, embedding, label FROM read_parquet('{folder}/embeddings.parquet/*.parquet')")
    assert agree("op13_codes", folder, con) == len(rows) - 5
    short = [(600, [0.1, 0.2], 1, 1, "x", 2, 3), (601, [0.1] * 65, 1, 1, "x", 2, 3)]
    folder, con = tables(embeddings=(EMB, rows + short))
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT vec_id, embedding, label FROM read_parquet('{folder}/embeddings.parquet/*.parquet')")
    assert agree("op12_lloyd", folder, con) == len(rows) - 5
    few, con = tables(embeddings=("vec_id long, embedding array<float>, label int", [r[:3] for r in rows[:30]]))
    assert agree("op12_lloyd", few, con) == 30 and agree("op13_codes", few, con) == 30


def test_codes_of_other_lengths(spark):
    rows = [(i, [0.1 * i, 0.2, -0.3 * i, 0.1, 0.5, 0.0], 1) for i in range(5)] + [(9, [1.0, 2.0], 1), (10, [0.5], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in pq.compression_report(df).collect()}
    assert set(got) == set(range(5)) and all(r.error == 0 and len(r.code) == 8 for r in got.values())


def test_cells_keep_every_nearest_entry():
    rng = np.random.default_rng(3)
    for width in (1, 7, 40, 1000):
        entries = rng.integers(-60, 60, (90, 5))
        entries[50] = entries[20]  # ties go to the lower index
        parts = np.concatenate([rng.integers(-90, 90, (700, 5)), entries, (entries[:40] + entries[40:80]) // 2])
        memo = pq.CellMemo(entries, width)
        index, distance = memo.nearest(parts)
        d = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (index == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
        made = memo.made
        memo.nearest(parts)
        assert memo.made == made and (width > 1 or min(map(len, memo.cells.values())) < 5)


def test_a_full_memory_of_cells_starts_anew(monkeypatch):
    monkeypatch.setattr(pq, "MEMO_CELLS", 16)
    monkeypatch.setattr(pq, "PAIRS", 90)
    rng = np.random.default_rng(4)
    entries, parts = rng.integers(-60, 60, (30, 4)), rng.integers(-60, 60, (300, 4))
    memo = pq.CellMemo(entries, 5)
    index, _ = memo.nearest(parts)
    assert (index == ((parts[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all() and len(memo.cells) <= 16


def test_any_number_of_blocks_gives_the_same_clusters(spark):
    df = read_table(spark, SF, "embeddings")
    runs = [sorted(map(tuple, lloyd.cluster_vectors(df, k=7, rounds=2, blocks=b)[0].collect())) for b in (1, 3)]
    assert runs[0] == runs[1] and len(runs[0]) == df.count()


def crowd(n, changed, seed, words=100):
    """Near copies of one text, ``changed()`` of whose words are new in each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(changed(rng)):
            w[rng.randrange(words)] = f"r{rng.randrange(10**9)}"
        out.append(" ".join(w))
    return out


def brute_classes(texts):
    sets = [frozenset(zip(*[t.split()[k:] for k in range(5)])) for t in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("changed", [lambda r: 2, lambda r: r.choice([0, 1, 2, 2, 3, 5, 9])])
def test_crowds_of_strangers_link_as_by_brute_force(spark, changed, monkeypatch):
    counts = []
    write = minhash.shared_table
    monkeypatch.setattr(minhash, "shared_table", lambda df, tag: counts.append((tag, write(df, tag))) or counts[-1][1])
    for n in (100, 300):
        texts = crowd(n, changed, n)
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        got = {r.id: r.class_id for r in minhash.near_duplicate_classes(df).collect()}
        assert [got[i] for i in range(n)] == brute_classes(texts)
    pairs = [t.count() for tag, t in counts if tag == "other-pairs"]
    assert pairs[1] < 4 * 300  # of 44,850 pairs


def test_pairs_just_above_the_threshold_in_a_mixed_bucket(spark):
    """Pairs of similarity 0.80 to 0.82 amid copies that are farther from both."""
    rng = random.Random(11)
    texts, pairs = [], []
    for p in range(25):
        base = [f"p{p}x{rng.randrange(10**6)}" for _ in range(204)]
        other = list(base)
        for i in range(4):
            other[20 + 45 * i] = f"new{i}p{p}"
        pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(base), " ".join(other)]
        for _ in range(4):
            far = list(base)
            for i in range(8):
                far[rng.randrange(204)] = f"far{rng.randrange(10**9)}"
            texts.append(" ".join(far))
    sets = [frozenset(zip(*[t.split()[k:] for k in range(5)])) for t in texts]
    assert all(0.80 <= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) <= 0.82 for a, b in pairs)
    got = {r.id: r.class_id for r in minhash.near_duplicate_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(got[a] == got[b] for a, b in pairs) and [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_differences_are_symmetric_differences():
    a, b = minhash.shingles("a b c d e a b c d e a b c d e f"), minhash.shingles("a b c d e a b c d e x")
    both = int(np.minimum(*(np.array([dict(zip(*t)).get(e, 0) for e in np.union1d(a[0], b[0])]) for t in (a, b))).sum())
    d = minhash.difference(a, b)
    assert len(set(d.tolist())) == len(d) == int(a[1].sum() + b[1].sum()) - 2 * both
    assert len(minhash.difference(a, a)) == 0 and set(d.tolist()) == set(minhash.difference(b, a).tolist())


def test_null_and_repeated_ids_are_judged_by_their_texts(tables, agree):
    base = " ".join(f"word{i}" for i in range(80))
    rows = [(4, base, None, "s", 1), (4, "x y z " * 9, None, "s", 1), (None, base + " tail", None, "s", 1), (None, "only here " * 5, None, "s", 1),
            (None, "only here " * 5, None, "s", 1), (7, base, None, "s", 1), (4, base, None, "s", 1), (None, None, None, "s", 1), (8, None, None, "s", 1),
            (8, None, None, "s", 1), (9, "x y z " * 9 + "end", None, "s", 1), (4, base + " more", None, "s", 1)]
    folder, con = tables(documents=(DOC, rows))
    assert agree("op2_minhash", folder, con) == len(rows)
    folder, con = tables(documents=(DOC, edge_documents()))
    assert agree("op2_minhash", folder, con) == len(edge_documents())
    from pyspark.sql import SparkSession

    docs = SparkSession.active().createDataFrame(rows, DOC)
    left = sorted(((r.doc_id, r.text) for r in minhash.dedup(docs).collect()), key=repr)
    kept_base = min((base, base + " more"), key=lambda t: __import__("hashlib").md5(t.encode()).hexdigest())
    assert left == sorted([(4, kept_base), (4, "x y z " * 9), (None, "only here " * 5), (None, None), (8, None), (8, None)], key=repr)


def test_mixing_tells_rows_of_one_id_apart(spark):
    rows = [(1, "a b c", None, "s", 1), (1, "x y z", None, "s", 1), (None, "q r s", None, "s", 1), (None, "t u v", None, "s", 1), (None, None, None, "t", 1)]
    got = mixing.mixed_documents(spark.createDataFrame(rows, DOC)).collect()
    taken = {r.text for r in got if r.source == "s"}
    assert taken == {"a b c", "x y z", "q r s", "t u v"}


def test_languages_by_brute_force_and_reruns_agree(spark):
    import math
    import unicodedata
    from collections import Counter

    from ledgerflow.llm import langid
    from ledgerflow.llm.common import fold
    from ledgerflow.llm.words import char_gram_slots, code_points

    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    train = docs.where(fold("doc_id", 4) != 2)
    model = langid.fit_languages(train)
    again = langid.fit_languages(train.repartition(7))
    assert model.languages == again.languages and (model.centroids == again.centroids).all() and (model.reach == again.reach).all()
    capped = langid.fit_languages(train.withColumn("doc_id", F.lit(None).cast("long")), rows_per_language=20)
    assert set(capped.languages) == set(model.languages)

    def grams(text):
        out, low = [], []
        for ch in " " + text + " ":
            letter = ch.isalpha()
            low.append((ch.lower() if len(ch.lower()) == 1 else ch) if letter else " ")
        s = "".join(c for i, c in enumerate(low) if c != " " or i == 0 or low[i - 1] != " ")
        for n in (2, 3):
            out += [int(x) for x in char_gram_slots(code_points(s), n, langid.BITS)]
        return Counter(out)

    rows = [r for r in docs.collect() if r.text and unicodedata.is_normalized("NFC", r.text)][:60]
    learned = [r.text for r in train.where("text is not null and lang is not null").collect()]
    df = Counter(g for t in learned for g in grams(t))
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    for r in rows:
        v = {g: math.log1p(n) * (math.log((len(learned) + 1) / (df[g] + 1)) + 1) for g, n in grams(r.text).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        cos = [sum(x * c[g] for g, x in v.items()) / size for c in model.centroids]
        assert got[r.doc_id].lang_pred == model.languages[int(np.argmax(cos))] and abs(got[r.doc_id].score - min(1, max(0, max(cos)))) < 1e-9


def test_words_of_letters_are_not_cut_and_kept_once():
    enc = tokenfiles.IdEncoder(tokenfiles.default_tokenizer())
    cut, pattern = [], enc.pattern
    enc.pattern = type("Counted", (), {"findall": lambda self, s: cut.append(s) or pattern.findall(s)})()
    text = "Hello world, it's naïve L'ÉTÉ x² ſtill rock'n'roll hello 12th don''s _a_"
    want = enc.lib.encode(text.replace("²", ""), add_special_tokens=False).ids
    assert np.frombuffer(enc.encode(text.replace("²", "")), enc.kind).tolist() == want
    assert "hello" not in cut and "naïve" not in cut and "world," in cut and "it's" in cut
    assert "hello" in enc.plain_ids and "world" in enc.plain_ids and not {"hello", "world"} & set(enc.piece_ids)
