"""Every query with SQL agrees with it: on the smallest tables, on edge tables and on empty ones."""

import pytest
from llm_data import DOC, edge_documents

from ledgerflow.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_small_tables(name, agree):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert agree(name, SF, con) > 0


def test_mixing_edges(tables, agree):
    folder, con = tables(documents=(DOC, edge_documents()))
    assert agree("op6_mixing", folder, con) == len(edge_documents())


def test_licenses_edges(tables, agree):
    docs = [(1, "Released under the MIT Licence!", None, None, None), (2, "x\n\nreleased UNDER the MIT license\ny", None, None, None),
            (3, None, None, None, None), (4, "", None, None, None), (5, "!!!", None, None, None),
            (6, Q.licenses.MIT_TEXT.replace("MIT License", "MIT License\n\nCopyright (c) 2020 Somebody") + "\n\n", None, None, None),
            (7, "Copyright 2021 X\nAll rights reserved.\n" + Q.licenses.ISC_TEXT.upper(), None, None, None), (None, "x" * 200_000, None, None, None)]
    folder, con = tables(documents=(DOC, docs + docs[:1]))
    agree("op7_licenses", folder, con)
    rows = [tuple(r) for r in Q.licenses.scan(session().read.parquet(f"{folder}/documents.parquet")).select("doc_id", "license", "notices", "n_notices").collect()]
    assert sorted(rows, key=str) == sorted([(1, "MIT", "", 0), (1, "MIT", "", 0), (2, None, "MIT", 1), (3, None, "", 0), (4, None, "", 0),
                                            (5, None, "", 0), (6, "MIT", "", 0), (7, "ISC", "", 0), (None, None, "", 0)], key=str)


def session():
    from pyspark.sql import SparkSession

    return SparkSession.active()


def test_url_edges(tables, agree):
    urls = [None, "", "no scheme", "http://", "http://ORG", "http://x.org/", "http://x.org", "https://a.Example.ORG/es/1?x#y", "http://example.org/en/1",
            "http://example.org/en/2#f", "http://notexample.org/es/1", "http://x.com/fr/9", "http://x.com/de/9", "http://x.com/de", "http://com/de/",
            "ftp://h/p?q://z", "http://a.b/" + "s" * 200_000, "http://h.net/a//b/", "http://é.com/FR/1"]
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(0, None, "again"), (None, "http://x.com/de/1", None)]
    rows += [(100 + i, f"http://many.com/de/p{'abcdefgh'[i % 8] * (i // 8 + 1)}/x", None) for i in range(64)]
    rows += [(300 + i, f"http://bad.com/{'de' if i % 20 else 'fr'}/{i}", None) for i in range(200)] + [(600, "http://bad.com/new/7", None)]
    folder, con = tables(pages=("page_id long, url string, html string", rows))
    assert agree("op9_urls", folder, con) == len(rows)
    got = {r["page_id"]: r for r in Q.QUERIES["op9_urls"](session(), folder).collect()}
    assert got[5]["rule"] == "org/" and got[6]["rule"] is None and got[7]["rule"] == "example.org/es/" and got[8]["verdict"] == "block"
    assert got[14]["rule"] == "com/de/" and got[13]["rule"] is None and got[600]["verdict"] == "block" and got[600]["rule"] is None


CONV = "conv_id long, turn long, role string, text string"


def test_quotes(tables, agree):
    rows = [
        (1, 0, "user", "Hello there.\nHow are you?"), (1, 1, "assistant", "Fine, thanks.\nAnd you?"),
        (1, 2, "user", "On Monday Bob wrote:\n> Fine, thanks.\n>> hello THERE\n>> how are you\nGood."),
        (1, 3, "user", "> And  you?\n> > How are you?\nwell"), (1, 4, "user", ">good.\nok"), (1, 5, "user", "ok"),
        (1, 6, "assistant", "> ok\n> never said\nwhat"), (2, 0, "user", "> ok\nnothing to find"), (None, 0, None, "alone"), (None, 1, None, "> alone\nyes"),
        (3, None, "user", "no turn"), (3, 0, "user", None), (3, 1, "user", ""), (3, 2, "user", "> \n>\n"), (3, 3, "u", "> a b\n> c\n\n\nx"), (4, 7, "u", "w " * 100_000),
    ]
    folder, con = tables(conversations=(CONV, rows))
    assert agree("op3_quotes", folder, con) == len(rows)
    got = {(r.conv_id, r.turn): r for r in Q.quotes.reply_ordered(session().read.parquet(f"{folder}/conversations.parquet")).collect()}
    assert (got[1, 2].reply_to, got[1, 2].thread, got[1, 2].text) == (1, 1, "Good.")
    assert (got[1, 3].reply_to, got[1, 4].reply_to, got[1, 4].thread, got[1, 6].reply_to) == (1, 2, 1, 5)
    assert [t for (c, t), r in sorted(got.items(), key=lambda x: x[1].position) if c == 1] == [0, 1, 2, 3, 4, 5, 6]


def test_quotes_at_deeper_levels_only(tables):
    rows = [
        (1, 0, "a", "the original words\nand more of them"), (1, 1, "b", "> the original words\nan answer in between"), (1, 2, "c", "something else"),
        (1, 3, "d", ">> the original words\nonly the deeper quote is left"), (1, 4, "e", "> > > something  ELSE\ndeeper still"),
        (1, 5, "f", ">> the original words\n>> and more of them\n> something else\nthe least level that links decides"),
        (1, 6, "g", "> was never said\n>> an answer in between\n>> something else\nthe level above links nothing"),
        (1, 7, "h", "> something else\n>> something else\none passage at two levels"), (2, 0, "a", ">> the original words\nanother conversation"),
    ]
    folder, _ = tables(conversations=(CONV, rows))
    got = {(r.conv_id, r.turn): r for r in Q.quotes.reply_ordered(session().read.parquet(f"{folder}/conversations.parquet")).collect()}
    assert {t: got[1, t].reply_to for t in range(8)} == {0: None, 1: 0, 2: None, 3: 0, 4: 2, 5: 2, 6: 1, 7: 2}
    assert [got[1, t].thread for t in range(8)] == [0, 0, 2, 0, 2, 2, 0, 2]
    counts = {k: (r.n_quotes, r.n_linked, r.n_nested, r.n_nested_linked) for k, r in got.items()}
    assert counts[1, 3] == (0, 0, 1, 1) and counts[1, 5] == (1, 1, 3, 3) and counts[1, 6] == (1, 0, 3, 2) and counts[1, 7] == (1, 1, 0, 0)
    assert counts[2, 0] == (0, 0, 1, 0) and got[2, 0].reply_to is None and got[1, 3].text == "only the deeper quote is left"
    # The registered query links them as well.
    assert {r.turn: r.reply_to for r in Q.QUERIES["op3_quotes"](session(), folder).where("conv_id = 1").collect()}[3] == 0


def test_quotes_over_many_turns(tables, agree):
    rows = [(1, t, "u", f"> line {t - 300}\nline {t}\ncommon" if t >= 300 else f"line {t}\ncommon") for t in range(900)]
    rows += [(1, 1000 + t, "u", "> common\nyes") for t in range(40)]
    folder, con = tables(conversations=(CONV, rows))
    assert agree("op3_quotes", folder, con) == 940


def test_embedding_edges(tables, agree):
    import numpy as np

    rng = np.random.default_rng(3)
    rows, base = [], rng.standard_normal((40, 16))
    for i in range(300):
        v = base[i % 40] + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.25])
        rows.append((i, [float(np.float32(x)) for x in v], 1))
    rows += [(1000, rows[0][1], 2), (1001, rows[0][1], 3), (1002, [2 * x for x in rows[1][1]], 0)]
    folder, con = tables(embeddings=("vec_id long, embedding array<float>, label int", rows))
    assert agree("op1_embeddings", folder, con) == len(rows)


def test_minhash_edges(tables, agree, spark):
    import random

    rnd = random.Random(5)
    docs, words = [], [f"w{i}" for i in range(400)]
    for i in range(60):
        ws = rnd.choices(words, k=rnd.choice([3, 30, 200, 600]))
        docs.append((10 * i, " ".join(ws), None, "s", None))
        for k in range(rnd.choice([0, 1, 3])):
            w2 = list(ws)
            for _ in range(rnd.choice([0, 1, 2, 8])):
                w2[rnd.randrange(len(w2))] = "new"
            docs.append((10 * i + k + 1, ("\n" if k else " ").join(w2), None, "s", None))
    docs += [(5000, None, None, None, None), (5001, "", None, None, None), (5002, " ", None, None, None), (5003, "w " * 50_000, None, None, None),
             (5004, "w " * 50_001, None, None, None)]
    folder, con = tables(documents=(DOC, docs))
    agree("op2_minhash", folder, con)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_empty_tables(name, tables, agree):
    folder, con = tables(documents=(DOC, []), embeddings=("vec_id long, embedding array<float>, label int", []),
                         pages=("page_id long, url string, html string", []), conversations=(CONV, []))
    assert agree(name, folder, con) == 0


def test_every_licence_line_of_the_given_documents_is_found(spark):
    """Looked up by their wording, not by the list: no licence line may lack a notice."""
    import re

    from ledgerflow.llm.common import read_table

    for sf in (SF, "/root/testdata/sf0.01"):
        docs = read_table(spark, sf, "documents").select("doc_id", "text")
        want = {}
        for d, text in docs.where("text rlike '(?i)licen[sc]e'").collect():
            lines = [x for x in text.split("\n") if re.search(r"(?i)\b(?:licen[sc]ed|released) under\b", x)]
            if lines and "\n" in text:
                want[d] = len(lines)
        got = {r.doc_id: r for r in Q.licenses.scan(docs).collect()}
        assert want and {d: got[d].n_notices for d in want} == want
        assert any("CC-BY-NC-4.0" in got[d].notices for d in want)


def test_entire_licence_texts(spark):
    from ledgerflow.llm import license_texts as T

    def rewrap(text):  # one line a paragraph, under somebody's copyright line
        return "Copyright (c) 2020 Somebody\n\n" + "\n\n".join(" ".join(p.split()) for p in text.split("\n\n"))

    mit = Q.licenses.MIT_TEXT
    texts = [("MIT", mit.replace("MIT License", "")), ("MIT", mit.replace("MIT License", "The MIT License (MIT)\n\nCopyright (c) 2021 X")),
             ("ISC", "ISC License\n\n" + Q.licenses.ISC_TEXT), ("BSD-2-Clause", T.bsd(2)[0]), ("BSD-3-Clause", T.bsd(3)[-1])]
    texts += [(n, t) for n, t, _, _ in T.PUBLISHED] + [("Apache-2.0", T.APACHE_2.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 Somebody"))]
    texts += [("GPL-2.0", T.GPL_2[: T.GPL_2.index("How to Apply")]), ("GPL-3.0", T.GPL_3[T.GPL_3.index("Everyone"):])]
    rows = [(i, t if i % 2 else rewrap(t)) for i, (_, t) in enumerate(texts)] + [(100 + i, t) for i, (_, t) in enumerate(texts)]
    got = {r.doc_id: r.license for r in Q.licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: texts[d % 100][0] for d, _ in rows}


def test_equal_turns_keep_their_own_threads(tables, agree):
    rows = [(1, 0, "a", "the first words"), (1, 1, "b", "other words"), (1, 2, "a", "> the first words\nyes"), (1, 2, "b", "nothing quoted here"),
            (1, 2, "c", "> other words\nno"), (1, 3, "d", "> nothing quoted here\nso"), (1, 4, "e", ">> other words\n> yes\nboth"),
            (1, 5, "f", "> > other  words\nonly the deeper one")] + [(1, None, "x", f"> the first words\nlost {i}") for i in range(3)]
    folder, con = tables(conversations=(CONV + ", thread long, position long, row long", [(*r, 7, 7, 7) for r in rows]))
    assert agree("op3_quotes", folder, con) == len(rows)
    got = {(r.turn, r.role): r for r in Q.quotes.reply_ordered(session().read.parquet(f"{folder}/conversations.parquet")).collect() if r.turn is not None}
    assert (got[2, "a"].thread, got[2, "b"].thread, got[2, "b"].reply_to, got[2, "c"].thread) == (0, 2, None, 1)
    assert got[4, "e"].reply_to == 2 and got[5, "f"].reply_to == 1 and got[5, "f"].n_nested == got[5, "f"].n_nested_linked == 1


def test_deep_templates_speak(tables, agree):
    rows = [(i, f"http://deep.net/a/b/c/{'spam' if i % 2 else 'good'}/w{'abcdefghij'[i % 10]}{'x' * (i // 10)}", None, i % 2, 1, 2) for i in range(200)]
    schema = "page_id long, url string, html string, blocked int, host long, path long"
    folder, con = tables(pages=(schema, rows))
    assert agree("op9_urls", folder, con) == len(rows)
    pages = session().read.parquet(f"{folder}/pages.parquet")
    new = session().createDataFrame([(900, "http://deep.net/a/b/c/spam/unseen", None, None, 1, 2), (901, "http://deep.net/a/b/c/good/unseen", None, None, 1, 2),
                                     (902, "http://deep.net/" + "/".join("s" * 900), None, None, 1, 2)], schema)
    got = {r.page_id: r for r in Q.urls.judge(pages.union(new), label_col="blocked").collect()}
    assert all(got[i].verdict == ("block" if i % 2 else "allow") for i in range(200))
    assert got[900].verdict == "block" and got[901].verdict == "allow" and got[900].template == "a/b/c/spam/*" and got[902].verdict == "allow"


def test_embedding_edges(tables, agree):
    import numpy as np

    rng = np.random.default_rng(6)
    a, b = rng.standard_normal(8), rng.standard_normal(16)
    near = [(a + 0.05 * rng.standard_normal(8)).tolist() for _ in range(6)] + [(b + 0.05 * rng.standard_normal(16)).tolist() for _ in range(6)]
    vecs = [*near, a.tolist(), a.tolist(), (3 * a).tolist(), (-a).tolist()]
    rows = [(i, [float(x) for x in v], i % 2, 1, "h", 0, [1]) for i, v in enumerate(vecs)]
    bad = [(100, None), (101, []), (102, [0.0] * 8), (103, [None] * 8), (104, [float("nan")] * 8), (105, [float("inf")] + [0.0] * 7)]
    schema = "vec_id long, embedding array<double>, label int, n long, h string, kept int, cells array<int>"
    df = session().createDataFrame(rows + [(*r, 1, 1, "h", 0, [1]) for r in bad], schema)
    got = {r.vec_id: r for r in Q.embeddings.near_duplicates(df).collect()}
    cos = {(i, j): np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v) for i, u in enumerate(map(np.array, vecs)) for j, v in enumerate(map(np.array, vecs))
           if len(u) == len(v) and i != j}
    for i in range(len(vecs)):
        assert got[i].n_links == sum(c >= 0.95 for (x, _), c in cos.items() if x == i)
    assert all((got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (0, r[0], True) for r in bad)
