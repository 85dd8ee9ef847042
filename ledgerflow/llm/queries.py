"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator, with the production parameters, to the whole of
its table.  Queries that learn a model or follow a published tokenizer have no
SQL; the tests hold them against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import embeddings, langid, licenses, lloyd, minhash, mixing, pq, quality, quotes, spm, tokenfiles, toxicity, urls
from ledgerflow.llm.common import fold, read_table, shared_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn

    return deco


@query("op2_minhash", r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS i, doc_id, md5(text) AS x, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT i, array_to_string(w[k:k + 4], ' ') AS s FROM (
        SELECT i, w, unnest(range(1, greatest(2, len(w) - 3))) AS k FROM d WHERE len(w) > 0)),
c AS (SELECT i, s, count(*) AS n FROM s GROUP BY 1, 2),
t AS (SELECT i, sum(n) AS n FROM c GROUP BY 1),
m AS (SELECT a.i AS a, b.i AS b, sum(least(a.n, b.n)) AS n FROM c a JOIN c b ON a.s = b.s AND a.i < b.i GROUP BY 1, 2),
l AS (SELECT m.a, m.b FROM m JOIN t x ON x.i = m.a JOIN t y ON y.i = m.b WHERE m.n >= 0.8 * (x.n + y.n - m.n)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT i AS a, i AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
z AS (SELECT r.a, min(row(y.doc_id IS NULL, coalesce(y.doc_id, 0), y.x)) AS least, min(y.doc_id) AS class_id FROM r JOIN d y ON y.i = r.b GROUP BY r.a)
SELECT doc_id, class_id, coalesce(least = row(doc_id IS NULL, coalesce(doc_id, 0), x), true) AS kept FROM z JOIN d ON d.i = z.a
""")
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document; the document of the least id is kept."""
    got = minhash.near_duplicate_classes(read_table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "class_id", "kept")


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the 32k piece model, as digests, with
    the bytes its spans cover."""
    return spm.encode_digests(read_table(spark, sf_dir, "documents"))


MIX_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        md5('mix' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
p AS (SELECT source, sum(size)::DOUBLE AS size, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
      FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY 2 * size / w, encode(source) NULLS LAST) AS i FROM p),
lv AS (SELECT *, (1.5 * sum(size) OVER () - coalesce(sum(2 * size) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM o),
g AS (SELECT source, size, CASE WHEN level * w >= 2 * size THEN 2 * size
        ELSE max(CASE WHEN level * w < 2 * size THEN level END) OVER () * w END AS target FROM lv),
q AS (SELECT d.*, g.size AS source_size, g.target, sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST, d.size ROWS UNBOUNDED PRECEDING) AS done,
        row_number() OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST, d.size) AS nth
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
u AS (SELECT *, CASE WHEN target > 0 THEN (epoch * source_size + done) / target ELSE 0 END AS finish FROM q, (VALUES (0), (1)) AS e(epoch)),
z AS (SELECT *, sum(size) OVER (ORDER BY finish, encode(source) NULLS LAST, epoch, done, k, doc_id NULLS LAST, nth ROWS UNBOUNDED PRECEDING) AS place FROM u)
SELECT doc_id, any_value(size) AS size, any_value(source_size)::BIGINT AS source_size, any_value(target) AS target,
       (sum(CASE WHEN place <= (SELECT sum(target) FROM g) + 1e-6 THEN size ELSE 0 END))::BIGINT AS taken
FROM z GROUP BY source, nth, doc_id
"""


@query("op6_mixing", MIX_SQL)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target weights."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"), learn=lambda c: fold(c, 5) != 0)
    got = toxicity.score_toxicity(docs, model)
    return got.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of the quality rules for every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline of ``corpus_pipeline.py`` from documents to token ids."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query("op1_embeddings", r"""
WITH RECURSIVE v AS (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings WHERE embedding IS NOT NULL),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT r.a AS vec_id, (SELECT count(*) FROM l WHERE l.a = r.a) AS n_links, min(r.b) AS component_id, min(r.b) = r.a AS kept
FROM r GROUP BY r.a
""")
def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query("op4_langid")
def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    got = langid.identify(docs, langid.fit_languages(docs.where(fold("doc_id", 4) != 2)))
    return got.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


QUOTES_SQL = rf"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS r, conv_id, turn, role, text FROM conversations),
l AS (SELECT r, conv_id, turn, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM (SELECT *, string_split(text, chr(10)) AS ls FROM m)),
c AS (SELECT *, len(regexp_replace(regexp_extract(line, '{quotes.QUOTE}'), '[^>]', '', 'g')) AS level,
             trim(regexp_replace(lower(regexp_replace(line, '{quotes.QUOTE}', '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS content FROM l),
b AS (SELECT *, lag(level) OVER w AS pl, lag(content) OVER w AS pc FROM c WINDOW w AS (PARTITION BY r ORDER BY pos)),
n AS (SELECT *, sum(CASE WHEN pl IS NULL OR pl <> level OR pc = '' OR content = '' THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY pos) AS run FROM b),
g AS (SELECT r, conv_id, turn, level, list(content ORDER BY pos) AS cs FROM n WHERE content <> '' GROUP BY r, conv_id, turn, level, run),
p AS (SELECT r, conv_id, turn, level, unnest(CASE WHEN len(cs) > 1 THEN list_prepend(array_to_string(cs, ' '), cs) ELSE cs END) AS content FROM g),
q AS (SELECT r, conv_id, turn, content, min(level) AS level FROM p WHERE level >= 1 GROUP BY r, conv_id, turn, content),
f AS (SELECT q.r, q.content, q.level, max(s.turn) AS said FROM q JOIN p s ON s.content = q.content AND s.conv_id IS NOT DISTINCT FROM q.conv_id
      WHERE s.level = 0 AND s.turn < q.turn GROUP BY q.r, q.content, q.level),
v AS (SELECT r, level, said, sum(len(content)) AS chars, count(*) AS n FROM f GROUP BY r, level, said),
a AS (SELECT r, (max({{'near': -level, 'chars': chars, 'said': said}})).said AS reply_to, coalesce(sum(n) FILTER (WHERE level = 1), 0)::BIGINT AS n_linked,
             coalesce(sum(n) FILTER (WHERE level > 1), 0)::BIGINT AS n_nested_linked FROM v GROUP BY r),
e AS (SELECT conv_id, turn, min(reply_to) AS up FROM m JOIN a USING (r) GROUP BY conv_id, turn),
t AS (SELECT conv_id, turn, up FROM e
      UNION SELECT t.conv_id, t.turn, e.up FROM t JOIN e ON e.conv_id IS NOT DISTINCT FROM t.conv_id AND e.turn = t.up),
h AS (SELECT conv_id, turn, min(up) AS thread FROM t GROUP BY conv_id, turn),
k AS (SELECT r, count(*) FILTER (WHERE level = 1) AS n_quotes, count(*) FILTER (WHERE level > 1) AS n_nested FROM q GROUP BY r),
o AS (SELECT m.r, m.conv_id, m.turn, m.role, a.reply_to, coalesce(h.thread, a.reply_to, m.turn) AS thread, coalesce(n_quotes, 0) AS n_quotes,
        coalesce(n_linked, 0) AS n_linked, coalesce(n_nested, 0) AS n_nested, coalesce(n_nested_linked, 0) AS n_nested_linked,
        CASE WHEN regexp_matches(text, '(?m){quotes.QUOTE}') THEN regexp_replace(array_to_string(
          [x FOR x IN string_split(text, chr(10)) IF NOT regexp_matches(x, '{quotes.QUOTE}') AND NOT regexp_matches(lower(x), '{quotes.ATTRIBUTION}')], chr(10)),
          '^\s+|\s+$', '', 'g') ELSE coalesce(text, '') END AS own
      FROM m LEFT JOIN a USING (r) LEFT JOIN k USING (r) LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM m.conv_id AND h.turn = a.reply_to)
SELECT conv_id, turn, role, reply_to, thread, row_number() OVER (PARTITION BY conv_id ORDER BY thread NULLS LAST, turn NULLS LAST, r) - 1 AS position,
       n_quotes, n_linked, n_nested, n_nested_linked, md5(own) AS text_md5
FROM o
"""


@query("op3_quotes", QUOTES_SQL)
def op3_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply-ordered conversations without quotes; texts as digests."""
    got = quotes.reply_ordered(read_table(spark, sf_dir, "conversations"))
    return got.select("conv_id", "turn", "role", "reply_to", "thread", "position", "n_quotes", "n_linked", "n_nested", "n_nested_linked",
                      F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _licenses_sql() -> str:
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def canonical(x: str) -> str:
        c = f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        c = f"regexp_replace({c}, '(?m){licenses.COPYRIGHT_LINE}', ' ', 'g')"
        c = f"' ' || regexp_replace({c}, '[^a-z0-9]+', ' ', 'g') || ' '"
        for a, b in licenses.EQUIVALENT:
            c = f"replace({c}, ' {a} ', ' {b} ')"
        return f"md5(nullif(trim({c}), ''))"

    known = ", ".join(f"({i}, {text(n)}, {text(t)})" for i, (n, t) in enumerate(licenses.KNOWN))
    return f"""
WITH known AS (SELECT digest, arg_min(license, i) AS license FROM (
       SELECT i, license, {canonical('known_text')} AS digest FROM (VALUES {known}) AS t(i, license, known_text)) GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
p AS (SELECT r, doc_id, true AS entire, text AS part FROM d
      UNION ALL SELECT r, doc_id, false, unnest(string_split(text, chr(10))) FROM d WHERE contains(text, chr(10))
      UNION ALL SELECT * FROM (SELECT r, doc_id, false, unnest(string_split_regex(text, '{licenses.PARAGRAPH_BREAK}')) AS part
                               FROM d WHERE regexp_matches(text, '{licenses.PARAGRAPH_BREAK}')) WHERE contains(part, chr(10))),
h AS (SELECT r, doc_id, entire, {canonical('part')} AS digest FROM p),
j AS (SELECT h.*, known.license FROM h LEFT JOIN known USING (digest))
SELECT doc_id, max(CASE WHEN entire THEN digest END) AS digest, max(CASE WHEN entire THEN license END) AS license,
       coalesce(array_to_string(list_sort(list(DISTINCT license) FILTER (NOT entire AND license IS NOT NULL)), ','), '') AS notices,
       count(license) FILTER (NOT entire) AS n_notices
FROM j GROUP BY r, doc_id
"""


@query("op7_licenses", _licenses_sql())
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that the entire text, or an entire line or paragraph, of each document is."""
    return licenses.scan(read_table(spark, sf_dir, "documents"))


#: Depth of the SQL's tree; the operator goes as deep as the templates, the given ones have two segments.
URL_SQL_LEVELS = 6


def _urls_sql() -> str:
    fit = "\n         ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'rule': '{h + p}', 'verdict': '{v}'}}"
                            for h, p, v in sorted(urls.RULES, key=lambda r: (-len(r[0] + r[1]), r)))
    levels = [*range(1, URL_SQL_LEVELS + 1), "leaf"]

    def key(d) -> str:
        return "''" if d == 0 else "array_to_string(t, '/')" if d == "leaf" else f"array_to_string(t[1:{d}], '/')"

    widen = []
    for at in range(1, URL_SQL_LEVELS + 1):
        widen.append(f"""k{at} AS (SELECT host, array_to_string(t[1:{at - 1}], '/') AS parent, t[{at}] AS kid, sum(n) AS n FROM g{at - 1}
       WHERE len(t) >= {at} GROUP BY 1, 2, 3),
w{at} AS (SELECT host, parent FROM k{at} WHERE kid <> '*' GROUP BY 1, 2
       HAVING count(*) >= {urls.MANY_CHILDREN} AND sum(n) < {urls.FEW_PAGES} * count(*)),
g{at} AS (SELECT g.* REPLACE (CASE WHEN w.host IS NOT NULL THEN list_concat(list_concat(t[1:{at - 1}], ['*']), t[{at + 1}:]) ELSE t END AS t)
       FROM g{at - 1} g LEFT JOIN w{at} w ON g.host = w.host AND array_to_string(t[1:{at - 1}], '/') = w.parent AND len(t) >= {at})""")
    sums = ", ".join(f"sum(labelled) OVER (PARTITION BY host, {key(d)}) AS n{d}, sum(blocked) OVER (PARTITION BY host, {key(d)}) AS b{d}"
                     for d in [0, *levels])
    chosen, n, b, at = [], "n0", "b0", "s"
    for d in levels:
        p = f"(({b} + 1.0) / ({n} + 2.0))"
        apart = f"(CASE WHEN n{d} > 0 THEN abs(b{d}::DOUBLE / n{d} - {p}) / sqrt({p} * (1.0 - {p}) / n{d}) >= {urls.Z} ELSE false END)"
        chosen.append(f"c{d} AS (SELECT *, CASE WHEN {apart} THEN n{d} ELSE {n} END AS en{d}, CASE WHEN {apart} THEN b{d} ELSE {b} END AS eb{d} FROM {at})")
        n, b, at = f"en{d}", f"eb{d}", f"c{d}"
    return rf"""
WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
x AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
y AS (SELECT *, CASE {fit} END AS r,
             [CASE WHEN regexp_matches(s, '[0-9]') OR len(s) > {urls.LONG_SEGMENT} THEN '*' ELSE s END FOR s IN string_split(path, '/') IF s <> ''] AS lex FROM x),
z AS (SELECT *, CASE WHEN r IS NULL THEN NULL WHEN r.verdict = 'block' THEN 1 ELSE 0 END AS label FROM y),
g0 AS (SELECT host, lex, lex AS t, count(*) AS n, count(label) AS labelled, coalesce(sum(label), 0) AS blocked FROM z GROUP BY host, lex),
{", ".join(widen)},
s AS (SELECT *, {sums} FROM g{URL_SQL_LEVELS}),
{", ".join(chosen)},
o AS (SELECT sum(blocked) AS b_all, sum(labelled) AS n_all FROM g0),
f AS (SELECT host, lex, array_to_string(t, '/') AS template,
        ({b} + {urls.PRIOR} * ((b0 + {urls.PRIOR} * (CASE WHEN n_all > 0 THEN b_all::DOUBLE / n_all ELSE 0.0 END)) / (n0 + {urls.PRIOR}))) / ({n} + {urls.PRIOR}) AS purity
      FROM {at}, o)
SELECT page_id, z.host, path, r.rule AS rule, coalesce(r.verdict, CASE WHEN purity >= {urls.REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
       template, purity
FROM z JOIN f ON z.host = f.host AND z.lex = f.lex
"""


@query("op9_urls", _urls_sql())
def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return urls.judge(read_table(spark, sf_dir, "pages"))


@query("op11_tokenfiles")
def op11_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as seekable files and read back from them."""
    path = shared_path(spark, "token-files")
    tokenfiles.write_token_files(read_table(spark, sf_dir, "documents"), path)
    return tokenfiles.stored_digests(spark, path)


def _whole_sql(scale: int) -> str:
    return f"[greatest(-{lloyd.LIMIT}, least({lloyd.LIMIT}, floor({scale} * x::DOUBLE)))::BIGINT FOR x IN embedding]"


_FINITE = "len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0"


def _rounds_sql(dim: int, rounds: int) -> str:
    """Rounds over parts p(r, j, p) from centroids c0(j, k, c): a{i} has the code m % 1024
    and the distance m // 1024 of every part, c{i} the centroids after i rounds."""
    out = []
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (SELECT r, j, min(list_sum([(p[i] - c[i]) * (p[i] - c[i]) FOR i IN range(1, {dim + 1})]) * 1024 + k) AS m
       FROM p JOIN c{i} USING (j) GROUP BY r, j)""")
        if i < rounds:
            out.append(f"""s{i} AS (SELECT j, m % 1024 AS k, i, sum(p[i]) AS s, count(*) AS n FROM a{i} JOIN p USING (r, j), range(1, {dim + 1}) t(i) GROUP BY 1, 2, 3),
m{i} AS (SELECT j, k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS moved FROM s{i} GROUP BY j, k),
c{i + 1} AS MATERIALIZED (SELECT c.j, c.k, coalesce(moved, c.c) AS c FROM c{i} c LEFT JOIN m{i} m ON m.j = c.j AND m.k = c.k)""")
    return ",\n".join(out)


@query("op12_lloyd", f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, {_whole_sql(lloyd.SCALE)} AS p
     FROM embeddings WHERE len(embedding) = {lloyd.DIM} AND {_FINITE}),
p AS (SELECT r, 0 AS j, p FROM v),
h AS (SELECT row_number() OVER (ORDER BY sha256('{lloyd.SEED}' || coalesce(vec_id::VARCHAR, '')), p) - 1 AS k, p AS c FROM v),
c0 AS MATERIALIZED (SELECT 0 AS j, k, c FROM h WHERE k < {lloyd.K}),
{_rounds_sql(lloyd.DIM, lloyd.ROUNDS)},
o AS (SELECT vec_id, (m % 1024)::INT AS cluster, (m // 1024)::BIGINT AS distance FROM a{lloyd.ROUNDS} JOIN v USING (r))
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM o JOIN c{lloyd.ROUNDS} ON k = cluster
""")
def op12_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after the production rounds."""
    return lloyd.cluster_report(read_table(spark, sf_dir, "embeddings"))


#: The given vectors have 64 components, so the SQL's parts have 16.
@query("op13_codes", f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, {_whole_sql(pq.SCALE)}) AS r, vec_id, label, {_whole_sql(pq.SCALE)} AS e
     FROM embeddings WHERE {_FINITE}),
p AS MATERIALIZED (SELECT r, j, e[j * 16 + 1:j * 16 + 16] AS p FROM v, range({pq.PARTS}) t(j)),
c0 AS MATERIALIZED (SELECT j, r - 1 AS k, p AS c FROM p WHERE r <= {pq.ENTRIES}),
{_rounds_sql(16, pq.ROUNDS)},
o AS (SELECT r, string_agg(printf('%02x', (m % 1024)::INT), '' ORDER BY j) AS code, sum(m // 1024)::BIGINT AS error FROM a{pq.ROUNDS} GROUP BY r),
b AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY j, k)) AS codebooks_sha256 FROM c{pq.ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o JOIN v USING (r), b
""")
def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and error of every vector."""
    return pq.compression_report(read_table(spark, sf_dir, "embeddings"))
