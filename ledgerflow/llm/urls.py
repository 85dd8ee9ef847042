"""URL filters: rules first, then a path-template tree with labelled purity.

Rules are ``(host, path)`` prefixes with a verdict; a rule fits its host and all
subdomains if the url's path starts with the rule's path, and the longest
fitting rule decides.  Urls no rule fits are judged by their template: segments
that vary (they hold a digit, or are longer than ``LONG_SEGMENT``) become ``*``,
and so do the children of a node that has at least ``MANY_CHILDREN`` different
ones with fewer than ``FEW_PAGES`` pages each on average.  The templates of a
host form a tree (host, every prefix of its segments, whole template).  A node whose
share of blocked pages does not differ significantly from its parent's (|z| below
``Z``; a node without labelled pages never differs) is merged into the parent, so
that the deepest significant node speaks for the template.  Its purity is the
blocked share smoothed towards the host's, and the host's towards the overall
share, each with ``PRIOR`` pseudo-pages; templates of purity ``REJECT`` or more
are blocked.  The labels are the verdicts of the rules, unless a label column
(1 block, 0 allow, null unknown) is given.

Only DataFrame operations are used.  Pages are reduced to (host, template)
counts by partial aggregation before anything else, so the tree is built from
the distinct templates, and one join brings the verdict back.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule and is judged as the template of the empty host; repeated rows are
judged each; without labelled pages every purity is 0; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import setup, shared_table

#: (host, path, verdict); the longest fitting rule wins.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
LONG_SEGMENT = 40
MANY_CHILDREN = 20
FEW_PAGES = 3.0
Z = 1.96
PRIOR = 10.0
REJECT = 0.8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """``struct(rule, verdict)`` of the longest fitting rule, or null."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def lexical_template(path: Column) -> Column:
    """Segments of a path, the variable ones as ``*``."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike("[0-9]") | (F.length(s) > LONG_SEGMENT), F.lit("*")).otherwise(s))


def _generalise(nodes: DataFrame, level: int) -> DataFrame:
    """Make the segment at ``level`` variable under parents with many rare children."""
    here = nodes.where(F.size("t") >= level)
    parent = F.concat_ws("/", F.slice("t", 1, level - 1))
    kids = here.groupBy("host", parent.alias("parent"), F.element_at("t", level).alias("kid")).agg(F.sum("n").alias("n"))
    wide = kids.where("kid <> '*'").groupBy("host", "parent").agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("n"))
    wide = wide.where((F.col("kids") >= MANY_CHILDREN) & (F.col("n") < FEW_PAGES * F.col("kids"))).select(
        F.col("host").alias("h2"), F.col("parent").alias("p2"))
    joined = nodes.join(wide, (F.col("host") == F.col("h2")) & (parent == F.col("p2")) & (F.size("t") >= level), "left")
    star = F.concat(F.slice("t", 1, level - 1), F.array(F.lit("*")), F.slice("t", level + 1, 1_000_000))
    return joined.withColumn("t", F.when(F.col("h2").isNotNull(), star).otherwise(F.col("t"))).drop("h2", "p2")


def template_purity(pages: DataFrame) -> DataFrame:
    """``(host, lex, template, purity)`` from ``(host, lex, label)`` rows, where
    ``lex`` is the lexical template as an array and ``label`` is 1, 0 or null."""
    leaf = pages.groupBy("host", "lex").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"),
                                            F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"))
    nodes = shared_table(leaf.withColumn("t", F.col("lex")), "templates")
    level = 1
    # A parent with many children at a level needs as many templates that reach it; there is none beyond this.
    while not nodes.where(F.size("t") >= level).groupBy("host").agg(F.count_distinct("t").alias("k")).where(F.col("k") >= MANY_CHILDREN).isEmpty():
        nodes = shared_table(_generalise(nodes, level), "generalised")
        level += 1
    nodes = shared_table(nodes.select(F.monotonically_increasing_id().alias("node"), "host", "lex", "t", "labelled", "blocked"), "template-nodes")

    # Every template belongs to the node of each of its prefixes, named by chained digests, and to its own.
    chain = F.aggregate("t", F.array(F.lit("")), lambda keys, s: F.concat(keys, F.array(F.md5(F.concat(F.element_at(keys, -1), F.lit("/"), s).cast("binary")))))
    chains = nodes.select("node", "host", "labelled", "blocked", chain.alias("chain"))
    leaf_depth = F.lit((1 << 31) - 1)
    member = ["node", "host", "depth", "key", "labelled", "blocked"]
    members = chains.select("node", "host", "labelled", "blocked", F.posexplode("chain").alias("depth", "key")).select(*member).union(
        chains.select("node", "host", "labelled", "blocked", leaf_depth.alias("depth"), F.element_at("chain", -1).alias("key")).select(*member))
    members = shared_table(members, "template-members")
    sums = members.groupBy("host", "depth", "key").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    paths = members.select("node", "host", "depth", "key").join(sums, ["host", "depth", "key"]).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("depth", "n", "b"))).alias("path"))

    def deeper(state, here):
        """The child speaks for the branch if its labels differ significantly from what stands above."""
        p = (state["b"] + 1.0) / (state["n"] + 2.0)
        n = F.nullif(here["n"], F.lit(0))
        z = F.abs(here["b"] / n - p) / F.sqrt(p * (1.0 - p) / n)
        apart = F.coalesce(z >= Z, F.lit(False))
        return F.struct(F.when(apart, here["n"]).otherwise(state["n"]).alias("n"), F.when(apart, here["b"]).otherwise(state["b"]).alias("b"))

    top = F.get("path", F.lit(0))
    spoken = F.aggregate(F.slice("path", 2, F.size("path")), F.struct(top["n"].alias("n"), top["b"].alias("b")), deeper)
    paths = paths.select("node", top["n"].alias("n0"), top["b"].alias("b0"), spoken.alias("s"))
    total = nodes.agg(F.sum("blocked").alias("b_all"), F.sum("labelled").alias("n_all"))
    out = nodes.select("node", "host", "lex", F.concat_ws("/", "t").alias("template")).join(paths, "node").crossJoin(F.broadcast(total))  # one row
    overall = F.coalesce(F.col("b_all") / F.nullif("n_all", F.lit(0)), F.lit(0.0))
    host = (F.col("b0") + PRIOR * overall) / (F.col("n0") + PRIOR)
    return out.select("host", "lex", "template", ((F.col("s.b") + PRIOR * host) / (F.col("s.n") + PRIOR)).alias("purity"))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", label_col: str | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)``, one row per page."""
    setup(pages.sparkSession)
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                        *([F.col(label_col).cast("int").alias("label")] if label_col else []))
    rows = rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    if not label_col:
        rows = rows.withColumn("label", F.when(F.col("r.verdict").isNotNull(), (F.col("r.verdict") == "block").cast("int")))
    rows = rows.withColumn("lex", lexical_template(F.col("path")))
    tree = shared_table(template_purity(rows.select("host", "lex", "label")), "purities").select(
        F.col("host").alias("h2"), F.concat_ws("/", "lex").alias("l2"), "template", "purity")
    out = rows.join(tree, (F.col("host") == F.col("h2")) & (F.concat_ws("/", "lex") == F.col("l2")), "left")
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "template", "purity")
