"""Chat formatting by quotation linking.

The lines of a message are parsed into quote levels (the number of leading ``>``,
blanks allowed between them) and cut into passages: runs of lines of one level
without a blank line.  Every passage, and every line of a longer passage, is
normalised (lower case, runs of other characters than letters and digits as one
space) and hashed.  Passages quoted at any level are joined by hash to the unquoted
passages of earlier messages of the conversation; of several messages that said
the same the latest earlier one counts.  The least level with a link decides: a
message answers the one of which it quotes most characters there (the latest of
equals), so deeper quotes speak only where the levels above them link nothing.  A
passage that a message quotes at several levels counts at the least.  Messages linked this way form
threads; a conversation lists its threads by their first turn and the messages
of a thread by turn, so that every reply comes after what it answers, and each
message keeps only its own text: no quoted lines, no attribution line.

Only DataFrame functions are used.  Nothing gathers a conversation in one task:
the latest earlier speaker of a passage is found per block of ``TURNS`` turns plus
a carry over blocks, a message's place from counts per block of threads, per
block of a thread's turns, and inside such a block.  Unquoted passages that nobody
quotes leave before the join.

Defined results: a null text is an empty message; messages without quotes start
a thread of their own, also beside one of the same turn that answers something; an answer to a turn
that several messages share joins the least thread that one of them is in; a null conversation id is a conversation like any other;
messages without a turn come last and answer nothing; repeated rows are messages
of their own, one after the other; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import setup, shared_table

TURNS = 256
QUOTE = r"^[ \t]*>(?:[ \t]*>)*[ \t]?"
ATTRIBUTION = r"^(?:on|am|le|el) .* (?:wrote|schrieb|a écrit|escribió)[ \t]*:[ \t\r]*$"


def level_of(line: Column) -> Column:
    """Number of quote marks in front of a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), "[^>]", ""))


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def own_text(text: Column) -> Column:
    """A message without quoted lines and, if it quotes anything, without attribution lines."""
    lines = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(QUOTE) & ~F.lower(x).rlike(ATTRIBUTION))
    quotes = text.rlike("(?m)" + QUOTE)
    return F.when(quotes, F.regexp_replace(F.array_join(lines, "\n"), r"^\s+|\s+$", "")).otherwise(F.coalesce(text, F.lit("")))


def passages(messages: DataFrame) -> DataFrame:
    """``(row, conv, turn, level, h, chars)`` of every passage and every line of the
    messages ``(row, conv, turn, text)``; wordless ones are left out."""
    lines = messages.select("row", "conv", "turn", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("level", level_of(F.col("line"))).withColumn("content", normal(F.regexp_replace("line", QUOTE, "")))
    order = Window.partitionBy("row").orderBy("pos")
    before = F.lag(F.struct("level", (F.col("content") == "").alias("blank"))).over(order)
    lines = lines.withColumn("cut", F.when(before.isNull() | (before["level"] != F.col("level")) | before["blank"] | (F.col("content") == ""), 1).otherwise(0))
    lines = lines.withColumn("run", F.sum("cut").over(order)).where("content <> ''")
    runs = lines.groupBy("row", "conv", "turn", "level", "run").agg(
        F.array_sort(F.collect_list(F.struct("pos", "content"))).alias("c"))
    runs = runs.select("row", "conv", "turn", "level", F.explode(F.when(F.size("c") > 1, F.concat(
        F.array(F.array_join(F.col("c.content"), " ")), F.col("c.content"))).otherwise(F.col("c.content"))).alias("content"))
    return runs.select("row", "conv", "turn", "level", F.md5(F.col("content").cast("binary")).alias("h"), F.length("content").alias("chars"))


def _answers(parts: DataFrame) -> DataFrame:
    """``(row, reply_to, n_linked, n_nested_linked)``: the turn each quoting message
    answers and its linked passages at level 1 and deeper."""
    quoted = shared_table(parts.where("level >= 1").groupBy("row", "conv", "turn", "h").agg(
        F.min("level").alias("level"), F.max("chars").alias("chars")), "quoted")
    wanted = quoted.select("conv", "h").distinct()
    said = parts.where("level = 0 and turn is not null").join(
        wanted.select(F.col("conv").alias("c2"), F.col("h").alias("h2")), F.col("conv").eqNullSafe(F.col("c2")) & (F.col("h") == F.col("h2")), "left_semi")
    events = said.select("conv", "h", "turn", F.col("turn").alias("said")).distinct().union(
        quoted.where("turn is not null").select("conv", "h", "turn", F.lit(None).cast("long").alias("said")).distinct())
    events = events.withColumn("block", F.floor(F.col("turn") / TURNS))
    inside = Window.partitionBy("conv", "h", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    blocks = events.groupBy("conv", "h", "block").agg(F.max("said").alias("last"))
    carried = F.max("last").over(Window.partitionBy("conv", "h").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(F.col("conv").alias("c2"), F.col("h").alias("h2"), F.col("block").alias("b2"), carried.alias("carried"))
    found = events.withColumn("near", F.max("said").over(inside)).where("said is null").join(
        blocks, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("h") == F.col("h2")) & (F.col("block") == F.col("b2")))
    found = found.select(F.col("conv").alias("c3"), F.col("h").alias("h3"), F.col("turn").alias("t3"),
                         F.coalesce("near", "carried").alias("said_at")).where("said_at is not null")
    hits = quoted.join(found, F.col("conv").eqNullSafe(F.col("c3")) & (F.col("h") == F.col("h3")) & (F.col("turn") == F.col("t3")))
    votes = hits.groupBy("row", "level", "said_at").agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct((-F.col("level")).alias("near"), "chars", "said_at"))["said_at"]
    return votes.groupBy("row").agg(best.alias("reply_to"), _at_first("n").alias("n_linked"), _nested("n").alias("n_nested_linked"))


def _at_first(n: str) -> Column:
    return F.sum(F.when(F.col("level") == 1, F.col(n)).otherwise(0))


def _nested(n: str) -> Column:
    return F.sum(F.when(F.col("level") > 1, F.col(n)).otherwise(0))


def _threads(linked: DataFrame) -> DataFrame:
    """``(conv, turn, thread)`` of turns that answer another one (the least, if several messages do),
    by pointer doubling."""
    now = shared_table(linked.groupBy("conv", "turn").agg(F.min("reply_to").alias("up")), "replies")
    while True:
        up = now.select(F.col("conv").alias("c2"), F.col("turn").alias("t2"), F.col("up").alias("up2"))
        nxt = now.join(up, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("up") == F.col("t2")), "left")
        nxt = shared_table(nxt.select("conv", "turn", F.coalesce("up2", "up").alias("up"), F.col("up2").isNotNull().alias("moved")), "thread-step")
        if nxt.where("moved").isEmpty():
            return now.select("conv", "turn", F.col("up").alias("thread"))
        now = nxt.select("conv", "turn", "up")


def _placed(rows: DataFrame) -> DataFrame:
    """Adds ``position`` (from 0) in the order (thread, turn, row) of each conversation."""
    last = F.lit(1 << 62)  # messages without a turn come last
    rows = rows.withColumn("c", F.struct("conv")).withColumn("tk", F.coalesce("thread", last)).withColumn("uk", F.coalesce("turn", last))
    # Messages without a turn stand in the order of their rows, so blocks of rows split them.
    block = F.when(F.col("turn").isNull(), F.floor(F.col("row") / TURNS)).otherwise(F.floor(F.col("uk") / TURNS))
    rows = rows.withColumn("far", F.floor(F.col("tk") / TURNS)).withColumn("near", F.struct("tk", F.col("turn").isNull().alias("no_turn"), block.alias("b")))

    def earlier(over: list[str], key: str, name: str) -> DataFrame:
        """Rows in front of each ``key`` within ``over``, from counts."""
        n = rows.groupBy(*over, key).agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy(*over).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        return n.select(*[F.col(x).alias(x + name) for x in [*over, key]], F.coalesce(F.sum("n").over(w), F.lit(0)).alias(name))

    blocks = earlier(["c"], "far", "_p")
    parts = earlier(["c", "far"], "near", "_q")
    rows = rows.join(blocks, (F.col("c") == F.col("c_p")) & (F.col("far") == F.col("far_p")))
    rows = rows.join(parts, (F.col("c") == F.col("c_q")) & (F.col("far") == F.col("far_q")) & (F.col("near") == F.col("near_q")))
    here = F.row_number().over(Window.partitionBy("c", "far", "near").orderBy("uk", "row")) - 1
    return rows.withColumn("position", F.col("_p") + F.col("_q") + here)


def reply_ordered(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``(conv_id, position, turn, role, text, reply_to, thread, n_quotes, n_linked,
    n_nested, n_nested_linked)``: every message's own text and its place in its
    conversation; ``reply_to`` is the turn it answers, ``thread`` the first turn of
    its thread, ``n_quotes`` the passages it quotes at level 1 and ``n_linked`` those
    found, ``n_nested`` and ``n_nested_linked`` the same of those it quotes deeper only."""
    setup(messages.sparkSession)
    rows = shared_table(messages.select(F.monotonically_increasing_id().alias("row"), F.col(conv_col).alias("conv"),
                                        F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"),
                                        F.col(text_col).alias("text")), "messages")
    quoting = rows.select("row", "conv").where(F.col("text").rlike("(?m)" + QUOTE))
    convs = quoting.select(F.col("conv").alias("c2")).distinct()
    # Only conversations in which somebody quotes are cut into passages.
    parts = shared_table(passages(rows.join(convs, F.col("conv").eqNullSafe(F.col("c2")), "left_semi")), "passages")
    answers = shared_table(_answers(parts), "answers")
    n_quotes = parts.where("level >= 1").groupBy("row", "h").agg(F.min("level").alias("level")).withColumn("n", F.lit(1)).groupBy(
        F.col("row").alias("r2")).agg(_at_first("n").alias("n_quotes"), _nested("n").alias("n_nested"))
    rows = rows.join(answers.withColumnRenamed("row", "r1"), F.col("row") == F.col("r1"), "left").join(n_quotes, F.col("row") == F.col("r2"), "left")
    threads = _threads(rows.where("reply_to is not null").select("conv", "turn", "reply_to")).select(
        F.col("conv").alias("c3"), F.col("turn").alias("t3"), "thread")
    # A message's thread is that of the turn it answers, whatever others of its own turn do.
    rows = rows.join(threads, F.col("conv").eqNullSafe(F.col("c3")) & (F.col("reply_to") == F.col("t3")), "left")
    counts = ["n_quotes", "n_linked", "n_nested", "n_nested_linked"]
    rows = _placed(rows.select("row", "conv", "turn", "role", own_text(F.col("text")).alias("text"), "reply_to",
                               F.coalesce("thread", "reply_to", "turn").alias("thread"), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts]))
    return rows.select(F.col("conv").alias("conv_id"), "position", "turn", "role", "text", "reply_to", "thread", *counts)
