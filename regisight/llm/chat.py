"""Quotation linking of conversations (native).

Lines that begin with > are quotes; the number of > is their level. A run of lines of one level is a passage, the lines
between its blank ones are paragraphs. The white-space-normalised texts of passages, paragraphs and lines are hashed
(128 bits) and joined to those of the unquoted passages, paragraphs and lines of earlier messages of the same
conversation, so a quote that was wrapped anew is found by its paragraphs. A quoted line is held by an earlier message that
has its passage, its paragraph or the line itself. Each message's parent is the earlier message that holds the
most of its level-one quoted lines, then the most of all its quoted lines; the latest one of equals. A part of a
paragraph that was wrapped anew or edited is not found. The texts are returned without quotes, with the thread they
belong to and their depth in it. Ordering rows by (conv_id, thread, turn) is the reply order.

First the latest earlier holder of each line is found by an ordered aggregation per (conversation, hash). If one message is that of
all lines found, it is the parent, so lines that everybody has, as signatures, make no pairs. Only else
are all holders counted, and messages are proposed by a message's rarest lines, as many as needed to miss none;
messages of one huge conversation stay separate rows.

Defined results: a null text is empty; a message without quotes, or whose quotes match nothing, has no parent
and starts a thread; equal originals are told apart by turn (the latest earlier one counts); repeated rows (same
conversation and turn) are returned each, with the same link; rows with a null conversation or turn are returned without
a parent; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regisight.llm.common import materialise

QUOTE = r"^\s*(?:>\s?)+"


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, QUOTE, "")), r"\s+", " "))


def level(line: Column) -> Column:
    """Number of > that a line begins with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), r"[^>]", ""))


def quotation_lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, m, k, passage, level, body) of every line; passage numbers runs of one level. m tells messages apart
    that share a turn."""
    lines = messages.select("conv_id", "turn", F.md5(F.coalesce("text", F.lit(""))).alias("m"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("k", "line"))
    lines = lines.select("conv_id", "turn", "m", "k", level(F.col("line")).alias("level"), normalised(F.col("line")).alias("body"))
    order = Window.partitionBy("conv_id", "turn", "m").orderBy("k")
    starts = lines.withColumn("start", F.when(F.lag("level").over(order) == F.col("level"), 0).otherwise(1))
    return starts.withColumn("passage", F.sum("start").over(order)).drop("start")


def _keys(lines: DataFrame) -> DataFrame:
    """(conv_id, turn, level, line, keys) of lines that are not blank: line is the hash of the line, keys those of the line, of
    its paragraph (lines of a passage between blank ones) and of its passage, each as one string with single blanks."""
    order = Window.partitionBy("conv_id", "turn", "m", "passage").orderBy("k")
    blanks = lines.withColumn("part", F.sum(F.when(F.col("body") == "", 1).otherwise(0)).over(order)).filter("body <> ''")
    parts = blanks.groupBy("conv_id", "turn", "m", "passage", "level", "part").agg(F.sort_array(F.collect_list(F.struct("k", "body"))).alias("lines"))
    whole = parts.groupBy("conv_id", "turn", "m", "passage", "level").agg(F.sort_array(F.collect_list(F.struct("part", "lines"))).alias("parts"))
    joined = lambda x: F.array_join(F.transform(x, lambda y: y["body"]), " ")
    passage = F.md5(F.array_join(F.transform("parts", lambda x: joined(x["lines"])), " "))
    out = whole.select("conv_id", "turn", "level", passage.alias("run"), F.inline("parts")).select(
        "conv_id", "turn", "level", "run", F.md5(joined(F.col("lines"))).alias("paragraph"), F.explode("lines").alias("x"))
    line = F.md5(F.col("x.body"))
    return out.select("conv_id", "turn", "level", line.alias("line"), F.array_distinct(F.array(line, "paragraph", "run")).alias("keys"))


def link(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, depth_quoted) of the messages whose quotes were found."""
    messages = conversations.select("conv_id", "turn", "text").filter("conv_id is not null and turn is not null").dropDuplicates(["conv_id", "turn", "text"])
    quoting = messages.filter(F.exists(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit(QUOTE)))).select("conv_id").distinct()
    keyed = materialise(_keys(quotation_lines(messages.join(quoting, "conv_id", "left_semi"))).select("conv_id", "turn", "level", "line", F.explode("keys").alias("key")).distinct(), "lines")
    quoted = keyed.filter("level > 0")
    asked = quoted.select("conv_id", "key").distinct()
    said = materialise(keyed.filter("level = 0").select("conv_id", "turn", "key").distinct().join(asked, ["conv_id", "key"], "left_semi"), "said")
    # of every quoted line and key: the latest earlier message that has it, and how many have it
    before = Window.partitionBy("conv_id", "key").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    both = said.select("conv_id", "turn", "key", F.lit(0).alias("level"), F.lit(None).cast("string").alias("line")).unionByName(quoted)
    own = F.when(F.col("level") == 0, F.col("turn"))
    found = materialise(both.withColumn("last", F.max(own).over(before)).withColumn("holders", F.count(own).over(before)).filter("level > 0 and last is not null"), "found")
    # a line of level one counts more than all deeper lines of a message
    weight = F.when(F.col("level") == 1, F.lit(1 << 31) + 1).otherwise(F.lit(1).cast("long"))
    units = materialise(found.groupBy("conv_id", "turn", "level", "line").agg(F.sum("holders").alias("holders"), F.max("last").alias("last")).withColumn("weight", weight), "units")
    totals = units.groupBy("conv_id", "turn").agg(F.sum("weight").alias("total"), F.max("level").alias("deepest"), F.min("last").alias("limit"))

    def best(pairs: DataFrame) -> DataFrame:
        """pairs (conv_id, turn, level, line, p): the message p with the most lines, the latest of those with as many."""
        votes = pairs.distinct().withColumn("weight", weight).groupBy("conv_id", "turn", "p").agg(F.sum("weight").alias("score"))
        return votes.groupBy("conv_id", "turn").agg(F.max(F.struct("score", "p")).alias("best"))

    # the latest holders' votes are a lower bound; where one holds every line that was found, nothing can be better, and
    # nothing later if no later message has one of the lines
    line = ["conv_id", "turn", "level", "line"]
    bound = materialise(best(found.select(*line, F.col("last").alias("p"))).join(totals, ["conv_id", "turn"]), "bound")
    sure = bound.filter("best.score = total and best.p >= limit")
    open_ = bound.filter("best.score < total or best.p < limit").select("conv_id", "turn", F.col("best.score").alias("least"))
    # elsewhere all holders are counted. Who reaches the bound has one of the lines that come, by number of holders, before
    # those that together do not reach it: only these propose messages
    rest = Window.partitionBy("conv_id", "turn").orderBy("holders", "level", "line").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    probes = units.join(open_, ["conv_id", "turn"]).withColumn("left", F.sum("weight").over(rest)).filter("left >= least").select(*line)
    holder = said.select("conv_id", "key", F.col("turn").alias("p"))
    asks = found.select(*line, "key")
    candidates = materialise(asks.join(probes, line, "left_semi").join(holder, ["conv_id", "key"]).filter("p < turn").select("conv_id", "turn", "p").distinct(), "candidates")
    counted = candidates.join(asks, ["conv_id", "turn"]).join(holder, ["conv_id", "key", "p"], "left_semi").select(*line, "p")
    decided = sure.select("conv_id", "turn", "best", "deepest").unionByName(best(counted).join(totals.select("conv_id", "turn", "deepest"), ["conv_id", "turn"]))
    return decided.select("conv_id", "turn", F.col("best.p").alias("parent_turn"), F.col("deepest").alias("depth_quoted"))


def reply_order(conversations: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, role, parent_turn, thread (its first message's turn), depth, n_quoted_lines
    and text without quotes."""
    flat = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    links = materialise(link(flat).select("conv_id", "turn", "parent_turn"), "links")
    # pointer jumping: up and steps double each round, until every message points at its thread's first one
    at = links.select("conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).cast("long").alias("depth"))
    while not links.isEmpty():
        further = at.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"))
        at = materialise(at.join(further, ["conv_id", "up"], "left").select("conv_id", "turn", F.coalesce("up2", "up").alias("up"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"), F.col("up2").isNotNull().alias("moved")), "threads")
        if at.filter("moved").isEmpty():
            break
        at = at.drop("moved")
    threads = links.join(at.select("conv_id", "turn", "up", "depth"), ["conv_id", "turn"])
    kept = F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: ~F.rlike(x, F.lit(QUOTE)))
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1))
    out = flat.select("conv_id", "turn", "role", F.array_join(kept, "\n").alias("text"), (n_lines - F.size(kept)).cast("long").alias("n_quoted_lines"))
    return out.join(threads, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "parent_turn", F.coalesce("up", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"), "n_quoted_lines", "text")
