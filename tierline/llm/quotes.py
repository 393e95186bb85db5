"""Quotation linking of messages (built-in functions only).

A message's lines may be quoted: each ``>`` before a line (spaces between allowed) is one
level.  A quoted passage is a run of lines of one level; blank lines cut it into
paragraphs.  Passages, paragraphs and lines are normalised (markers off, white space and
line breaks squeezed, lower case) and hashed, and joined to what the messages of the
conversation wrote themselves: whole own texts, their paragraphs, their lines.  So a
passage is found however its lines were broken anew, and line by line where only parts of
it were quoted.

The latest earlier message that has a quoted passage, paragraph or line is a candidate;
the candidate that explains most of the message's level-1 lines is the one replied to,
the latest of equals.  A line is explained by what has it, its paragraph or its passage.
Reply order then puts every message behind the one it answers.

Latest holders come from a running maximum in blocks of turns, so a greeting that thousands
of messages of one conversation share makes one candidate per quotation, never a pair per
holder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.common import drop_staged, stage
from tierline.operators.asof import running_max

_MARKERS = "^((?:[ \\t]*>)+)"
_ATTRIBUTION = "^[^>]*\\b(wrote|writes|schrieb|escribió|écrit)[ \\t]*:[ \\t]*$"


def _normalise(line: Column) -> Column:
    bare = F.regexp_replace(line, _MARKERS, "")
    return F.lower(F.trim(F.regexp_replace(bare, "\\s+", " ")))


def parse_lines(messages: DataFrame, *keep: str) -> DataFrame:
    """``conv_id, turn, line_no, level, line, norm`` from ``conv_id, turn, text``: one row
    per line, level 0 for the message's own words.  An attribution line right before a
    quotation has level -1.  ``keep``: further columns to carry along."""
    lines = F.split(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "\\r\\n?", "\n"), "\n")
    marks = F.regexp_extract("line", _MARKERS, 1)
    rows = (messages.withColumn("lines", lines)
            .select("conv_id", "turn", *keep, "lines", F.posexplode("lines").alias("line_no", "line")))
    following = F.coalesce(F.try_element_at("lines", F.col("line_no") + F.lit(2)), F.lit(""))
    return rows.select(
        "conv_id", "turn", *keep, "line_no",
        F.when(F.col("line").rlike(_ATTRIBUTION) & following.rlike("^[ \\t]*>"), F.lit(-1))
        .otherwise(F.length(F.regexp_replace(marks, "[^>]", ""))).alias("level"),
        "line", _normalise(F.col("line")).alias("norm"))


_MESSAGE = ["conv_id", "turn", "digest"]


def _joined(parts: str, text: str) -> Column:
    return F.array_join(F.transform(parts, lambda x: x[text]), " ")


def units(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From the lines of messages (``conv_id, turn, digest``):

    * quoted lines with words, ``..., level, line_no, prints``: the hashes of the line, its
      paragraph and its passage;
    * ``conv_id, turn, print``: what messages wrote themselves, in lines, paragraphs and as
      a whole.

    Hashes take in the conversation, so they only meet inside it."""
    def print_of(text: Column) -> Column:
        return F.xxhash64("conv_id", text)

    in_order = Window.partitionBy(*_MESSAGE).orderBy("line_no")
    turned = F.coalesce(F.col("level") != F.lag("level").over(in_order), F.lit(True))
    runs = (lines.withColumn("turned", turned)
            .withColumn("passage", F.count_if("turned").over(in_order))
            .withColumn("paragraph", F.count_if(F.col("turned") | (F.col("norm") == "")).over(in_order))
            .where("norm <> '' AND level >= 0"))
    paragraphs = (runs.groupBy(*_MESSAGE, "level", "passage", "paragraph")
                  .agg(F.array_sort(F.collect_list(F.struct("line_no", "norm"))).alias("lines"))
                  .withColumn("text", _joined("lines", "norm")))
    passages = (paragraphs.groupBy(*_MESSAGE, "level", "passage")
                .agg(F.array_sort(F.collect_list(F.struct("paragraph", "text", "lines"))).alias("paragraphs"))
                .withColumn("text", _joined("paragraphs", "text")))
    quoted = (passages.where("level > 0").withColumn("p", F.explode("paragraphs")).withColumn("l", F.explode("p.lines"))
              .select(*_MESSAGE, "level", F.col("l.line_no").alias("line_no"), F.array_distinct(F.array(
                  print_of(F.col("l.norm")), print_of(F.col("p.text")), print_of(F.col("text")))).alias("prints")))
    own = (passages.where("level = 0").groupBy(*_MESSAGE)
           .agg(F.array_sort(F.collect_list(F.struct("passage", "text", "paragraphs"))).alias("passages"))
           .select("conv_id", "turn", F.explode(F.concat(
               F.array(_joined("passages", "text")),
               F.flatten(F.transform("passages", lambda p: F.transform(p["paragraphs"], lambda q: q["text"]))),
               F.flatten(F.flatten(F.transform("passages", lambda p: F.transform(
                   p["paragraphs"], lambda q: F.transform(q["lines"], lambda x: x["norm"]))))))).alias("text"))
           .select("conv_id", "turn", print_of(F.col("text")).alias("print")).distinct())
    return quoted, own


def link_quotes(spark: SparkSession, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, turn, n_quoted, n_linked`` of quoting messages (quoted lines with words,
    those that an earlier message explains), and ``conv_id, turn, parent_turn`` of those
    that answer one."""
    quoted, own = units(lines)
    quoted = stage(spark, quoted, "op2-quoted")
    asked = stage(spark, quoted.select(F.explode("prints").alias("print")).distinct(), "op2-asked")
    own = stage(spark, own.join(asked, "print", "left_semi"), "op2-own")    # written: joins on a hot print can split
    each = quoted.select(*_MESSAGE, "level", "line_no", F.explode("prints").alias("print"))
    events = each.select("*", (F.col("turn") * 2).alias("at"), F.lit(None).cast("long").alias("held")).unionByName(
        own.select("conv_id", "print", (F.col("turn") * 2 + 1).alias("at"), F.col("turn").alias("held")),
        allowMissingColumns=True)
    found = stage(spark, running_max(events, "print", "at", {"origin": F.col("held")}).where("held IS NULL").select(
        *_MESSAGE, "level", "line_no", "print", "origin"), "op2-found")
    per_line = found.groupBy(*_MESSAGE, "line_no").agg(F.max("origin").alias("origin"))
    counts = per_line.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n_quoted"), F.count("origin").alias("n_linked"))
    direct = found.where("level = 1")
    candidates = stage(spark, direct.where("origin IS NOT NULL").select("conv_id", "turn", "origin").distinct(), "op2-candidates")
    held = own.select("print", F.col("turn").alias("origin"))
    explained = (candidates.join(direct.drop("origin"), ["conv_id", "turn"]).join(held, ["print", "origin"], "left_semi")
                 .select("conv_id", "turn", "origin", "digest", "line_no").distinct())
    votes = explained.groupBy("conv_id", "turn", "origin").agg(F.count(F.lit(1)).alias("votes"))
    parents = (votes.groupBy("conv_id", "turn").agg(F.max(F.struct("votes", "origin")).alias("best"))
               .select("conv_id", "turn", F.col("best.origin").alias("parent_turn")))
    return stage(spark, counts, "op2-counts"), stage(spark, parents, "op2-parents")


def reply_paths(spark: SparkSession, replies: DataFrame, most_rounds: int = 40) -> DataFrame:
    """``conv_id, turn, root_turn, depth`` from ``conv_id, turn, parent_turn``, by doubling
    jumps: after k rounds every message has found an ancestor 2^k steps up or its root.
    Messages that answer nothing are roots already and cost no join."""
    done = replies.where("parent_turn IS NULL").select(
        "conv_id", "turn", F.col("turn").alias("up"), F.lit(0).cast("long").alias("steps"), F.lit(True).alias("top"))
    moving = stage(spark, replies.where("parent_turn IS NOT NULL").select(
        "conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).cast("long").alias("steps"),
        F.lit(False).alias("top")), "op2-paths")
    for _ in range(most_rounds):
        if moving.where("NOT top").isEmpty():
            break
        above = moving.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("up2"),
                              F.col("steps").alias("steps2"), F.col("top").alias("top2"))
        step = (moving.join(above, ["conv_id", "up"], "left")
                .select("conv_id", "turn",
                        F.when(F.col("top") | F.col("up2").isNull(), F.col("up")).otherwise(F.col("up2")).alias("up"),
                        F.when(F.col("top") | F.col("up2").isNull(), F.col("steps"))
                        .otherwise(F.col("steps") + F.col("steps2")).alias("steps"),
                        (F.col("top") | F.col("up2").isNull() | F.col("top2")).alias("top")))
        after = stage(spark, step, "op2-paths")
        drop_staged(spark, moving)
        moving = after
    return done.union(moving).select("conv_id", "turn", F.col("up").alias("root_turn"), F.col("steps").alias("depth"))


def reply_ordered(spark: SparkSession, messages: DataFrame, role_col: str = "role") -> DataFrame:
    """One row per message: ``conv_id, turn, role, parent_turn, root_turn, depth, n_quoted,
    n_linked, own_text, own_sha256``.

    Within a conversation, sorting by (root_turn, depth, turn) is the reply order: a
    message stands behind the one it answers, and without quotations it is the order of
    turns.  ``own_text`` is the text without quoted and attribution lines, NULL text
    counting as empty.  ``n_quoted`` counts quoted lines with words, ``n_linked`` those
    that an earlier message of the conversation explains.  Rows that repeat (conv_id, turn)
    are one message with the passages of all their texts and get the same links; a NULL
    conv_id or turn leaves the message without links, as a root of its own.  Extra columns
    are ignored.
    """
    base = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.col(role_col).alias("role"), "text")
    lines = parse_lines(base.where("text LIKE '%>%'"))
    # A line of a message without any marker is its own; only conversations with quotations need them.
    quoting = stage(spark, lines.where("level > 0 AND conv_id IS NOT NULL").select("conv_id").distinct(), "op2-quoting")
    relevant = (base.where("turn IS NOT NULL").join(quoting, "conv_id", "left_semi")
                .withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256)).dropDuplicates(_MESSAGE))
    counts, parents = link_quotes(spark, parse_lines(relevant, "digest"))
    paths = reply_paths(spark, parents)
    known = (counts.join(parents, ["conv_id", "turn"], "left").join(paths, ["conv_id", "turn"], "left"))
    lines_of = F.split(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "\\r\\n?", "\n"), "\n")
    numbered = F.transform(lines_of, lambda x, i: F.struct(x.alias("x"), F.get(lines_of, i + 1).alias("after")))
    own = F.filter(numbered, lambda s: ~s["x"].rlike("^[ \\t]*>") & ~(
        s["x"].rlike(_ATTRIBUTION) & F.coalesce(s["after"].rlike("^[ \\t]*>"), F.lit(False))))
    own_text = F.when(F.col("text").contains(">"),
                      F.trim(F.array_join(F.transform(own, lambda s: s["x"]), "\n"))).otherwise(
        F.coalesce(F.col("text"), F.lit("")))
    return (base.join(known, ["conv_id", "turn"], "left").withColumn("own_text", own_text)
            .select("conv_id", "turn", "role", "parent_turn",
                    F.coalesce("root_turn", "turn").alias("root_turn"),
                    F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
                    F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
                    F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "own_text",
                    F.sha2(F.col("own_text").cast("binary"), 256).alias("own_sha256")))
