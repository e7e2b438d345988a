"""Quotation linking: nested quotes are parsed, their passages joined to the messages they come from, and
conversations rebuilt in reply order without quotes.

A line that begins with one or more ``>`` (with blanks between and before) is quoted; the number of
``>`` is its level. A passage is a run of lines of one level. Passages and own texts are compared by
the digest of their normal form: A-Z lower-cased, white space collapsed, lines joined by a space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fxtape.shared import published

PREFIX = r"^[ \t]*(?:>[ \t]*)+"
ATTRIBUTION = r"^On .+ wrote:[ \t]*$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MESSAGE = ["conv", "turn", "mark"]


def normal(text: Column) -> Column:
    return F.translate(F.trim(F.regexp_replace(text, r"[ \t\r\f\x0B\n]+", " ")), UPPER, LOWER)


def lines(messages: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """(conv, turn, mark, pos, level, body, line) of every line; ``mark`` is the digest of the text. A line
    that only announces the quote below it has level -1."""
    split = messages.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.md5(F.coalesce(text, F.lit(""))).alias("mark"),
        F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("pos", "line"),
    ).distinct()
    prefix = F.regexp_extract("line", PREFIX, 0)
    level = F.length(prefix) - F.length(F.replace(prefix, F.lit(">"), F.lit("")))
    found = split.select("*", level.alias("depth"), normal(F.substring("line", F.length(prefix) + 1, F.length("line"))).alias("body"))
    below = F.lead("depth").over(Window.partitionBy(*MESSAGE).orderBy("pos"))
    announced = (F.col("depth") == 0) & (below > 0) & F.col("line").rlike(ATTRIBUTION)
    return found.select(*MESSAGE, "pos", F.when(announced, -1).otherwise(F.col("depth")).alias("level"), "body", "line")


def runs(parsed: DataFrame) -> DataFrame:
    """(message, level, begin, passage, bodies): lines of one level that follow each other, blank ones as breaks."""
    place = Window.partitionBy(*MESSAGE, "level").orderBy("pos")
    numbered = parsed.where("body != ''").withColumn("run", F.col("pos") - F.row_number().over(place))
    joined = numbered.groupBy(*MESSAGE, "level", "run").agg(
        F.sort_array(F.collect_list(F.struct("pos", "body"))).alias("parts"), F.min("pos").alias("begin")
    )
    bodies = F.transform("parts", lambda p: p["body"])
    return joined.select(*MESSAGE, "level", "begin", F.array_join(bodies, " ").alias("passage"), bodies.alias("bodies"))


def linked(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Two tables: passages (conv, turn, mark, level, begin, digest, from_conv, from_turn), and messages
    (conv, turn, mark, n_passages, n_linked, deepest, reply_to, thread, clean).

    A passage comes from the first message, by turn, of its own conversation that states it before, as a
    whole, a paragraph or a line of its own text; else from the first message of any other conversation, by
    (conversation, turn), that does. A passage found nowhere is looked up line by line, and takes the first
    origin found. ``reply_to`` is the latest turn of the own conversation among the origins of the
    outermost quotes; ``thread`` is the turn at the root of these replies, a message that replies to none
    being its own root; (thread, turn) is reply order. ``clean`` is the text without quotes, announcements and blank ends.

    Digests are reduced to one origin per conversation, and to two conversations, before they are joined, so
    a passage that everyone states or quotes meets one row. Null and empty texts have no passage and an empty clean text.
    A null conversation or turn is never an origin. Repeated rows count once, rows that share a turn but not
    a text are messages of their own with one turn; empty tables give empty tables; other columns are left out.
    """
    parsed = published(lines(messages, conv, turn, text), "lines")
    pieces = published(runs(parsed), "runs")
    quoted = pieces.where("level > 0")
    asked = quoted.select(*MESSAGE, "level", "begin", F.md5("passage").alias("digest"), F.explode(
        F.concat(
            F.array(F.struct(F.lit(-1).alias("at"), F.md5("passage").alias("d"))),
            F.transform("bodies", lambda b, i: F.struct(i.alias("at"), F.md5(b).alias("d"))),
        )
    ).alias("part")).select(*MESSAGE, "level", "begin", "digest", "part.at", "part.d")

    own = pieces.where("level = 0 AND conv IS NOT NULL AND turn IS NOT NULL")
    whole = own.groupBy(*MESSAGE).agg(F.sort_array(F.collect_list(F.struct("begin", "passage"))).alias("p"))
    stated = (
        own.select("conv", "turn", F.md5("passage").alias("d"))
        .union(own.select("conv", "turn", F.explode("bodies").alias("d")).withColumn("d", F.md5("d")))
        .union(whole.select("conv", "turn", F.md5(F.array_join(F.transform("p", lambda x: x["passage"]), " "))))
    )
    wanted = asked.select("d").distinct()
    stated = stated.join(wanted, "d", "left_semi")
    near = published(stated.groupBy("d", "conv").agg(F.min("turn").alias("near_turn")), "origins")
    # Of each digest the two first conversations: one of them is not the asking one.
    place = F.row_number().over(Window.partitionBy("d").orderBy("conv"))
    two = near.withColumn("place", place).where("place <= 2").withColumn("at", F.struct("conv", "near_turn"))
    far = two.groupBy("d").agg(
        F.min(F.when(F.col("place") == 1, F.col("at"))).alias("first"), F.min(F.when(F.col("place") == 2, F.col("at"))).alias("second")
    )
    found = asked.join(near, ["d", "conv"], "left").join(far, "d", "left")
    here = F.col("near_turn") < F.col("turn")
    away = F.when(F.col("first.conv").eqNullSafe(F.col("conv")), F.col("second")).otherwise(F.col("first"))
    origin = F.when(here, F.struct("conv", F.col("near_turn").alias("turn"))).when(
        away.isNotNull(), F.struct(away["conv"].alias("conv"), away["near_turn"].alias("turn"))
    )
    passages = published(
        found.groupBy(*MESSAGE, "level", "begin", "digest")
        .agg(F.min(F.when(origin.isNotNull(), F.struct("at", origin.alias("o")))).alias("best"))
        .select(*MESSAGE, "level", "begin", "digest", F.col("best.o.conv").alias("from_conv"), F.col("best.o.turn").alias("from_turn")),
        "passages",
    )

    answered = F.when((F.col("level") == 1) & (F.col("from_conv") == F.col("conv")), F.col("from_turn"))
    counted = passages.groupBy(*MESSAGE).agg(
        F.count("*").alias("n_passages"), F.count("from_turn").alias("n_linked"),
        F.max("level").alias("deepest"), F.max(answered).alias("reply_to"),
    )
    roots = threads(counted.where("reply_to IS NOT NULL").select("conv", "turn", "reply_to"))
    kept = F.filter(F.sort_array(F.collect_list(F.struct("pos", "level", "line"))), lambda x: x["level"] == 0)
    texts = parsed.groupBy(*MESSAGE).agg(F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("clean"))
    none = F.lit(0).cast("long")
    same = [texts[c].eqNullSafe(counted[c]) for c in MESSAGE]
    rows = texts.join(counted, same[0] & same[1] & same[2], "left").select(
        *[texts[c] for c in MESSAGE], F.coalesce("n_passages", none).alias("n_passages"),
        F.coalesce("n_linked", none).alias("n_linked"), F.coalesce("deepest", F.lit(0)).alias("deepest"), "reply_to",
        F.regexp_replace("clean", r"^\s+|\s+$", "").alias("clean"),
    )
    return passages, rows.join(roots, ["conv", "turn"], "left").withColumn("thread", F.coalesce("root", "turn")).drop("root")


def threads(replies: DataFrame) -> DataFrame:
    """(conv, turn, root) of messages that reply: every round looks up the root of the root so far.

    Replies go to smaller turns, so the rounds end, after the logarithm of the longest chain.
    """
    current = published(replies.groupBy("conv", "turn").agg(F.max("reply_to").alias("root")), "threads")
    while True:
        up = current.select("conv", F.col("turn").alias("root"), F.col("root").alias("higher"))
        moved = current.join(up, ["conv", "root"], "left").select(
            "conv", "turn", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")
        )
        current = published(moved, "threads")
        if not current.where("moved").limit(1).count():
            return current.drop("moved")
        current = current.drop("moved")


def conversations(messages: DataFrame, **columns) -> DataFrame:
    """The messages in reply order, sorted over the whole table by ranges: a long conversation is spread."""
    return linked(messages, **columns)[1].repartitionByRange("conv", "thread", "turn", "mark").sortWithinPartitions(
        "conv", "thread", "turn", "mark"
    )
