"""Quotation linking: quoted passages of messages traced to their originals, and conversations in reply order.

A line's level is the number of ``>`` it starts with. Neighbouring lines of one level are a passage. Passages
and their lines are normalised (letters and digits in lower case, one blank between) and hashed, as are
the own passages and lines of all messages; a hash of a conversation belongs to the first message that has it.
Joined on (conversation, hash), each level of a message's quotes points to the earlier message that holds
most of its words, the later one of a tie. The parent of a message is what its lowest level points to. The
messages come back without quotes and without the line that announces one, with the first turn of their thread, the
number of replies between (``depth``) and their place in the thread, every reply after what it answers and before later
answers to the same: ordering by (conversation, thread, place) gives reply order.

Places come from list ranking: a walk around each tree of replies enters and leaves every message, a step a row that knows
the step before; sums over all steps before grow by doubling, so storage and rounds are linear and logarithmic in a thread.

Only sums and minima of hashes are shuffled, a hash is one row in its conversation, and neighbours among replies are
found in sorted ranges, so neither a line that is in every message, nor a message that all answer, nor a
conversation with a third of all rows makes pairs or a large group.

Defined results: null text is empty; messages without quotes, or with quotes of nothing known, start threads
of their own; rows that share conversation and turn are one message when linked to, and each its own row;
rows without a conversation or turn link to nothing and are a thread of their own turn; very long texts are read whole; an
empty table gives no rows. ``formatted`` marks roles and ends of turns; the same marks inside a text get one more backslash,
so none can be forged and taking one away gives the text; a role keeps letters, digits, dots, dashes, underscores, and one
that is null or empty is ``user``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.sources.durable import drop_copy, materialise

MARKS = r"^[ \t]*(>[> \t]*)"
# fixed values: how mail programs announce a quote
ANNOUNCES = r"(?i)(?:wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"


def lines_of(text: Column) -> Column:
    """Array of struct(level, text, announces) of the lines."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", "")).alias("level"),
        F.regexp_replace(line, MARKS, "").alias("text"), line.rlike(ANNOUNCES).alias("announces")))
    following = F.concat(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), F.array(F.struct(
        F.lit(0).alias("level"), F.lit("").alias("text"), F.lit(False).alias("announces"))))
    return F.zip_with(lines, following, lambda line, after: F.struct(
        line["level"].alias("level"), line["text"].alias("text"),
        ((line["level"] == 0) & line["announces"] & (after["level"] > 0)).alias("announces")))


def own_text(lines: Column) -> Column:
    kept = F.filter(lines, lambda line: (line["level"] == 0) & ~line["announces"])
    text = F.regexp_replace(F.array_join(F.transform(kept, lambda line: line["text"]), "\n"), r"\n{3,}", "\n\n")
    return F.btrim(text, F.lit(" \t\r\n"))


def passages_of(lines: Column) -> Column:
    """Array of struct(level, text): neighbouring lines of one level, joined by line feeds; blank own lines end one."""
    def add(done: Column, line: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        again = (F.size(done) > 0) & (last["level"] == line["level"]) & (F.trim(line["text"]) != "")
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["level"].alias("level"), F.concat_ws("\n", last["text"], line["text"]).alias("text"))))
        return F.when(again, joined).otherwise(F.concat(done, F.array(F.struct(
            line["level"].alias("level"), line["text"].alias("text")))))
    kept = F.filter(lines, lambda line: ~line["announces"])
    return F.aggregate(kept, F.array().cast("array<struct<level: int, text: string>>"), add)


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def hashes_of(passages: Column) -> Column:
    """Array of struct(level, hash, words) of all passages and of all their lines."""
    parts = F.flatten(F.transform(passages, lambda p: F.transform(
        F.array_distinct(F.concat(F.array(p["text"]), F.split(p["text"], "\n"))),
        lambda text: F.struct(p["level"].alias("level"), _normal(text).alias("text")))))
    return F.transform(F.filter(parts, lambda p: p["text"] != ""), lambda p: F.struct(
        p["level"].alias("level"), F.xxhash64(p["text"]).alias("hash"), F.size(F.split(p["text"], " ")).alias("words")))


def link_quotes(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """(conversation, turn, role, text, n_quoted, parent, thread, depth, place, formatted), a row per message."""
    lines = lines_of(F.col(f"`{text}`").cast("string"))
    told = messages.select(F.col(f"`{conversation}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                           F.col(f"`{role}`").cast("string").alias("role"), lines.alias("lines"))
    told = told.select("conv", "turn", "role", own_text(F.col("lines")).alias("own"),
                       F.size(F.filter("lines", lambda line: line["level"] > 0)).alias("n_quoted"),
                       hashes_of(passages_of(F.col("lines"))).alias("hashes"))
    told = materialise(told)
    named = told.where("conv IS NOT NULL AND turn IS NOT NULL")
    quoting = named.where("n_quoted > 0")
    quotes = quoting.select("conv", "turn", F.explode("hashes").alias("h")).where("h.level > 0") \
        .select("conv", "turn", "h.level", "h.hash", "h.words")
    wanted = quotes.select("conv", "hash").distinct()
    origins = named.select("conv", "turn", F.explode("hashes").alias("h")).where("h.level = 0") \
        .select("conv", "turn", "h.hash").join(wanted, ["conv", "hash"], "left_semi") \
        .groupBy("conv", "hash").agg(F.min("turn").alias("origin"))
    # the first message that has a line, quoted or not, is the same one for all who quote it
    links = quotes.join(origins, ["conv", "hash"]).where("origin < turn") \
        .groupBy("conv", "turn", "level", "origin").agg(F.sum("words").alias("words")) \
        .groupBy("conv", "turn", "level").agg(F.max(F.struct("words", "origin")).alias("best")) \
        .groupBy("conv", "turn").agg(F.min_by("best.origin", "level").alias("parent"))
    links = materialise(links)
    ranked = reply_order(links)
    joined = told.join(links, ["conv", "turn"], "left").join(ranked, ["conv", "turn"], "left")
    return joined.select(
        F.col("conv").alias(conversation), F.col("turn").alias(turn), F.col("role").alias(role), F.col("own").alias(text), "n_quoted",
        "parent", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("place", F.lit(0)).alias("place"), formatted(F.col("role"), F.col("own")).alias("formatted"))


def formatted(role: Column, text: Column) -> Column:
    """One turn between marks that neither its role nor its text can hold."""
    name = F.regexp_replace(role, r"[^\p{L}\p{N}._-]", "_")
    return F.concat(F.lit("<|"), F.when(name != "", name).otherwise("user"), F.lit("|>\n"),
                    F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|"), F.lit("\n<|end|>\n"))


def with_previous(replies: DataFrame) -> DataFrame:
    """(conv, parent, turn) with ``before``, the next smaller turn that answers the same message; ranges, not groups, are sorted."""
    key = ["conv", "parent", "turn"]
    ranged = materialise(replies.select(*key).repartitionByRange(*key).withColumn("part", F.spark_partition_id()))
    ends = ranged.groupBy("part").agg(F.max(F.struct(*key)).alias("end"))
    # a row per range
    ends = ends.select((F.lead("part").over(Window.orderBy("part"))).alias("part"), "end").where("part IS NOT NULL")
    in_part = Window.partitionBy("part").orderBy(*key)
    last = F.coalesce(F.lag(F.struct(*key)).over(in_part), F.col("end"))
    found = ranged.join(F.broadcast(ends), "part", "left").withColumn("last", last)
    same = (F.col("last.conv") == F.col("conv")) & (F.col("last.parent") == F.col("parent"))
    copy = materialise(found.select(*key, F.when(same, F.col("last.turn")).alias("before")))
    drop_copy(ranged)
    return copy


def reply_order(links: DataFrame) -> DataFrame:
    """(conv, turn, thread, depth, place) of messages that answer or are answered, out of (conv, turn, parent) with parent < turn."""
    if not links.limit(1).count():
        return links.select("conv", "turn", F.col("parent").alias("thread"), F.lit(0).cast("long").alias("depth"),
                            F.lit(0).cast("long").alias("place"))
    replies = with_previous(links)
    answered = links.groupBy("conv", F.col("parent").alias("turn")).agg(F.max("turn").alias("latest"))
    nodes = replies.select("conv", "turn", "parent", "before").join(answered, ["conv", "turn"], "full")
    # a step is (turn, whether it leaves the message); ``last`` is the step before, and the first step of a thread has none
    into = nodes.select("conv", F.struct("turn", F.lit(False).alias("leaves")).alias("step"), F.when(
        F.col("before").isNotNull(), F.struct(F.col("before").alias("turn"), F.lit(True).alias("leaves"))).when(
        F.col("parent").isNotNull(), F.struct(F.col("parent").alias("turn"), F.lit(False).alias("leaves"))).alias("last"),
        F.when(F.col("parent").isNull(), F.col("turn")).alias("thread"),
        F.lit(1).cast("long").alias("depth"), F.lit(1).cast("long").alias("place"))
    out_of = nodes.select("conv", F.struct("turn", F.lit(True).alias("leaves")).alias("step"), F.when(
        F.col("latest").isNotNull(), F.struct(F.col("latest").alias("turn"), F.lit(True).alias("leaves"))).otherwise(
        F.struct("turn", F.lit(False).alias("leaves"))).alias("last"), F.lit(None).cast("long").alias("thread"),
        F.lit(-1).cast("long").alias("depth"), F.lit(0).cast("long").alias("place"))
    now = materialise(into.union(out_of))
    drop_copy(replies)
    while now.where("last IS NOT NULL").limit(1).count():
        before = now.select("conv", F.col("step").alias("last"), F.col("last").alias("earlier"), F.col("thread").alias("known"),
                            F.col("depth").alias("depth_"), F.col("place").alias("place_"))
        # steps that are done stay out of the shuffle: each step comes before one other, so no key is common
        open_ = now.where("last IS NOT NULL").join(before, ["conv", "last"]).select(
            "conv", "step", F.col("earlier").alias("last"), F.coalesce("thread", "known").alias("thread"),
            (F.col("depth") + F.col("depth_")).alias("depth"), (F.col("place") + F.col("place_")).alias("place"))
        longer = materialise(now.where("last IS NULL").union(open_))
        drop_copy(now)
        now = longer
    return now.where("NOT step.leaves").select("conv", "step.turn", "thread", (F.col("depth") - 1).alias("depth"),
                                               (F.col("place") - 1).alias("place"))
