"""Chat formatting: a dialogue of several parties, rendered once for each participant as the assistant.

Only DataFrame functions. The messages of all conversations are range partitioned and sorted, so that each gets its
place in its conversation however large that is; a part is ROWS_PER_PART places, and no row and no group holds more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binoscope.functions.scalars import same_keys
from binoscope.llm.shared import written
from binoscope.llm.text import let

ROWS_PER_PART = 256
SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>"
UNNAMED = "unknown"
# The participants of a long conversation meet its parts under this many keys.
SALTS = 64
# Copies of one row are listed in blocks of this many.
COPIES_PER_BLOCK = 65_536
# The low bits of a row's number are its place in its partition.
PLACE_BITS = 33


def _head(role: Column, perspective: Column) -> Column:
    """The line that opens a message: assistant for the speaker in view, system as it is, all others as named users."""
    name = F.regexp_replace(F.coalesce(role, F.lit(UNNAMED)), "[\\r\\n<>|]+", " ")
    return F.concat(F.lit(START), F.when(role == SYSTEM, F.lit(SYSTEM)).when(role == perspective, F.lit("assistant"))
                    .otherwise(F.concat(F.lit("user name="), name)), F.lit("\n"))


def _body(text: Column) -> Column:
    return F.concat(F.regexp_replace(text, "<(?=\\|im_(start|end)\\|>)", "< "), F.lit(END))


def placed(messages: DataFrame) -> DataFrame:
    """messages(conv, turn, role, text) with `place`: 0, 1, ... in the conversation by turn (null last), role and text.

    Equal rows are counted first and listed again with the number of the copy, so every row has a key of its own and no
    range need hold more than its share, be they one conversation, one turn or one text. The sorted rows are written:
    their numbers are drawn once, whatever executor is lost later. A conversation that spans several ranges adds up the
    rows of the earlier ones; the table of these has one row per conversation and range.
    """
    counted = messages.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(COPIES_PER_BLOCK).cast("long"))))
    last = F.least(F.col("n"), F.col("block") + COPIES_PER_BLOCK) - 1
    copies = blocks.withColumn("copy", F.explode(F.sequence("block", last))).drop("n", "block")
    order = [F.col("conv"), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"), F.col("copy")]
    ordered = copies.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = written(ordered.drop("copy").withColumn("number", F.monotonically_increasing_id()), "chat")
    numbered = numbered.withColumn("range", F.shiftright("number", PLACE_BITS))
    spans = numbered.groupBy("conv", "range").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv", "range", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return same_keys(numbered, spans, ["conv", "range"]).select("conv", "turn", "role", "text", (F.col("number") + F.col("shift")).alias("place"))


def rotate(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation, participant and part: conversation, perspective, part, n_turns, n_spoken, text, loss_spans.

    A participant is a role other than "system". Messages stand in the order of turn (null turns last), role and text;
    a part holds ROWS_PER_PART of them, the last one the rest. A conversation that begins with a system message repeats
    it at the head of every later part, where n_turns does not count it. `loss_spans` names what is trained on, as
    "start:end" character spans of the part's text, comma-joined: the participant's own messages with their end marks.
    Parts without an own message have none ("").

    Every row is a message, equal rows too. A null text is an empty message; a null role speaks as the user "unknown"
    and is no participant; a conversation without participants gives one row per part with a null perspective and no
    spans; null conversation ids are one conversation. The marks of the format inside a text get a blank behind their
    "<", so that a message cannot end itself. Other columns are not read; an empty table gives no rows.
    """
    own = placed(messages.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                                 F.coalesce(F.col(text), F.lit("")).alias("text")))
    own = own.withColumn("part", F.floor(F.col("place") / ROWS_PER_PART))
    # A group is at most ROWS_PER_PART rows.
    parts = own.groupBy("conv", "part").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    opener = F.max(F.when((F.col("place") == 0) & (F.col("role") == SYSTEM), F.col("text")))
    convs = own.groupBy("conv").agg(F.max("part").alias("last_part"), opener.alias("opener"))
    people = own.where(F.col("role") != SYSTEM).select("conv", F.col("role").alias("perspective")).distinct()
    views = same_keys(convs, people, ["conv"], "left")
    views = views.select("conv", "opener", "perspective", F.explode(F.sequence(F.lit(0), F.least(F.col("last_part"), F.lit(SALTS - 1)))).alias("salt"))
    seen = same_keys(parts.withColumn("salt", F.col("part") % SALTS), views, ["conv", "salt"])

    def heads(turns: Column) -> Column:
        return F.transform(turns, lambda t: _head(t["role"], F.col("perspective")))

    def spans(turns: Column, head: Column, body: Column) -> Column:
        # The state is the length so far and the spans found; a part bounds both.
        def step(state: Column, k: Column) -> Column:
            start = state["at"] + F.length(F.get(head, k))
            stop = start + F.length(F.get(body, k))
            mine = F.coalesce(F.get(turns, k)["role"] == F.col("perspective"), F.lit(False))
            span = F.concat_ws(":", start.cast("string"), stop.cast("string"))
            return F.struct((stop + 1).alias("at"), F.when(mine, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"))
        begin = F.struct(F.length("lead").alias("at"), F.array().cast("array<string>").alias("found"))
        return F.array_join(F.aggregate(F.sequence(F.lit(0), F.size(turns) - 1), begin, step)["found"], ",")

    def rendered(turns: Column) -> Column:
        return let(heads(turns), lambda head: let(F.transform(turns, lambda t: _body(t["text"])), lambda body: F.struct(
            F.concat("lead", F.array_join(F.zip_with(head, body, lambda h, b: F.concat(h, b, F.lit("\n"))), "")).alias("text"),
            spans(turns, head, body).alias("loss_spans"))))

    lead = F.when((F.col("part") > 0) & F.col("opener").isNotNull(), F.concat(F.lit(f"{START}{SYSTEM}\n"), _body(F.col("opener")), F.lit("\n")))
    spoken = F.size(F.filter("turns", lambda t: F.coalesce(t["role"] == F.col("perspective"), F.lit(False))))
    done = seen.withColumn("lead", F.coalesce(lead, F.lit(""))).withColumn("rendered", rendered(F.col("turns")))
    return done.select(F.col("conv").alias(conversation), "perspective", F.col("part").cast("long").alias("part"),
                       F.size("turns").cast("long").alias("n_turns"), spoken.cast("long").alias("n_spoken"),
                       F.col("rendered")["text"].alias("text"), F.col("rendered")["loss_spans"].alias("loss_spans"))
