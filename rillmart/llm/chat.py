"""Chat formatting from event logs, with DataFrame functions alone.

A log holds events (conversation, message, sequence, kind, role, text).  ``fold`` groups it by
message, orders by sequence and reduces it to the final text: an ``edit`` or ``regenerate`` drops
what came before it and starts from its own text, a ``delta`` is appended.  ``render`` gathers the
messages of each conversation and writes them with a template:

    <turn ROLE>TEXT</turn>

and a line end after each.  In roles and texts the four characters backslash, ``<``, ``>`` and
``#`` become backslash plus a letter, so no text can look like a mark, and ``unescape`` gives back
what was there.  ``parse`` and ``loss_text`` read the output again.

One message's events and one conversation's turns must fit a row, as the output does.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window, functions as F

ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"), ("#", "\\h"))
OPEN, MID, CLOSE = "<turn ", ">", "</turn>\n"


def escape(text: Column) -> Column:
    return functools.reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)


def unescape(text: Column) -> Column:
    return functools.reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), ESCAPES[::-1], text)


def log_of_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """Plain turns as the log of a chat that ended with them.  Each row is one message.

    By the length of its text a message was streamed in two deltas, edited (a draft, then an edit
    that starts the text and a delta that ends it) or generated anew (a draft, half a draft, then a
    restart without text and two deltas).  Drafts are the text backwards.  Rows of one turn number
    stay apart and keep the table's order.  A null text is empty; other columns are ignored.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = F.char_length(whole)
    half = F.floor(size / 2).cast("int")
    first, second, draft = F.substring(whole, F.lit(1), half), F.substring(whole, half + 1, size), F.reverse(whole)

    def events(*of):
        return F.array(*[F.struct(F.lit(kind).alias("kind"), said.alias("text")) for kind, said in of])

    end = ("delta", second)
    log = F.when(size % 3 == 0, events(("delta", first), end)) \
        .when(size % 3 == 1, events(("delta", draft), ("edit", first), end)) \
        .otherwise(events(("delta", draft), ("delta", F.substring(draft, F.lit(1), half)),
                          ("regenerate", F.lit(None).cast("string")), ("delta", first), end))
    rows = turns.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                        F.monotonically_increasing_id().alias("message"),
                        F.col(f"`{role}`").alias("role"), log.alias("log"))
    rows = rows.select("conv_id", "turn", "message", "role", F.posexplode("log").alias("seq", "event"))
    return rows.select("conv_id", "turn", "message", F.col("seq").cast("long"), "event.kind", "role", "event.text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, message, role, text) of a log.

    Columns read: conv_id, turn, message, seq, kind, role, text; others are ignored.  Events of
    one sequence number are ordered by kind (edit, regenerate, then delta) and text.  A null number
    comes before all others.  A null text is empty, a null kind a delta.  The role is that of the message's first event that has one.
    A message whose events are all empty is an empty message.
    """
    kind = F.coalesce("kind", F.lit("delta"))
    event = F.struct(F.col("seq"), (kind == "delta").alias("adds"),
                     F.coalesce("text", F.lit("")).alias("text"), F.col("role").alias("role"))
    log = events.groupBy("conv_id", "turn", "message").agg(
        F.sort_array(F.collect_list(event)).alias("log"),
        F.max(F.when(kind != "delta", F.struct("seq", F.coalesce("text", F.lit("")).alias("text"))))
        .alias("restart"))
    # A restart without a number comes before all that have one, so they all stay.
    last = F.filter("log", lambda e: F.coalesce(e.seq >= F.col("restart.seq"), F.col("restart.seq").isNull()))
    text = F.concat(F.coalesce("restart.text", F.lit("")),
                    F.array_join(F.transform(F.filter(last, lambda e: e.adds), lambda e: e.text), ""))
    role = F.get(F.filter(F.transform("log", lambda e: e.role), lambda r: r.isNotNull()), 0)
    return log.select("conv_id", "turn", "message", role.alias("role"), text.alias("text"))


def render(messages: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans.

    ``loss_spans`` lists what a model is trained on: ``turn`` is a turn's place, ``start`` and
    ``end`` are code points in its block (that is, ``formatted`` split after each closing mark),
    end exclusive.  Turns are ordered by number, then by message; null numbers come first.  A null
    role is written as empty.
    """
    role, text = escape(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(OPEN), role, F.lit(MID))
    block = messages.select(
        "conv_id", F.struct(
            "turn", "message", F.concat(head, text, F.lit(CLOSE)).alias("block"),
            F.char_length(head).alias("start"), (F.char_length(head) + F.char_length(text)).alias("end"),
            F.coalesce(F.col("role").isin(*trained), F.lit(False)).alias("loss")).alias("turn"))
    talk = block.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    spans = F.filter(F.transform("turns", lambda t, k: F.struct(
        k.alias("turn"), t.start.alias("start"), t.end.alias("end"), t.loss.alias("loss"))),
        lambda s: s.loss)
    return talk.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t.block), "").alias("formatted"),
        F.transform(spans, lambda s: F.struct(s.turn.alias("turn"), s.start.alias("start"),
                                              s.end.alias("end"))).alias("loss_spans"))


def blocks(formatted: Column) -> Column:
    """The turns' blocks without their closing marks, in order."""
    found = F.split(formatted, CLOSE, -1)
    return F.slice(found, F.lit(1), F.size(found) - 1)


def parse(formatted: Column) -> Column:
    """Array of (role, text) as they were before formatting."""
    def turn(block):
        at = F.locate(MID, block)
        return F.struct(
            unescape(F.substring(block, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)).alias("role"),
            unescape(F.substring(block, at + 1, F.char_length(block))).alias("text"))
    return F.transform(blocks(formatted), turn)


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """What lies under the loss spans, unescaped, span after span."""
    parts = blocks(formatted)
    return F.array_join(F.transform(loss_spans, lambda s: unescape(
        F.substring(F.get(parts, s.turn), s.start + 1, s.end - s.start))), "")
