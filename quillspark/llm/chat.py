"""Chat formatting from an event log: messages are folded out of streamed events, then rendered as training texts.

A log row is ``conv_id, message, seq, kind, role, text``: ``message`` is the place in the conversation, ``seq`` the order in
which events happened.  Kinds:

* ``open`` starts a message anew with its first text, ``delta`` adds text, ``edit`` puts its text in place of all so far;
* ``regenerate`` empties a message for the deltas that follow, and takes back what later messages of the conversation
  have received until then (they answered a text that is gone);
* ``delete`` takes a message out unless it is opened again.

The log is dealt by conversation, each message's events are sorted by ``seq`` and folded from the last event that sets the text
anew; a running maximum over the messages tells what was taken back.  All of it is DataFrame functions: no Python runs
in a task.  A message is rendered in its own row; only then do a conversation's turns meet in one string, which is the
result itself (a row's limit, 2 GB, is the limit of a conversation).

A turn reads ``### role ###``, a line feed, the text, ``</turn>``, a line feed.  Inside roles and texts a backslash is doubled and
``</`` and ``##`` get a backslash after their first sign, so that neither control string can occur there and
``unescaped`` gives the same text back.  Loss spans are code points of the formatted text: the assistant's texts alone.

Defined cases: null and empty texts are empty; a null role is an empty one, and the last event with a role names it; a null
``conv_id`` is a conversation of its own; events without a message number and unknown kinds are left out; an event that was
delivered twice (equal in all columns) counts once; events without ``seq`` come first, ties of ``seq`` go by kind, role and
text; an empty log gives an empty table; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import Scratch

SETTING = ("open", "edit", "regenerate", "delete")  # these set the text anew
KINDS = (*SETTING, "delta")
DELTA_CHARS = 400
#: The template's control strings.
TURN_START, ROLE_END, TURN_END = "### ", " ###\n", "</turn>\n"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("</", "<\\/"), ("##", "#\\#")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def conversation_log(rows: DataFrame) -> DataFrame:
    """The events by which rows ``conv_id, turn, role, text`` would have come about.

    Texts arrive in deltas.  An assistant drafts and starts over; a user sends the first piece as an edit of a draft.
    Rows of one turn go by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("message"))

    def event(kind, role=None, text=None):
        role, text = (F.lit(None).cast("string") if v is None else v for v in (role, text))
        return F.struct(F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{DELTA_CHARS}}}"), F.lit(0))
    streamed = F.transform(pieces, lambda piece: event("delta", text=piece))
    edited = F.transform(
        pieces,
        lambda piece, i: F.struct(
            F.when(i == 0, "edit").otherwise("delta").alias("kind"), F.lit(None).cast("string").alias("role"), piece.alias("text")
        ),
    )
    role = F.col("role")
    opened = F.array(event("open", role))
    drafted = F.array(event("open", role), event("delta", text=F.lit("draft")), event("regenerate"))
    sent = F.when(F.size(pieces) > 0, F.array(event("open", role, F.lit("draft")))).otherwise(opened)
    events = (
        F.when(role == LOSS_ROLE, F.concat(drafted, streamed))
        .when(role == "user", F.concat(sent, edited))
        .otherwise(F.concat(opened, streamed))
    )
    seq = F.shiftleft("message", 32) + F.col("at")
    return numbered.select("conv_id", "message", F.posexplode(events).alias("at", "event")).select(
        "conv_id", "message", seq.alias("seq"), "event.kind", "event.role", "event.text"
    )


def fold_events(log: DataFrame) -> DataFrame:
    """``conv_id, message, role, text`` of every message that is left when the log ends."""
    event = F.struct("seq", "kind", "role", "text")
    again = F.when(F.col("kind") == "regenerate", F.col("seq"))
    met = (
        log.filter(F.col("kind").isin(*KINDS) & F.col("message").isNotNull())
        .groupBy("conv_id", "message")
        .agg(F.sort_array(F.collect_set(event)).alias("events"), F.max(again).alias("again"))
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    cut = met.withColumn("cut", F.max("again").over(before))
    live = cut.select(
        "conv_id", "message", F.filter("events", lambda e: F.col("cut").isNull() | (e["seq"] > F.col("cut"))).alias("events")
    ).filter(F.size("events") > 0)
    places = F.transform("events", lambda e, i: F.when(e["kind"].isin(*SETTING), i).otherwise(F.lit(0)))
    since = F.slice("events", F.array_max(places) + 1, F.size("events"))
    last = live.select("conv_id", "message", since.alias("since"), F.filter("events", lambda e: e["role"].isNotNull()).alias("named"))
    text = F.array_join(F.transform("since", lambda e: F.coalesce(e["text"], F.lit(""))), "")
    return last.filter(F.element_at("since", 1)["kind"] != "delete").select(
        "conv_id",
        "message",
        F.coalesce(F.try_element_at("named", F.lit(-1))["role"], F.lit("")).alias("role"),
        text.alias("text"),
    )


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``conv_id, formatted, loss``: spans (turn from 0, where the turn starts, where the span starts and stops)."""
    head = F.concat(F.lit(TURN_START), escaped(F.col("role")), F.lit(ROLE_END))
    turns = messages.select("conv_id", "message", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    turns = turns.withColumn("turn_text", F.concat("head", "body", F.lit(TURN_END)))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("turn_text").cast("long")
    placed = turns.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0).cast("long")))
    start = F.col("at") + F.char_length("head")
    span = F.when(F.col("role") == loss_role, F.struct("at", start.alias("start"), (start + F.char_length("body")).alias("stop")))
    met = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("message", "turn_text", span.alias("span")))).alias("turns"))
    spans = F.transform("turns", lambda t, i: F.struct(i.alias("turn"), t["span"].alias("span")))
    kept = F.filter(spans, lambda s: s["span"].isNotNull())
    return met.select(
        "conv_id",
        F.array_join("turns.turn_text", "").alias("formatted"),
        F.transform(
            kept,
            lambda s: F.struct(
                s["turn"].alias("turn"), s["span"]["at"].alias("at"), s["span"]["start"].alias("start"), s["span"]["stop"].alias("stop")
            ),
        ).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns`` (role, text) and ``loss_texts``, from formatted texts and spans alone."""
    cut = F.split("formatted", TURN_END)  # no sign of the control strings has a meaning in patterns
    rendered = F.slice(cut, 1, F.size(cut) - 1)

    def turn(piece):
        parts = F.split(piece, ROLE_END, 2)
        role = F.substring(parts[0], len(TURN_START) + 1, 1 << 30)
        return F.struct(unescaped(role).alias("role"), unescaped(parts[1]).alias("text"))

    def under(pieces):
        def text(s):
            start = (s["start"] - s["at"] + 1).cast("int")
            return unescaped(F.substr(pieces[s["turn"]], start, (s["stop"] - s["start"]).cast("int")))

        return F.transform("loss", text)

    # handed on as a lambda's variable, the turns are cut once and not for every span
    loss = F.flatten(F.transform(F.array(rendered), under))
    return formatted.select("conv_id", F.transform(rendered, turn).alias("turns"), loss.alias("loss_texts"), "formatted")


def format_conversations(log: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Formatted conversations of an event log, with the spans under the loss."""
    return render(fold_events(log), loss_role)


def format_digests(log: DataFrame) -> DataFrame:
    """Write the formatted conversations down, read them again, and take their measures and digests."""
    with Scratch(log.sparkSession, "chat") as scratch:
        back = read_back(scratch.store(format_conversations(log), "formatted"))
        whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
        under = F.array_join("loss_texts", "")
        return scratch.keep(
            back.select(
                F.col("conv_id").cast("long").alias("conv_id"),
                F.size("turns").cast("long").alias("n_turns"),
                F.sha2(whole, 256).alias("turns_sha256"),
                F.char_length(under).cast("long").alias("loss_chars"),
                F.sha2(under, 256).alias("loss_sha256"),
                F.char_length("formatted").cast("long").alias("formatted_chars"),
            )
        )
