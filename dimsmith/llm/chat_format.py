"""Chat formatting: conversations rebuilt from their event logs, then rendered.

Events carry a conversation, a sequence number, a message id, a type and a text:

* ``message`` opens a message (role and text); a second one of the same id is a message of its own
* ``delta`` appends to the latest message of its id (or opens one), ``edit`` replaces its text
* ``regenerate`` empties it, and what follows builds it anew; ``delete`` takes it away

Events are folded for each message in sequence, then messages are put in the order in which they
were opened. The work is dealt out by message and by blocks of ``BLOCK`` messages, each rendered on
its own, so a conversation that holds a large part of the log meets one task only as rendered
blocks, of which its one output row consists anyway.

A turn is rendered as ``<|turn|>role\\n`` text ``<|end|>\\n``. Within roles and texts a backslash is
doubled and ``<|`` becomes ``<\\|`` (a line break in a role ``\\n``), so no text can imitate a mark, and
``read_back`` restores every turn exactly. The loss mask covers the texts of assistant turns.

Null texts and roles count as empty; events without conversation form one conversation (null).
Events that tie in sequence are taken in the order of type, role and text, repeated rows as often
as they occur. Unknown types are an error of the log and are treated as ``message``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.llm.common import once

START, END = "<|turn|>", "<|end|>\n"
BLOCK = 64
MESSAGES = "array<struct<seq:long,role:string,text:string>>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _read_role(role: Column) -> Column:
    # escaping gives no backslash before an n but for a line break: a doubled backslash is taken first
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def folded(events: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text): the final messages of an event log (conv_id, seq, message_id, type, role, text)."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    logs = events.groupBy("conv_id", "message_id").agg(F.array_sort(F.collect_list(F.struct("seq", "type", role.alias("role"), text.alias("text")))).alias("log"))
    fresh = lambda seq, r, t: F.struct(seq.cast("long").alias("seq"), r.alias("role"), t.alias("text"))

    def step(state: Column, e: Column) -> Column:
        last = F.element_at(state, F.lit(-1))
        before = F.slice(state, F.lit(1), F.greatest(F.size(state) - 1, F.lit(0)))
        some = F.size(state) > 0
        put = lambda t: F.array_append(before, fresh(last["seq"], last["role"], t))
        return (
            F.when(some & (e["type"] == "delta"), put(F.concat(last["text"], e["text"])))
            .when(some & (e["type"] == "edit"), put(e["text"]))
            .when(some & (e["type"] == "regenerate"), put(e["text"]))
            .when(e["type"] == "delete", before)
            .otherwise(F.array_append(state, fresh(e["seq"], e["role"], e["text"])))
        )

    # messages that were only opened need no fold
    opened = F.transform("log", lambda e: fresh(e["seq"], e["role"], e["text"]))
    plain = F.forall("log", lambda e: F.coalesce(e["type"], F.lit("message")) == "message")
    final = F.when(plain, opened).otherwise(F.aggregate("log", F.array().cast(MESSAGES), step))
    return logs.select("conv_id", F.explode(final).alias("m")).select("conv_id", "m.*")


def rendered(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, formatted, segments): one row a conversation.

    ``segments`` is the formatted text cut into struct<text, loss>; joined they are ``formatted``.
    """
    own = F.struct("seq", "role", "text")
    blocks = messages.groupBy("conv_id", F.floor(F.col("seq") / block).alias("block")).agg(F.array_sort(F.collect_list(own)).alias("ms"))
    piece = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
    turn = lambda m: F.array(
        piece(F.concat(F.lit(START), _role(m["role"]), F.lit("\n")), F.lit(False)),
        piece(escaped(m["text"]), m["role"] == "assistant"),
        piece(F.lit(END), F.lit(False)),
    )
    blocks = blocks.select("conv_id", "block", F.flatten(F.transform("ms", turn)).alias("segments"))
    whole = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "segments"))).alias("bs"))
    joined = once(whole, "segments", F.flatten(F.transform("bs", lambda b: b["segments"])))
    return once(joined, "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")).select("conv_id", "formatted", "segments")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: array of struct<role, text>."""
    bodies = F.transform(
        F.filter(F.split(formatted, r"<\|end\|>\n", -1), lambda t: t != ""),
        lambda t: F.substring(t, F.lit(len(START) + 1), F.length(t)),
    )
    cut = lambda t: F.locate("\n", t)
    return F.transform(bodies, lambda t: F.struct(_read_role(F.substring(t, F.lit(1), cut(t) - 1)).alias("role"), unescaped(F.substring(t, cut(t) + 1, F.length(t))).alias("text")))


def learned(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


#: Events of one turn at most, and the number that stands for no turn, before all others.
STEPS, NO_TURN = 8, -(1 << 59)


def turns_as_events(conversations: DataFrame) -> DataFrame:
    """A table of finished turns as an event log that ends in them.

    Each row is a message of its own, opened empty. An assistant's text follows a draft that is
    regenerated, streamed as two deltas; any other text is streamed and then edited, to the same.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    first, second = F.left(text, half), F.substring(text, half + 1, F.length(text))
    event = lambda k, kind, t: F.struct(F.lit(k).alias("step"), F.lit(kind).alias("type"), t.alias("text"))
    opened, streamed = event(0, "message", F.lit("")), lambda k: [event(k, "delta", first), event(k + 1, "delta", second)]
    drafted = F.array(opened, event(1, "delta", F.substring(F.reverse(text), 1, 9)), event(2, "regenerate", F.lit("")), *streamed(3))
    edited = F.array(opened, *streamed(1), event(3, "edit", text))
    seq = F.coalesce(F.col("turn").cast("long"), F.lit(NO_TURN)) * STEPS
    log = F.explode(F.when(role == "assistant", drafted).otherwise(edited))
    rows = conversations.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().cast("string").alias("message_id"))
    rows = rows.select("conv_id", seq.alias("first"), "message_id", role.alias("role"), log.alias("e"))
    return rows.select("conv_id", (F.col("first") + F.col("e.step")).alias("seq"), "message_id", "e.type", "role", "e.text")


def digests(conversations: DataFrame) -> DataFrame:
    """Digests of the turns and the loss mask, read back from the formatted conversations."""
    rows = rendered(folded(turns_as_events(conversations)), BLOCK * STEPS)
    rows = once(rows, "read", F.struct(read_back(F.col("formatted")).alias("turns"), learned(F.col("segments")).alias("loss"))).select("conv_id", "formatted", "read.*")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
