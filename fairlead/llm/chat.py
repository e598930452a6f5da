"""Chat formatting: conversations rebuilt from their event log, then rendered.

A log has one row per event: conv_id, seq (order within the conversation), message (which message; messages are ordered by it),
kind, role and text. Kinds:

- message: a message starts, with role and (perhaps partial) text
- delta: text streamed to the end of the message
- edit: the message's text is replaced
- regenerate: what was streamed so far is discarded; later deltas build it anew
- delete: the message is taken back

Events are partitioned by conversation and message and sorted by sequence, folded into final messages there (so a long
conversation is spread over tasks until it is rendered), and the messages are then put together by conversation. Only built-in
functions are used.

Rendering: <|im_start|>ROLE\\nTEXT<|im_end|>\\n for each message. Inside roles and texts, & becomes &amp; and <| becomes &lt;|, and
a line break in a role &#10;, so no text can forge a marker and everything reads back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, messages array<struct<role, text>>): the final messages of each conversation, in order.

    Null texts count as empty, a null role as the last one given for the message, else as empty. A null conv_id is a conversation
    of its own, a null message or seq comes first. Events with the same seq go by kind, role and text, and repeated rows count
    each. Two message events for one message are two messages; the events that follow act on the latter. Conversations whose
    messages are all deleted keep a row without messages. Other columns are ignored."""
    event = F.struct("seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    got = log.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(event)).alias("log"))
    places = F.sequence(F.lit(1), F.size("log"))
    starts = F.filter(places, lambda i: (i == 1) | (F.element_at("log", i)["kind"] == "message"))
    got = got.withColumn("starts", starts)
    runs = F.transform("starts", lambda i, n: F.slice("log", i, F.coalesce(F.get("starts", n + 1), F.size("log") + 1) - i))
    got = got.withColumn("runs", runs)

    def final(run: Column) -> Column:
        # The last event that sets the text anew, and what was streamed since.
        since = F.coalesce(F.array_max(F.filter(F.sequence(F.lit(1), F.size(run)), lambda i: F.element_at(run, i)["kind"].isin(*RESETS))), F.lit(1))
        text = F.array_join(F.transform(F.slice(run, since, F.size(run)), lambda e: e["text"]), "")
        roles = F.filter(F.transform(run, lambda e: e["role"]), lambda r: r.isNotNull())
        return F.struct(F.coalesce(F.get(roles, F.size(roles) - 1), F.lit("")).alias("role"), text.alias("text"))

    kept = F.filter("runs", lambda run: ~F.exists(run, lambda e: F.coalesce(e["kind"], F.lit("")) == "delete"))
    got = got.select("conv_id", F.struct("message", F.transform(kept, final).alias("messages")).alias("part"))
    parts = got.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return parts.select("conv_id", F.flatten(F.transform("parts", lambda p: p["messages"])).alias("messages"))


def render(folded: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Adds `formatted` and `loss`, the spans that are trained on: array<struct<turn, start, length>>, in code points from the
    start of the turn's own rendering. Only texts of the `trained` roles are under the mask, never markers or roles."""
    shown = F.transform("messages", lambda m: F.struct(escape_role(m["role"]).alias("role"), escape(m["text"]).alias("text")))
    out = folded.withColumn("shown", shown)
    text = F.array_join(F.transform("shown", lambda m: F.concat(F.lit(START), m["role"], F.lit("\n"), m["text"], F.lit(END))), "")
    spans = F.transform("shown", lambda m, n: F.struct(n.alias("turn"), (F.length(m["role"]) + len(START) + 1).alias("start"), F.length(m["text"]).alias("length"), m["role"].isin(*trained).alias("on")))
    loss = F.transform(F.filter(spans, lambda s: s["on"]), lambda s: F.struct(s["turn"], s["start"], s["length"]))
    return out.withColumn("formatted", text).withColumn("loss", loss).drop("shown")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns array<struct<role, text>>, loss_text array<string> from `formatted` and `loss` alone."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    out = formatted.withColumn("pieces", F.slice(pieces, F.lit(1), F.size(pieces) - 1))

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substr(body, F.length(role) + 2)).alias("text"))

    loss = F.transform("loss", lambda s: unescape(F.substr(F.get("pieces", s["turn"]), s["start"] + 1, s["length"])))
    return out.withColumn("turns", F.transform("pieces", turn)).withColumn("loss_text", loss).drop("pieces")


def format_chat(log: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, messages, formatted, loss of every conversation in the log; no rows from an empty log."""
    return render(fold(log), trained)
