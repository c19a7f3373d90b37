"""Chat formatting: typed content parts flattened into one marked-up string per conversation.

A message holds parts of the types text, image, audio and document. The visitor
``visit_part`` turns each into its share of the message body: text is escaped, an
attachment becomes a placeholder, and its reference and the number of tokens that
the placeholder stands for are recorded in order. Turns are marked by control
strings; the same strings inside a text are escaped reversibly: ``<``, any number of
backslashes, ``|`` gets one backslash more, so an unescaped ``<|`` is always markup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
#: The role whose text is learned.
LEARNED_ROLE = "assistant"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Tokens: one for each started square of an image, per started second of audio, per page.
IMAGE_PATCH = 28
AUDIO_TOKENS = 25
PAGE_TOKENS = 1024

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<type:string,ref:string,tokens:bigint>"

_ESC = "\x1b"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role on one line: a line feed would end it."""
    return F.replace(F.replace(escape(role), F.lit(_ESC), F.lit(_ESC + "e")), F.lit("\n"), F.lit(_ESC + "n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit(_ESC + "n"), F.lit("\n")), F.lit(_ESC + "e"), F.lit(_ESC)))


def text_part(text: Column) -> Column:
    """A part of type text; null counts as empty."""
    return F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text, F.lit("")).alias("text"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))),
    ).cast(PART)


def attachment_tokens(part: Column) -> Column:
    """How many tokens the placeholder of a part expands to; at least one, also for a part of unknown size."""
    squares = F.ceil(part["width"] / IMAGE_PATCH) * F.ceil(part["height"] / IMAGE_PATCH)
    seconds = F.ceil(part["seconds"]) * AUDIO_TOKENS
    count = F.when(part["type"] == "image", squares).when(part["type"] == "audio", seconds).otherwise(part["pages"] * PAGE_TOKENS)
    return F.greatest(F.coalesce(count.cast("bigint"), F.lit(1)), F.lit(1)).cast("bigint")


def visit_part(part: Column) -> Column:
    """What a part adds to the body. A part of another type adds its text, if any, as text."""
    visited = None
    for kind, placeholder in PLACEHOLDERS.items():
        is_kind = part["type"] == kind
        visited = F.when(is_kind, F.lit(placeholder)) if visited is None else visited.when(is_kind, F.lit(placeholder))
    return visited.otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def flatten_parts(parts: Column) -> Column:
    """The body of a message: its parts in order."""
    return F.coalesce(F.array_join(F.transform(parts, visit_part), ""), F.lit(""))


def attachments_of(parts: Column) -> Column:
    """References and token counts of the attachments, in the order of their placeholders."""
    attached = F.filter(parts, lambda part: part["type"].isin(*PLACEHOLDERS))
    listed = F.transform(
        attached, lambda part: F.struct(part["type"].alias("type"), part["ref"].alias("ref"), attachment_tokens(part).alias("tokens"))
    )
    return F.coalesce(listed.cast(f"array<{ATTACHMENT}>"), F.array().cast(f"array<{ATTACHMENT}>"))


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, parts).

    Returns conv_id, ``formatted``, ``loss_spans`` (start and end in code points of each
    body of the learned role) and ``attachments``. Turns come in the order of turn,
    nulls first; equal turns by role, then body, so repeated rows stay as repeated turns.
    A null role or part list is empty; rows without conv_id form one conversation. Other
    columns are not carried.

    One shuffle by conversation serves the running offsets and the grouping. A
    conversation is one value of the result, so its length bounds what a task holds.
    """
    body = flatten_parts(F.col("parts"))
    rows = messages.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        body.alias("body"),
        attachments_of(F.col("parts")).alias("attachments"),
    ).withColumn("opening", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")))
    rows = rows.withColumn("piece", F.concat("opening", "body", F.lit(END + "\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("until", F.sum(F.char_length("piece").cast("bigint")).over(order))
    begin = F.col("until") - F.char_length("piece") + F.char_length("opening")
    turn = F.struct(
        "until",
        "piece",
        "attachments",
        (F.col("role") == LEARNED_ROLE).alias("learned"),
        F.struct(begin.alias("start"), (begin + F.char_length("body")).alias("end")).alias("span"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: t["span"]).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns, as structs of role and text, that a formatted conversation holds. Placeholders stay."""
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>", -1), F.lit(2), F.size(F.split(formatted, r"<\|im_start\|>", -1)))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        at = F.char_length(role) + 1
        body = F.substring(piece, at + 1, F.char_length(piece) - at - len(END) - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), ""
    )
