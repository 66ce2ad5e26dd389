"""Chat formatting with typed content parts, in built-in expressions only.

A message is a list of parts: ``text``, ``image``, ``audio`` or ``document``. Visiting them in
order gives the message's text, where attachments become numbered placeholders, the list of
attachment references, and the number of tokens each placeholder stands for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = ("array<struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, "
         "pages: int>>")
START, END = "<|im_start|>", "<|im_end|>"
TAIL = f"{END}\n"
#: Pixels along the side of an image patch, audio frames a second, tokens a document page.
PATCH, FRAMES, PAGE_TOKENS = 28, 25, 512


def escape(text: Column) -> Column:
    """``text`` without ``<|``, also when more text follows: & and such a < become references."""
    return F.regexp_replace(F.replace(text, F.lit("&"), F.lit("&amp;")), r"<(?=\||\z)", "&lt;")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment's placeholder stands for; at least one, 0 for text."""
    count = (F.when(part["type"] == "image", F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH))
             .when(part["type"] == "audio", F.ceil(part["seconds"] * FRAMES))
             .when(part["type"] == "document", part["pages"].cast("bigint") * PAGE_TOKENS))
    return F.when(part["type"] == "text", F.lit(0).cast("bigint")).otherwise(
        F.greatest(F.lit(1).cast("bigint"), F.coalesce(count, F.lit(1).cast("bigint"))))


def attachments(parts: Column) -> Column:
    """``array<struct<n, type, ref, tokens>>`` of the parts that are not text, numbered from 1."""
    others = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: p["type"] != "text")
    return F.transform(others, lambda p, i: F.struct(
        (i + 1).alias("n"), p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")))


def flatten(parts: Column) -> Column:
    """Escaped text of a message, with ``<|type:n|>`` where its n-th attachment stands.

    NULL parts, texts and types count as empty text.
    """
    def visit(state: Column, p: Column) -> Column:
        is_text = F.coalesce(p["type"], F.lit("text")) == "text"
        n = state["n"] + F.when(is_text, 0).otherwise(1)
        piece = F.when(is_text, escape(F.coalesce(p["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<|"), escape_role(p["type"]), F.lit(":"), n.cast("string"), F.lit("|>")))
        return F.struct(n.alias("n"), F.concat(state["pieces"], F.array(piece)).alias("pieces"))

    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("pieces"))
    visited = F.aggregate(F.coalesce(parts, F.array().cast(PARTS)), start, visit)
    return F.array_join(visited["pieces"], "")


def text_part(text: Column) -> Column:
    """The parts of a message that is one text."""
    kind = PARTS.removeprefix("array<").removesuffix(">")
    return F.array(F.from_json(F.lit("{}"), kind).withField("type", F.lit("text")).withField("text", text))


def format_turns(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Each row of ``turns(conv_id, turn, role, parts)`` with its formatted ``segment``.

    ``loss_begin`` and ``loss_end`` are the code points of the segment that are learned: the text
    of roles in ``trained``; NULL for others. No row needs another, so this holds for
    conversations of any length.
    """
    role = escape_role(F.coalesce("role", F.lit("")))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    learned = F.coalesce("role", F.lit("")).isin(*trained)
    body = turns.withColumn("body", flatten(F.col("parts"))).withColumn("attachments", attachments(F.col("parts")))
    return body.select(
        "conv_id", "turn", "role", "attachments",
        F.concat(head, "body", F.lit(TAIL)).alias("segment"),
        F.when(learned, F.length(head)).alias("loss_begin"),
        F.when(learned, F.length(head) + F.length("body")).alias("loss_end"))


def format_conversations(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``formatted``, ``mask``, ``attachments``, ``expanded``.

    Turns stand in the order of ``turn``, then of their segments, NULL first; repeated rows stay.
    ``mask`` has the learned range of each turn within its segment, NULL where nothing is learned.
    ``attachments`` are those of all turns in order, ``expanded`` their tokens. A NULL
    ``conv_id`` is a conversation of its own; an empty table gives an empty result. The formatted
    conversation is one value, so one conversation must fit into a task's memory; larger ones
    take :func:`format_turns`.
    """
    rows = format_turns(turns, trained)
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "segment", "loss_begin", "loss_end", "attachments"))).alias("rows"))
    files = F.flatten(F.transform("rows", lambda r: r["attachments"]))
    return whole.select(
        "conv_id", F.size("rows").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("rows", lambda r: r["segment"]), "").alias("formatted"),
        F.transform("rows", lambda r: F.when(r["loss_begin"].isNotNull(), F.struct(
            r["loss_begin"].alias("begin"), r["loss_end"].alias("end")))).alias("mask"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("expanded"))


def read_back(formatted: Column, mask: Column) -> Column:
    """The turns of a formatted conversation: ``array<struct<role, text, learned>>``, unescaped.

    ``learned`` is the text under the mask, NULL where there is none.
    """
    segments = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda s: s != "")

    def parse(segment: Column, i: Column) -> Column:
        head = F.substring_index(segment, "\n", 1)
        span = F.get(mask, i)
        inside = F.substring(segment, span["begin"] + 1, span["end"] - span["begin"])
        return F.struct(
            unescape_role(F.substring(head, F.lit(len(START) + 1), F.length(head))).alias("role"),
            unescape(F.substring(segment, F.length(head) + 2, F.length(segment))).alias("text"),
            F.when(span.isNotNull(), unescape(inside)).alias("learned"))

    return F.transform(segments, parse)
