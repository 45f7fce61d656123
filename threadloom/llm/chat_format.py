"""Conversations as one text each, with a loss mask, with column expressions only.

A turn has a list of typed parts. A visitor flattens them in their order: text parts that follow each other become
one escaped text, any other part a placeholder `<|image|>`, `<|audio|>` or `<|document|>`, and its reference and expanded
token count go to the list of attachments, in the order of the placeholders. A part of another kind becomes
nothing, and the texts around it follow each other.

    <|im_start|>role
    content<|im_end|>

Control strings inside texts and roles are escaped: a backslash goes in after `<` wherever `<`, any number
of backslashes and `|` follow each other, so the result has no `<|`, and taking one backslash out again gives
the text back. In roles, backslashes and line feeds are escaped as well, because the first line feed ends it.

Turns are put in the order of turn, role and content, null first. Null roles, texts and lists of parts count
as empty; turns with a null conversation id form one conversation. Equal rows stay as turns of their own. An
empty table gives an empty result; columns of other names are not read, whatever they are called. Sizes that are null or not positive count as one unit.

The mask is a list of byte ranges of the formatted text (UTF-8), so that cutting one out takes no scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.binding import let

START, END = "<|im_start|>", "<|im_end|>\n"
MEDIA = ("image", "audio", "document")
PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")


@dataclass(frozen=True)
class Expansion:
    """How many tokens the media of a part stand for."""
    image_patch: int = 14
    audio_tokens_per_second: float = 25.0
    document_tokens_per_page: int = 576


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    halves = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(halves, lambda h: F.replace(h, F.lit("\\n"), F.lit("\n"))), "\\")


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    empty = ", ".join(f"CAST(NULL AS {t}) AS {n}" for n, t in
                      [("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int")])
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"),
                            *[F.expr(e) for e in empty.split(", ")]))


def _visited(parts: Column) -> Column:
    """Text of a turn. Texts side by side are escaped as one, as a control string may begin in one and end in the next."""
    def visit(seen: Column, part: Column) -> Column:
        medium = part["kind"].isin(*MEDIA)
        said = F.when(part["kind"] == "text", F.coalesce(part["text"], F.lit(""))).otherwise(F.lit(""))
        closed = F.concat(seen["closed"], escape(seen["open"]), F.lit("<|"), part["kind"], F.lit("|>"))
        return F.struct(F.when(medium, closed).otherwise(seen["closed"]).alias("closed"),
                        F.when(medium, F.lit("")).otherwise(F.concat(seen["open"], said)).alias("open"))

    start = F.struct(F.lit("").alias("closed"), F.lit("").alias("open"))
    return F.aggregate(parts, start, visit, lambda seen: F.concat(seen["closed"], escape(seen["open"])))


def _tokens(part: Column, expansion: Expansion) -> Column:
    def units(value: Column, per: float) -> Column:
        return F.greatest(F.ceil(F.coalesce(value, F.lit(0)) * F.lit(per)), F.lit(1)).cast("bigint")
    patch = 1 / expansion.image_patch
    return (F.when(part["kind"] == "image", units(part["width"], patch) * units(part["height"], patch))
            .when(part["kind"] == "audio", units(part["seconds"], expansion.audio_tokens_per_second))
            .otherwise(F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)).cast("bigint")
                       * F.lit(expansion.document_tokens_per_page)))


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                parts: str = "parts", trained: tuple[str, ...] = ("assistant",),
                expansion: Expansion = Expansion()) -> DataFrame:
    """One row per conversation: its id, formatted, loss_spans (start and length in bytes), attachments,
    expanded_tokens (of all attachments)."""
    media = F.filter(F.coalesce(F.col("parts"), F.expr(f"CAST(array() AS array<{PART}>)")),
                     lambda p: p["kind"].isin(*MEDIA))
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), F.col(parts).alias("parts"))
    rows = rows.select("conv", "turn", "role", F.coalesce(
        _visited(F.col("parts")), F.lit("")).alias("content"),
        F.transform(media, lambda p: F.struct(
            p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p, expansion).alias("tokens"))).alias("media"))
    rows = rows.select(
        "*", F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n")).alias("head"))
    size = F.octet_length("head") + F.octet_length("content") + F.lit(len(END))
    before = Window.partitionBy("conv").orderBy("turn", "role", "content").rowsBetween(Window.unboundedPreceding, -1)
    up_to = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select(
        "*", F.coalesce(F.sum(size).over(before), F.lit(0)).alias("start"),
        F.count(F.lit(1)).over(up_to).alias("n"))
    loss = F.when(F.col("role").isin(*trained), F.struct(
        (F.col("start") + F.octet_length("head")).alias("start"), F.octet_length("content").alias("length")))
    together = placed.select("conv", F.struct(
        "n", F.concat("head", "content", F.lit(END)).alias("text"), loss.alias("loss"), "media").alias("t")
    ).groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("t"))
    attached = F.flatten(F.col("t.media"))
    return together.select(
        F.col("conv").alias(conv), F.array_join(F.col("t.text"), "").alias("formatted"),
        F.filter(F.col("t.loss"), lambda s: s.isNotNull()).alias("loss_spans"), attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("bigint"), lambda sum_, m: sum_ + m["tokens"]).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """Roles and unescaped contents, read back from the formatted text."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: F.startswith(p, F.lit(START)))
    heads = F.transform(pieces, lambda p: F.struct(
        F.substring_index(p, "\n", 1).alias("head"), p.alias("piece")))
    return F.transform(heads, lambda h: F.struct(
        _unescape_role(F.replace(h["head"], F.lit(START), F.lit(""))).alias("role"),
        unescape(F.substr(h["piece"], F.char_length(h["head"]) + 2)).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped and joined. Cut out of the bytes, which are made once."""
    return let(F.encode(formatted, "UTF-8"), lambda data: F.array_join(F.transform(spans, lambda s: unescape(
        F.decode(F.substr(data, (s["start"] + 1).cast("int"), s["length"]), "UTF-8"))), ""))
