"""Chat formatting in Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are merged into a block;
blocks become ``<|im_start|>role\\n`` text ``<|im_end|>\\n`` with ``<|im_next|>`` between the merged turns of a block.
Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold a control string, and
``read_back`` restores the turns exactly.

The loss mask has one entry per turn: how many characters follow the turn's marker before its text (``skip``) and how
many characters of text count for the loss (``keep``, 0 but for assistant turns). So the mask never covers markers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"
LEARNT = "assistant"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role ends at the first line feed of its block, so its own line feeds are written as ``<\\n``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role as ``struct<role, texts>``."""
    size = F.size(turns)
    role = lambda i: F.element_at(turns, i + 1)["role"]
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    heads = F.filter(places, lambda i: (i == 0) | (role(i) != role(F.greatest(i - 1, F.lit(0)))))

    def merged(starts: Column) -> Column:
        def block(start, k):
            stop = F.when(k + 1 < F.size(starts), F.element_at(starts, F.least(k + 2, F.size(starts)))).otherwise(size)
            texts = F.transform(F.slice(turns, start + 1, stop - start), lambda t: t["text"])
            return F.struct(role(start).alias("role"), texts.alias("texts"))

        return F.transform(starts, block)

    return _let(heads, merged)


def format_chats(rows: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_mask)`` of ``rows(conv_id, turn, role, text, ...)``, one row per conversation.

    Turns are ordered by ``turn`` (null first), then role, then text, so ties have one result; repeated rows are turns
    of their own. Null roles and texts are empty. Rows without id are one conversation without id. Other columns are
    ignored.
    """
    empty = F.lit("")
    turn = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    safe = F.transform("turns", lambda t: F.struct(escape_role(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    blocks = collected.select("conv_id", _let(safe, _blocks).alias("blocks"))

    def written(block: Column) -> Column:
        return F.concat(F.lit(START), block["role"], F.lit("\n"), F.array_join(block["texts"], NEXT), F.lit(END))

    def masked(block: Column) -> Column:
        def one(text, j):
            keep = F.when(block["role"] == LEARNT, F.length(text)).otherwise(0)
            return F.struct(F.when(j == 0, F.length(block["role"]) + 1).otherwise(0).alias("skip"), keep.alias("keep"))

        return F.transform(block["texts"], one)

    return blocks.select(
        "conv_id",
        F.array_join(F.transform("blocks", written), "").alias("formatted"),
        F.flatten(F.transform("blocks", masked)).alias("loss_mask"),
    )


def _pieces(text: Column, markers: str) -> Column:
    """What follows each marker."""
    return _let(F.split(text, markers, -1), lambda p: F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))))


def _pattern(marker: str) -> str:
    return marker.replace("|", "\\|")


def read_back(formatted: Column) -> Column:
    """``array<struct<role, text>>``: the turns of a formatted conversation."""

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        at = F.length(role) + 2
        body = F.substr(block, at, F.length(block) - at + 1 - len(END))
        texts = F.split(body, _pattern(NEXT), -1)
        return F.transform(texts, lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(_pieces(formatted, _pattern(START)), turns))


def loss_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the loss mask, in order and unescaped."""
    zipped = F.arrays_zip(_pieces(formatted, f"{_pattern(START)}|{_pattern(NEXT)}").alias("piece"), loss_mask.alias("mask"))
    cut = F.transform(zipped, lambda x: unescape(F.substr(x["piece"], x["mask"]["skip"] + 1, x["mask"]["keep"])))
    return F.array_join(cut, "")


def chat_digest(chats: DataFrame) -> DataFrame:
    """What the output says of itself: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    read = chats.select(
        "conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss")
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
