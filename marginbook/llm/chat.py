"""Chat formatting with Spark expressions only.

The template of one block is ``<|im_start|>role\\ntext<|im_end|>\\n``; turns of one role that follow each other share a
block, with ``<|turn|>`` between their texts. Inside roles and texts ``&`` is written ``&amp;`` and ``<|`` is
written ``&lt;|``, so no text can hold a control string and every text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, NEXT = "<|im_start|>", "<|im_end|>\n", "<|turn|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def _starts(turns: Column) -> Column:
    """Places of the turns that open a block: the first, and those of another role than the turn before."""
    def opens(turn: Column, i: Column) -> Column:
        return F.when((i == 0) | (turn["role"] != F.get(turns, i - 1)["role"]), i)
    return F.filter(F.transform(turns, opens), lambda i: i.isNotNull())


def _blocks(turns: Column, starts: Column) -> Column:
    """The turns between one start and the next as a block; each turn is read once."""
    def block(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(starts, k + 1), F.size(turns))
        return F.struct(F.get(turns, start)["role"].alias("role"),
                        F.transform(F.slice(turns, start + 1, stop - start), lambda t: t["text"]).alias("texts"))
    return F.transform(starts, block)


def _pieces(block: Column, learn: str) -> Column:
    """A block as pieces of output; those to learn from carry ``loss``."""
    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))
    head = piece(F.concat(F.lit(START), escape_role(block["role"]), F.lit("\n")), F.lit(False))
    body = F.flatten(F.transform(block["texts"], lambda t, i: F.when(
        i > 0, F.array(piece(F.lit(NEXT), F.lit(False)), piece(escape(t), block["role"] == learn)))
        .otherwise(F.array(piece(escape(t), block["role"] == learn)))))
    return F.concat(F.array(head), body, F.array(piece(F.lit(END), F.lit(False))))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 learn: str = "assistant") -> DataFrame:
    """One row per conversation: its key, ``formatted`` and ``pieces``, the output cut by loss mask.

    ``pieces`` is an array of (text, loss); their texts joined are ``formatted``, and those with ``loss`` are the
    escaped texts of the role ``learn``. Rows are taken by turn (null first), rows of one turn by role and text, so
    repeated rows all stay. A null role or text counts as empty; a null key is a conversation of its own; an
    empty table gives no rows; other columns are not read. A conversation becomes one string, so it must fit
    in one row; its turns are collected by its key.
    """
    said = turns.select(F.col(conv).alias(conv), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("said"))
    sorted_turns = said.groupBy(conv).agg(F.sort_array(F.collect_list("said")).alias("turns"))
    started = sorted_turns.select(conv, "turns", _starts(F.col("turns")).alias("starts"))
    blocks = started.select(conv, _blocks(F.col("turns"), F.col("starts")).alias("blocks"))
    pieces = blocks.select(conv, F.flatten(F.transform("blocks", lambda b: _pieces(b, learn))).alias("pieces"))
    return pieces.select(conv, F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), "pieces")


def read_chat(formatted: Column) -> Column:
    """The turns of a formatted conversation, an array of (role, text), read from the string alone."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def parts(block: Column) -> Column:
        inner = F.substring(block, F.lit(len(START) + 1), F.length(block))
        head = F.substring_index(inner, "\n", 1)
        return F.struct(unescape_role(head).alias("role"), F.substring(inner, F.length(head) + 2, F.length(inner)).alias("body"))

    def turns(part: Column) -> Column:
        return F.transform(F.split(part["body"], r"<\|turn\|>"), lambda t: F.struct(
            part["role"].alias("role"), unescape(t).alias("text")))
    # A block's role is cut out once, not once per turn.
    return F.flatten(F.transform(F.transform(blocks, parts), turns))
