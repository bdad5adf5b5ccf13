"""Chat formatting with Spark expressions only: collected turns become one marked-up string and a loss mask.

A conversation reads `<|turn|>role<|text|>text<|end|>` per turn. Neighbouring turns of one role
share a turn, their texts parted by `<|part|>`. Inside roles and texts a backslash is doubled and
`<|` becomes `<\\|`, so no text holds a mark, and reading back gives the very rows that went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, PART, END = "<|turn|>", "<|text|>", "<|part|>", "<|end|>"
_PIECES = "array<struct<s:string,loss:boolean>>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _merge(turns: Column) -> Column:
    """Neighbours of one role as one turn with several parts."""
    empty = F.array().cast("array<struct<role:string,parts:array<string>>>")

    def add(done: Column, turn: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        alone = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("parts"))
        joined = F.struct(turn["role"].alias("role"), F.concat(last["parts"], F.array(turn["text"])).alias("parts"))
        return F.when(
            F.coalesce(last["role"] == turn["role"], F.lit(False)), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        ).otherwise(F.concat(done, F.array(alone)))

    return F.aggregate(turns, empty, add)


def _pieces(turn: Column, trained: str) -> Column:
    """The strings of a turn in order, each with whether it is under the loss mask."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("s"), loss.alias("loss"))

    def part(text: Column, i: Column) -> Column:
        own = F.array(piece(escape(text), turn["role"] == F.lit(trained)))
        return F.when(i == 0, own).otherwise(F.concat(F.array(piece(F.lit(PART), F.lit(False))), own))

    head = F.array(piece(F.concat(F.lit(TURN), escape(turn["role"]), F.lit(TEXT)), F.lit(False)))
    return F.concat(head, F.flatten(F.transform(turn["parts"], part)), F.array(piece(F.lit(END), F.lit(False))))


def format_conversations(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant"
) -> DataFrame:
    """One row per conversation: its id, `formatted`, and `loss_spans` (start and length in code points).

    Turns stand by `turn`, ties by role and text; repeated rows are turns of their own. Null roles and
    texts are empty, null turns come first, a null conversation id is a conversation. An empty table
    gives no rows. Other columns are ignored.
    """
    row = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    gathered = turns.groupBy(F.col(conversation).alias(conversation)).agg(F.array_sort(F.collect_list(row)).alias("_turns"))
    pieces = F.flatten(F.transform(_merge(F.col("_turns")), lambda t: _pieces(t, trained)))
    laid = gathered.select(conversation, pieces.cast(_PIECES).alias("_pieces"))
    begins = F.aggregate(
        F.transform("_pieces", lambda p: F.length(p["s"])), F.array(F.lit(0)),
        lambda done, n: F.concat(done, F.array(F.get(done, F.size(done) - 1) + n)),
    )
    spans = F.filter(
        F.zip_with("_pieces", F.col("_begins"), lambda p, b: F.struct(b.alias("start"), F.length(p["s"]).alias("length"), p["loss"].alias("loss"))),
        lambda x: x["loss"],
    )
    return laid.withColumn("_begins", begins).select(
        conversation, F.array_join(F.transform("_pieces", lambda p: p["s"]), "").alias("formatted"),
        F.transform(spans, lambda x: F.struct(x["start"], x["length"])).alias("loss_spans"),
    )


def _mark(mark: str) -> str:
    return mark.replace("|", "\\|")


def read_turns(formatted: Column) -> Column:
    """The rows of a formatted conversation: array of (role, text)."""

    def rows(block: Column) -> Column:
        role = unescape(F.substring_index(block, TEXT, 1))
        body = F.get(F.split(block, _mark(TEXT), 2), 1)
        body = F.substring(body, F.lit(1), F.length(body) - len(END))
        return F.transform(
            F.split(body, _mark(PART), -1), lambda p: F.struct(role.alias("role"), unescape(p).alias("text"))
        )

    blocks = F.split(formatted, _mark(TURN), -1)
    return F.flatten(F.transform(F.slice(blocks, 2, F.greatest(F.size(blocks) - 1, F.lit(0))), rows))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
