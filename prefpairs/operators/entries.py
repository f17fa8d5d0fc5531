"""Entry extraction and action parsing (DataFrame -> DataFrame, narrow, no shuffle).

Input: ENTRY rows ``(entry_id, conversations: array<struct<from, value>>)``.
Message 0 is the instruction and message 1 the action, by position; the ``from`` field
is never looked at and later messages are ignored. Emptiness is tested before trimming.

Skip reasons are tested in this order and each skipped entry gets exactly one: the reader's
``fault`` (``malformed_record``, ``non_text_message``), ``too_few_messages``, ``empty_message``, ``unparseable_action``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefpairs.functions.actions import parse_actions
from prefpairs.functions.text import py_strip

TOO_FEW_MESSAGES = "too_few_messages"
EMPTY_MESSAGE = "empty_message"
UNPARSEABLE_ACTION = "unparseable_action"


def _message_value(conversations: Column, pos: int) -> Column:
    # get() is NULL out of bounds (ANSI-safe); a missing message or value reads as empty.
    return F.get(conversations, pos).getField("value")


def extract_entries(entries: DataFrame) -> DataFrame:
    """Adds ``instruction`` and ``raw_action`` (both stripped) and ``skip_reason``.

    Rows are kept; ``skip_reason`` is NULL for entries that passed F1 and F2. Any extra
    input columns pass through.
    """
    conv = F.col("conversations")
    user = _message_value(conv, 0)
    assistant = _message_value(conv, 1)
    enough = F.coalesce(F.size(conv), F.lit(0)) >= 2
    non_empty = F.coalesce((user != "") & (assistant != ""), F.lit(False))
    reason = F.when(~enough, F.lit(TOO_FEW_MESSAGES)).when(~non_empty, F.lit(EMPTY_MESSAGE))
    if "fault" in entries.columns:  # found by the reader: no entry, or no text in a message
        reason = F.coalesce(F.col("fault"), reason)
    ok = reason.isNull()
    return entries.select(
        "*",
        F.when(ok, py_strip(user)).alias("instruction"),
        F.when(ok, py_strip(assistant)).alias("raw_action"),
        reason.alias("skip_reason"),
    )


def parse_entries(entries: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """ENTRY -> one row per entry with the parsed action and the final ``skip_reason``.

    Columns: entry_id, instruction, action_type, x, y, text, raw_action, skip_reason, ``keep``.
    """
    ex = extract_entries(entries).select("entry_id", "instruction", "raw_action", "skip_reason", *keep)
    parsed = parse_actions(ex, "raw_action", stripped=True)  # extract_entries stripped it
    reason = F.coalesce(
        F.col("skip_reason"),
        F.when(F.col("action_type").isNull(), F.lit(UNPARSEABLE_ACTION)),
    )
    return parsed.select(
        "entry_id",
        "instruction",
        "action_type",
        "x",
        "y",
        "text",
        "raw_action",
        reason.alias("skip_reason"),
        *keep,
    )


def valid_entries(entries: DataFrame) -> DataFrame:
    """Parsed entries that produce pairs (PARSED schema)."""
    return (
        parse_entries(entries)
        .filter(F.col("skip_reason").isNull())
        .drop("skip_reason")
    )
