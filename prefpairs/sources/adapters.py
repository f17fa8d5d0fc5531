"""Adapters from other tables to ENTRY rows ``(entry_id, conversations)``.

An adapter is any ``DataFrame -> DataFrame`` returning the ENTRY schema; ``conform``
checks and projects the result so the rest of the job can rely on it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefpairs.schema import ENTRY

EntryAdapter = Callable[[DataFrame], DataFrame]


def message(role: str | Column, value: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("from"), value.alias("value"))


def conform(entries: DataFrame) -> DataFrame:
    """Project to the ENTRY schema (casting where needed); fails fast on a missing
    column instead of guessing."""
    missing = [f.name for f in ENTRY.fields if f.name not in entries.columns]
    if missing:
        raise ValueError(f"entry adapter output lacks columns {missing}; expected {ENTRY.simpleString()}")
    return entries.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ENTRY.fields])


def adapt(df: DataFrame, adapter: EntryAdapter) -> DataFrame:
    """Run a user adapter (raw annotations -> ENTRY) and conform its output; a row without
    an id fails the job."""
    from prefpairs.sources.readers import require_ids

    return require_ids(conform(adapter(df)))


def events_to_entries(events: DataFrame) -> DataFrame:
    """Deterministic mapping of the ``events`` table to instruction/action records.

    x = floor(value*10) % 1001, y = 10 * (the number in ``props``). Each event type maps
    to one action family, with well-formed, noisy and broken variants chosen by
    ``event_id`` so that every parse rule is exercised:

    click     id%10 < 7 ``CLICK: (x, y)``; 7 ``CLICK: (x.9, y.25)``; 8 ``  CLICK: ((x,y))  ``;
              9 ``CLICK: (x+1001, y)`` (out of range)
    view      ``SCROLL: (x, y)``
    signup    id%7 = 0 ``TYPE: ""``, else ``TYPE: "query k"``
    purchase  ``LONG_PRESS: (x, y)``
    error     id%6 = 0..5: ``COMPLETE``, ``INCOMPLETE``, ``SWIPE: left``, ``CLICK: (x)``,
              empty, ``click: (x, y)``

    Instruction ``Open item <user_id>``; already wrapped when id%11 = 0, empty when
    id%97 = 0; only one message when id%89 = 0.
    """
    # Stage the shared pieces once per row; the action builders below reference them.
    ev = events.select(
        F.col("event_id").alias("_id"),
        F.col("event_type").alias("_kind"),
        F.col("user_id").cast("string").alias("_user"),
        (F.floor(F.col("value") * F.lit(10.0)).cast("bigint") % F.lit(1001)).alias("_xn"),
        F.regexp_extract(F.col("props"), r"[0-9]+", 0).try_cast("bigint").alias("_k"),
    )
    eid, kind, xn, k = F.col("_id"), F.col("_kind"), F.col("_xn"), F.col("_k")
    x = xn.cast("string")
    y = (k * F.lit(10)).cast("string")

    def cat(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    click = (
        F.when(eid % 10 < 7, cat("CLICK: (", x, ", ", y, ")"))
        .when(eid % 10 == 7, cat("CLICK: (", x, ".9, ", y, ".25)"))
        .when(eid % 10 == 8, cat("  CLICK: ((", x, ",", y, "))  "))
        .otherwise(cat("CLICK: (", (xn + F.lit(1001)).cast("string"), ", ", y, ")"))
    )
    error = (
        F.when(eid % 6 == 0, F.lit("COMPLETE"))
        .when(eid % 6 == 1, F.lit("INCOMPLETE"))
        .when(eid % 6 == 2, F.lit("SWIPE: left"))
        .when(eid % 6 == 3, cat("CLICK: (", x, ")"))
        .when(eid % 6 == 4, F.lit(""))
        .otherwise(cat("click: (", x, ", ", y, ")"))
    )
    action = (
        F.when(kind == "click", click)
        .when(kind == "view", cat("SCROLL: (", x, ", ", y, ")"))
        .when(kind == "signup", F.when(eid % 7 == 0, F.lit('TYPE: ""')).otherwise(cat('TYPE: "query ', k.cast("string"), '"')))
        .when(kind == "purchase", cat("LONG_PRESS: (", x, ", ", y, ")"))
        .when(kind == "error", error)
        .otherwise(F.lit(""))
    )
    base = cat("Open item ", F.col("_user"))
    instruction = (
        F.when(eid % 97 == 0, F.lit(""))
        .when(eid % 11 == 0, cat("<image>\nUser: ", base, "\nModel:"))
        .otherwise(base)
    )
    user, assistant = message("user", instruction), message("assistant", action)
    conversations = F.when(eid % 89 == 0, F.array(user)).otherwise(F.array(user, assistant))
    return ev.select(eid.alias("entry_id"), conversations.alias("conversations"))


def conversations_to_entries(conversations: DataFrame, salt_buckets: int | None = None) -> DataFrame:
    """Chat turns ``(conv_id, turn, role, text)`` -> one ENTRY per conversation holding its
    first two turns in turn order (later turns are never read by the extraction).

    ``row_number() <= 2`` lets Spark insert a partial WindowGroupLimit before each
    shuffle, so a map task sends at most two rows per conversation. A conversation spread
    over all M input tasks would still put 2*M rows into one reducer, so a middle level
    first keeps the top two per (conversation, group of input tasks): with S groups a hot
    conversation costs about 2*M/S rows in a middle task and 2*S rows in the final one.
    S defaults to sqrt(M), which balances the two. The grouping at the end reuses the
    final window's partitioning and collects at most two elements.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    if salt_buckets is None:
        salt_buckets = math.isqrt(max(turns.rdd.getNumPartitions(), 1))
    by_turn = F.col("turn").asc_nulls_last()
    if salt_buckets > 1:
        # The input task index is stable across retries, so the grouping is deterministic.
        salted = turns.withColumn("_salt", F.spark_partition_id() % F.lit(salt_buckets))
        turns = (
            salted.withColumn("_rn", F.row_number().over(Window.partitionBy("conv_id", "_salt").orderBy(by_turn)))
            .filter(F.col("_rn") <= 2)
            .drop("_salt", "_rn")
        )
    first_two = turns.withColumn("_rn", F.row_number().over(Window.partitionBy("conv_id").orderBy(by_turn))).filter(
        F.col("_rn") <= 2
    )
    msgs = F.array_sort(F.collect_list(F.struct(F.col("_rn"), F.col("role").alias("from"), F.col("text").alias("value"))))
    return first_two.groupBy("conv_id").agg(
        F.transform(msgs, lambda m: F.struct(m["from"].alias("from"), m["value"].alias("value"))).alias("conversations")
    ).select(F.col("conv_id").alias("entry_id"), "conversations")
