"""Quality rules with host verdicts (native: DataFrame functions only).

Each document is tested by two base rules (too few words, too many repeated words). The
failures are counted by host, every host's failure rate is shrunk towards the corpus by a
beta prior fitted to the hosts' own rates (method of moments), and a host whose shrunk
rate is above ``max_host_rate`` rejects all of its documents.

Defined results: a null text has no words and fails the base rules; a document with a null
host has no host verdict and keeps its base verdict; repeated rows count as often as they
occur; an empty table gives an empty result. ``quality_table`` reads the columns named by
the arguments only, ``quality_filter`` carries all of them in a struct, so further columns of
any name do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefpairs.llm.common import WHITE, materialize, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    #: Highest share of words, in percent, inside a word window that the text repeats.
    max_repeat_pct: int = 50
    #: A host with a shrunk failure rate above this rejects its documents.
    max_host_rate: float = 0.6


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(w: Column, n: Column) -> Column:
    """Sorted start positions of the 3-word windows that occur more than once."""
    return F.when(
        n >= 3,
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), n - 3),
                lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")),
            )
        ),
    ).otherwise(F.expr("CAST(array() AS array<struct<h:bigint,i:int>>)"))


def document_metrics(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rules: Rules = Rules()) -> DataFrame:
    """A struct ``_row`` of the columns ``keep`` of ``docs`` (default: all) and a struct ``_m``
    of the base measures: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed.

    Work per document is n log n in its words: windows are hashed, sorted with their
    positions, and neighbours compared.
    """
    # The columns kept travel in a struct, out of reach of the working columns' names.
    row = F.struct(*(docs.columns if keep is None else keep)).alias("_row")
    t = F.coalesce(F.col("_t"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x, F.lit(WHITE)) != "")
    step1 = docs.select(row, F.col(text).alias("_t")).select(
        "_row",
        words(F.col("_t")).alias("_w"),
        F.length(_without(t, WHITE)).alias("_chars"),
        (F.length(t) - F.length(_without(t, SYMBOLS))).alias("_symbols"),
        lines.alias("_lines"),
    )
    n = F.size("_w")
    step2 = step1.select(
        "_row", "_chars", "_symbols", n.alias("_n"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("_dup"), _repeat_words(F.col("_w"), n).alias("_s")
    )
    s, last = F.col("_s"), F.size("_s") - 1
    # A window is repeated when a neighbour in hash order is equal.
    repeated = F.filter(s, lambda x, k: ((k > 0) & (x["h"] == F.get(s, k - 1)["h"])) | ((k < last) & (x["h"] == F.get(s, k + 1)["h"])))
    step3 = step2.select("_row", "_chars", "_symbols", "_n", "_dup", F.sort_array(F.transform(repeated, lambda x: x["i"])).alias("_p"))
    # Each window covers three words; a start nearer than three to the one before adds less.
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n")),
        lambda a: a["n"],
    )
    step4 = step3.select("_row", "_chars", "_symbols", "_n", "_dup", covered.alias("_rep"))
    failed = (F.col("_n") < rules.min_words) | (F.lit(100).cast("long") * F.col("_rep") > F.lit(rules.max_repeat_pct).cast("long") * F.col("_n"))
    return step4.select(
        "_row",
        F.struct(
            F.col("_n").cast("long").alias("n_words"),
            F.col("_chars").cast("long").alias("word_chars"),
            F.col("_symbols").cast("long").alias("n_symbols"),
            F.col("_dup").cast("long").alias("n_dup_lines"),
            F.col("_rep").cast("long").alias("n_repeat_words"),
            failed.alias("base_failed"),
        ).alias("_m"),
    )


def host_counts(flags: DataFrame) -> DataFrame:
    """``flags`` (host, base_failed) -> host, n, failed; hosts that are null are left out."""
    hosts = flags.filter(F.col("host").isNotNull()).groupBy("host")
    return hosts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))


def host_verdicts(hosts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``host_counts`` -> one row per host: host, n, failed, rate (shrunk), host_rejected.

    Prior: mean m is the corpus rate; the between-host variance is the size-weighted
    variance of the hosts' rates less what binomial noise alone would give; the prior's
    weight follows from both. Aggregates only: nothing is gathered per host but two sums.
    """
    total = hosts.agg(F.sum("n").alias("_n"), F.sum("failed").alias("_f"), F.count(F.lit(1)).alias("_h"), F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("_q"))
    m = F.col("_f") / F.col("_n")
    noise = m * (1 - m) * F.col("_h") / F.col("_n")
    prior = total.select(
        m.alias("_mean"),
        # Between-host variance, at least a sliver so that the weight stays finite.
        F.greatest(F.col("_q") / F.col("_n") - m * m - noise, F.lit(1e-6)).alias("_var"),
    ).select("_mean", F.greatest(F.col("_mean") * (1 - F.col("_mean")) / F.col("_var") - 1, F.lit(1e-6)).alias("_weight"))
    # One row of priors: a broadcast of two numbers.
    rate = (F.col("failed") + F.col("_mean") * F.col("_weight")) / (F.col("n") + F.col("_weight"))
    return hosts.join(F.broadcast(prior)).select("host", "n", "failed", rate.alias("rate"), (rate > rules.max_host_rate).alias("host_rejected"))


def quality_table(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """One row per document: id, the base measures, base_failed, host_rate, kept.

    The measures are written once to the shared folder; the host verdicts and the result
    are both read from that small table, so every text is scanned once.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(host).alias("host"), F.col(text).alias("text"))
    m = materialize(document_metrics(src, "text", ["id", "host"], rules).select("_row.*", "_m.*"), "quality-metrics")
    hosts = materialize(host_counts(m), "quality-hosts")
    verdicts = materialize(host_verdicts(hosts, rules).select("host", "rate", "host_rejected"), "quality-verdicts")
    return m.join(verdicts, "host", "left").select(
        F.col("id").alias(id_col),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("rate").alias("host_rate"),
        (~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"),
    )


def quality_filter(docs: DataFrame, text: str = "text", host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass their base rules and whose host is not rejected.

    The rows are measured once and written with their base verdict; the hosts' failures and
    the result are read from there. Texts are never shuffled, as long as the table of rejected
    hosts is small enough for Spark's own broadcast; beyond that the join is an ordinary one,
    which AQE splits on a hot host.
    """
    measured = document_metrics(docs, text, None, rules).select("_row", F.col("_row").getField(host).alias("host"), "_m.base_failed")
    measured = materialize(measured, "quality-rows")
    hosts = materialize(host_counts(measured.select("host", "base_failed")), "quality-hosts")
    rejected = materialize(host_verdicts(hosts, rules).filter("host_rejected").select("host"), "quality-verdicts")
    return measured.filter("not base_failed").join(rejected, "host", "left_anti").select("_row.*")
