"""Helpers shared by the operators: tables, words, and lineage cuts in the shared folder."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefpairs.session import scratch_path

#: The six ASCII white-space characters; a word is a maximal run of any others.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def words(text: Column) -> Column:
    """Words of a text in order (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def filter_after(df: DataFrame, keep: Column) -> DataFrame:
    """Rows where ``keep`` holds, tested after the columns are computed.

    A plain filter is rewritten in terms of the input and moved below the projections, which
    would compute their nested expressions once per mention; a generator stops that.
    """
    flag = free_name(df, "_keep")
    return df.select("*", F.explode(F.array(keep)).alias(flag)).filter(flag).drop(flag)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs only the stage that ran on it, and
    gives the planner the true size of small tables.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
