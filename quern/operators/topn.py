"""Building blocks that stay safe when one key holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark keeps the best n per group in every map task (WindowGroupLimit) up to the n that the session's
# windowGroupLimitThreshold allows, so even the largest group sends a few rows per task. Beyond this n the
# group is ranked per input partition first, so that no task ever receives a whole group.
ONE_STEP_N = 10
# A key set holds each key at most this many times.
KEY_COPIES = 8


def top_per_group(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """``order`` should be total, else which of several equal rows is kept is open."""
    name = rank or "__rank"
    if n > ONE_STEP_N:
        df = df.withColumn("__part", F.spark_partition_id())
        df = _ranked(df, [*keys, "__part"], order, n, "__rank").drop("__part", "__rank")
    out = _ranked(df, keys, order, n, name)
    return out if rank else out.drop(name)


def _ranked(df: DataFrame, keys, order, n: int, name: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def key_set(df: DataFrame, column: str, name: str) -> DataFrame:
    """The keys to look up in a semi or anti join, repeats removed but for KEY_COPIES of each.

    Repeats are combined before the shuffle. A plain ``distinct`` would do that too, but the join would
    then build on its partitioning, and Spark splits skewed join partitions only when both sides come
    straight from a shuffle.
    """
    copy = F.pmod(F.spark_partition_id(), F.lit(KEY_COPIES)).alias("__copy")
    return df.groupBy(F.col(column).alias(name), copy).agg(F.lit(1).alias("__one")).select(name)


def own_shuffle(df: DataFrame) -> DataFrame:
    """Detach an aggregated table from its partitioning, for the same reason; its size decides the partitions."""
    return df.hint("rebalance")
