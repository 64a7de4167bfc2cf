"""Ranks and running sums within keys of any size: two levels, so that no key is ever the work of one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def running(df: DataFrame, keys: Sequence[str], shard: Column, within: Sequence[str], value: Column, name: str) -> DataFrame:
    """df with name: the sum of value over the rows before this one, in order of shard, then within, among equal keys.

    shard must rise with the wanted order and keep each (keys, shard) small; only one sum a shard meets in one task.
    """
    df = df.withColumn("_shard", shard).withColumn("_value", value)
    sums = df.groupBy(*keys, "_shard").agg(F.sum("_value").alias("_sum"))
    before = W.partitionBy(*keys).orderBy("_shard").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(*keys, "_shard", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*keys, "_shard").orderBy(*within).rowsBetween(W.unboundedPreceding, -1)
    out = df.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"s.{k}")) for k in (*keys, "_shard")]
    joined = out.alias("o").join(starts.alias("s"), on)
    return joined.select(*[F.col(f"o.{c}") for c in df.columns if c not in ("_shard", "_value")], (F.col("o._inside") + F.col("s._start")).alias(name))


def positions(df: DataFrame, keys: Sequence[str], shard: Column, within: Sequence[str], name: str) -> DataFrame:
    """df with name: the row's place from 0 among rows of equal keys, in order of shard, then within."""
    return running(df, keys, shard, within, F.lit(1), name)
