"""Running totals over ordered rows of a group, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workloom.runtime import materialise


def range_sorted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df range-partitioned by the keys, with the number of the partition in `_part`, written to the
    shared folder: the ranges are sampled and must not change between two uses."""
    return materialise(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranged")


def running_totals(df: DataFrame, groups: Sequence[str], order: Sequence[str], amount: str, *, upto: str = "run_to", whole: str = "run_all") -> DataFrame:
    """df with `upto`, the sum of `amount` over the group's rows up to this one in the order, and
    `whole`, the group's sum. The order must be total within a group, or its ties be alike.

    Rows are range-sorted by group and order over all partitions (unless df comes from range_sorted,
    by these keys) and each partition sums up its own rows of each group. Only the first and the
    last group of a partition can go on in others, so at most two groups a partition need the sums
    of the partitions before them; that table grows with the partitions, not with the rows, and is
    broadcast. Null groups are groups; a null amount counts as 0; an empty table stays empty.
    """
    ranged = df if "_part" in df.columns else range_sorted(df, [*groups, *order])
    columns = [c for c in df.columns if c != "_part"]
    add = F.coalesce(F.col(amount), F.lit(0))
    names = [f"_o{i}" for i in range(len(groups))]
    same = lambda a, b: reduce(Column.__and__, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b)])
    key = F.struct(*[F.col(c).alias(o) for c, o in zip(groups, names)])
    ends = ranged.groupBy("_part").agg(F.array(F.min(key), F.max(key)).alias("_e")).select(F.explode("_e").alias("_e")).select("_e.*").distinct()
    own = ranged.join(F.broadcast(ends), same(groups, names), "left_semi").groupBy(*groups, "_part").agg(F.sum(add).alias("_own"))
    span = Window.partitionBy(*groups)
    before = span.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = own.select(
        *[F.col(c).alias(o) for c, o in zip(groups, names)], F.col("_part").alias("_opart"),
        F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("_before"), F.sum("_own").over(span).alias("_whole"),
    )
    here = Window.partitionBy(*groups, "_part")
    run = here.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.select("*", F.sum(add).over(run).alias("_run"), F.sum(add).over(here).alias("_here"))
    joined = summed.join(F.broadcast(offsets), same([*groups, "_part"], [*names, "_opart"]), "left")
    return joined.select(*columns, (F.col("_run") + F.coalesce("_before", F.lit(0))).alias(upto), F.coalesce("_whole", "_here").alias(whole))


def nearest_rank(df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """groups, n and a column for each of `probs`: the value at position round((n - 1) p) of the sorted
    values, counted from 0, halves up. Null values don't count. Values are reduced to counts before
    they are sorted, and no group is gathered."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    r = running_totals(counts, groups, ["_v"], "_n", upto="_to", whole="_all")
    rank = lambda p: F.floor((F.col("_all") - 1) * p + 0.5) + 1
    here = lambda p: (F.col("_to") >= rank(p)) & (F.col("_to") - F.col("_n") < rank(p))
    hit = reduce(Column.__or__, [here(p) for p in probs.values()])
    return r.where(hit).groupBy(*groups).agg(F.max("_all").alias("n"), *[F.max(F.when(here(p), F.col("_v"))).alias(c) for c, p in probs.items()])
