"""Percentiles per group from cumulative frequencies that combine across partitions, days or sources."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workloom.operators.cumulative import running_totals
from workloom.runtime import materialise


def bucketed(value: Column, relative_error: float) -> Column:
    """The value itself for error 0; otherwise the middle of its logarithmic bucket, which is at most
    that relative error away. 0 and the sign are kept."""
    if not relative_error:
        return value
    gamma = (1 + relative_error) / (1 - relative_error)
    k = F.ceil(F.log(F.abs(value)) / math.log(gamma))
    middle = F.pow(F.lit(gamma), k) * (2 / (gamma + 1))
    return F.when(value == 0, F.lit(0.0)).otherwise(F.signum(value) * middle)


def frequencies(df: DataFrame, groups: Sequence[str], value: str, *, relative_error: float = 0.0) -> DataFrame:
    """The summary that combines: how often each group has each value (columns of `groups`, v, n).

    Nulls in the value count for nothing; a null in a group column is a group of its own. NaN counts
    as the greatest value. With relative_error > 0 a group has at most ~ln(max/min)/(2 error) rows,
    however many values it has.
    """
    v = bucketed(F.col(value), relative_error)
    return df.where(F.col(value).isNotNull()).groupBy(*groups, v.alias("v")).agg(F.count("*").alias("n"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        t = pa.Table.from_batches([b])
        counts = t.group_by(t.column_names, use_threads=False).aggregate([([], "count_all")])
        yield from counts.select([*t.column_names, "count_all"]).rename_columns([*t.column_names, "n"]).to_batches()


def row_frequencies(df: DataFrame, groups: Sequence[str], value: str, row: str, *, by: Sequence[str] = (), relative_error: float = 0.0) -> DataFrame:
    """The summary of rows that may be delivered repeatedly: rows with the same group, value and `row`
    count once. `by` keeps the counts of single sources, days and so on apart, each row a summary of
    its own; `percentiles` takes them together as they are. Rows are spread over value ranges by (groups, value, row), so repeats meet there and a
    frequent value is cut up; each range is reduced to counts where it is. The result is in range
    order already, for `percentiles`; a value cut up by a range edge has a row on either side."""
    v = bucketed(F.col(value), relative_error)
    rows = df.where(F.col(value).isNotNull()).select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(groups)], *[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], v.alias("v"), F.col(row).alias("_row"))
    keys = [*[f"_g{i}" for i in range(len(groups))], "v"]
    parts = [f"_b{i}" for i in range(len(by))]
    once = rows.repartitionByRange(*keys, "_row").dropDuplicates([*keys, "_row", *parts]).select(*keys, *parts)
    schema = T.StructType([*once.schema.fields, T.StructField("n", T.LongType())])
    return materialise(once.mapInArrow(_counted, schema).withColumn("_part", F.spark_partition_id()), "counts")


def combine(parts: Sequence[DataFrame], groups: Sequence[str]) -> DataFrame:
    """One summary of all rows that the parts summarise; parts may be of different days or sources."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(*groups, "v").agg(F.sum("n").alias("n"))


def percentiles(freq: DataFrame, groups: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """groups, n (rows), and a column for each of `probs`: the least value whose cumulative frequency
    reaches ceil(p * n). Exact over `freq`, so the whole error is that of `frequencies`.

    The group-value counts are range-sorted over all partitions and each partition sums up its own
    runs; the totals of the partitions before it (one row for each group and partition) are added,
    so a group with most values is spread like any other and no group is gathered in one task.

    An empty summary gives an empty result; counts below 1 are left out.
    """
    g = [f"_g{i}" for i in range(len(groups))]
    known = freq if "_part" in freq.columns else freq.where("n > 0").select(*[F.col(c).alias(x) for c, x in zip(groups, g)], "v", "n")
    summed = running_totals(known, g, ["v"], "n", upto="_to", whole="_all")
    rank = lambda p: F.greatest(F.lit(1), F.ceil(F.round(F.col("_all") * p, 6)))
    first = lambda p: (F.col("_to") >= rank(p)) & (F.col("_to") - F.col("n") < rank(p))
    hit = reduce(Column.__or__, [first(p) for p in probs.values()])
    picked = summed.where(hit).groupBy(*g).agg(
        F.max("_all").alias("n"), *[F.max(F.when(first(p), F.col("v"))).alias(name) for name, p in probs.items()]
    )
    return picked.select(*[F.col(x).alias(c) for c, x in zip(groups, g)], "n", *probs)
