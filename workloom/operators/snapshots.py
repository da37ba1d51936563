"""What changed between full snapshots, and the latest-row operators they rest on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workloom.runtime import small, utc_date


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest `order` (nulls lowest).

    max_by over a struct combines on the map side, so a key that holds a third of all rows costs
    one row per input partition in the shuffle, and no sort is needed. Rows that tie in every order
    column are decided by the remaining columns' hash, so the result doesn't depend on partitioning.
    """
    rest = [c for c in df.columns if c not in key]
    by = F.struct(*[F.col(c) for c in order], F.xxhash64(*rest).alias("_tie"))
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*rest), by).alias("_row"))
    return picked.select(*key, "_row.*").select(*df.columns)


def as_of(df: DataFrame, key: Sequence[str], ts: str, cut, order: Sequence[str] = ()) -> DataFrame:
    """latest_per_key over the rows whose ts is at or before cut."""
    return latest_per_key(df.where(F.col(ts) <= cut), key, [ts, *order])


def row_hash(columns: Sequence[str | Column]) -> Column:
    """64-bit hash of a canonical rendering: nulls are marked, so null and '' differ."""
    parts = [F.coalesce(F.concat(F.lit("="), (F.col(c) if isinstance(c, str) else c).cast("string")), F.lit("~")) for c in columns]
    return F.xxhash64(F.concat_ws("\u001f", *parts))


def snapshot_changes(
    rows: DataFrame,
    *,
    series: str,
    key: str,
    snapshot: Column,
    order: Sequence[str],
    content: Column,
    watched: Column | None = None,
) -> DataFrame:
    """Typed differences between each full snapshot of a series and the one before it.

    rows: every delivery, in any order. A snapshot is all rows of one `series` value with one
    `snapshot` value; within it the row of a key with the greatest `order` counts. `content` is the
    canonical row hash; `watched` (a struct) tells apart two kinds of change.

    One full outer join of the later with the earlier snapshot on (series, key, later snapshot):
    a side that is missing gives `appeared` or `closed`, unequal hashes give `changed` or, if
    `watched` differs, `watched_changed`. Returns series, key, snapshot, type.

    Defined cases: rows whose series, key or snapshot is null belong to no snapshot and are left
    out; hashes and watched values compare null-safely; repeated rows count once; the first
    snapshot of a series gives nothing; an empty table gives an empty result. Further columns of
    `rows`, whatever their names, are not looked at.

    The join key holds the record key, so a series with most rows is spread over all tasks; a record
    delivered very often is combined before the shuffle. The calendar of snapshots (one row a
    snapshot) is broadcast only while it is small.
    """
    flat = rows.select(
        F.col(series).alias("_s"),
        F.col(key).alias("_k"),
        snapshot.alias("_at"),
        F.struct(*[F.col(c) for c in order]).alias("_o"),
        F.struct(content.alias("h"), (watched if watched is not None else F.lit(0)).alias("w")).alias("_v"),
    ).where("_s is not null and _k is not null and _at is not null")
    calendar = flat.select("_s", "_at").distinct()
    over = Window.partitionBy("_s").orderBy("_at")
    steps = small(calendar.select(F.col("_s"), F.col("_at"), F.lead("_at").over(over).alias("_next"), F.lag("_at").over(over).alias("_prev")))
    state = flat.groupBy("_s", "_at", "_k").agg(F.max_by("_v", "_o").alias("_v")).join(steps, ["_s", "_at"])
    later = state.where("_prev is not null").select("_s", "_k", "_at", F.col("_v").alias("b"))
    earlier = state.where("_next is not null").select("_s", "_k", F.col("_next").alias("_at"), F.col("_v").alias("a"))
    kind = (
        F.when(F.col("a").isNull(), "appeared")
        .when(F.col("b").isNull(), "closed")
        .when(~F.col("a.w").eqNullSafe(F.col("b.w")), "watched_changed")
        .otherwise("changed")
    )
    joined = later.join(earlier, ["_s", "_k", "_at"], "full_outer")
    changed = joined.where(F.col("a").isNull() | F.col("b").isNull() | ~F.col("a.h").eqNullSafe(F.col("b.h")))
    return changed.select(F.col("_s").alias(series), F.col("_k").alias(key), F.col("_at").alias("snapshot"), kind.alias("type"))


#: The pay of both payload shapes of the board; all other fields of the payload are skipped while parsing.
PAY_JSON = "compensation struct<`from`:double,`to`:double,currencyCode:string>, salary struct<`from`:double,`to`:double,currency:string>"


def payload_pay(raw: Column) -> Column:
    """(lower, upper, currency) of a payload, all null if it names no pay or isn't JSON."""
    j = F.from_json(raw, PAY_JSON)
    return F.struct(
        F.coalesce(j["compensation"]["from"], j["salary"]["from"]).alias("lo"),
        F.coalesce(j["compensation"]["to"], j["salary"]["to"]).alias("hi"),
        F.coalesce(j["compensation"]["currencyCode"], j["salary"]["currency"]).alias("cur"),
    )


def lake_changes(lake: DataFrame) -> DataFrame:
    """snapshot_changes over the raw lake: daily sweeps per source, pay watched."""
    kinds = {"watched_changed": "salary_changed", "changed": "desc_changed"}
    out = snapshot_changes(
        lake,
        series="source",
        key="vacancy_id",
        snapshot=utc_date("fetched_at"),
        order=["fetched_at", "ingest_seq"],
        content=F.col("content_hash"),
        watched=payload_pay(F.col("raw_json")),
    )
    return out.replace(kinds, subset=["type"])
