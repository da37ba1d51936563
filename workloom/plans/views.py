"""Adapter views: the test tables in the shape the reporting plans expect, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workloom.functions import regions
from workloom.operators import slim as slim_op
from workloom.plans import slim_sql
from workloom.runtime import changed_at, is_kept, materialise, small, table

#: "Now" of the reports, fixed so that they give the same result on every day.
NOW = "2026-05-26 00:00:00"


def events(spark: SparkSession, d: str) -> DataFrame:
    """The event log with one row per event_id and one name per source."""
    rows = table(spark, d, "slim_events").groupBy("event_id").agg(F.min(F.struct("ts", "vacancy_id", "employer_id", "type", "payload", "source")).alias("r")).select("event_id", "r.*")
    return rows.withColumn("source", F.when(F.col("source") == "telegram", "tg").otherwise(F.col("source")))


def adverts(spark: SparkSession, d: str) -> DataFrame:
    """The adverts, rows repeated whole once. Rows are compared by two hashes, and of repeated ones the first by file and
    place stays, so no text is shuffled."""
    rows = table(spark, d, "vacancies")
    names = rows.columns
    whole = [*names, *[F.col(c).isNull() for c in names]]  # a hash passes over nulls
    hashed = rows.select("*", F.struct(F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole)).alias("_h"), F.struct("_metadata.file_path", "_metadata.row_index").alias("_at"))
    again = hashed.groupBy("_h").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).where("_n > 1").select("_h", "_first")
    return hashed.join(small(again), "_h", "left").where("_first is null or _first = _at").select(*names)


#: Snapshots made by this driver: by session, folder and the state of the tables they come from.
_SNAPSHOTS: dict[tuple, DataFrame] = {}
_SOURCES = ("raw_lake", "cbr_rates", "vacancies", "city_reference")


def snapshot(spark: SparkSession, d: str, source: str | None = None, since: str | None = None) -> DataFrame:
    """The enriched snapshot of the test tables, with details from the adverts and regions from the table of places."""
    lake = table(spark, d, "raw_lake")
    by_city, by_subject = regions.maps(table(spark, d, "city_reference"))
    return slim_op.build(
        lake if source is None else lake.where(F.col("source") == source), table(spark, d, "cbr_rates"), since=None if since is None else F.lit(since).cast("timestamp"),
        details=slim_op.details_of(table(spark, d, "vacancies")), by_city=by_city, by_subject=by_subject,
    )


def kept_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The whole snapshot, made once, written to the shared folder and read by every report on the same tables, for as
    long as these don't change."""
    key = (spark.sparkContext.applicationId, d, *[changed_at(spark, f"{d}/{t}.parquet") for t in _SOURCES])
    known = _SNAPSHOTS.get(key)
    if known is None or not is_kept(known):
        _SNAPSHOTS.clear()
        known = _SNAPSHOTS[key] = materialise(snapshot(spark, d), "slim", shared=True)
    return known


def slim(spark: SparkSession, d: str) -> DataFrame:
    """The kept snapshot in the columns of the reports."""
    return kept_snapshot(spark, d).select(
        "vacancy_id", "title", "employer_id", "employer_name", F.col("salary_rub_min").alias("smin"), F.col("salary_rub_max").alias("smax"), F.col("salary_disclosed").alias("disclosed"),
        "city", "region", "remote_type", "seniority", F.coalesce("description_teaser", F.lit("")).alias("text"), "skills", "source", "professional_role_id", "first_seen_at", "last_seen_at", "posted_at",
    )


SLIM_SQL = f"""recursive {slim_sql.snapshot_sql()},
slim as (select vacancy_id, title, employer_id, employer_name, salary_rub_min as smin, salary_rub_max as smax, salary_disclosed as disclosed, city, region, remote_type, seniority,
  coalesce(description_teaser, '') as text, skills, source, professional_role_id, first_seen_at, last_seen_at, posted_at from snap)
"""

EVENTS_SQL = """
ev as (
  select event_id, r.ts as ts, r.vacancy_id as vacancy_id, r.employer_id as employer_id, r.type as type, r.payload as payload,
    case when r.source = 'telegram' then 'tg' else r.source end as source
  from (select event_id, min(struct_pack(ts := ts, vacancy_id := vacancy_id, employer_id := employer_id, type := type, payload := payload, source := source)) as r
        from slim_events group by event_id))
"""
