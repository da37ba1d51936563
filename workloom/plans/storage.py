"""Round trips through the stores: what is written by a sink and read back by a source."""

from __future__ import annotations

from pyspark.sql import functions as F

from workloom.operators import details
from workloom.operators import slim as slim_op
from workloom.plans.slim_sql import snapshot_sql
from workloom.plans.views import EVENTS_SQL, events, kept_snapshot
from workloom.runtime import fresh_folder, table, utc_date
from workloom.sources import lake, publish, records


def _month(ts):
    return F.date_format(utc_date(ts), "yyyy-MM")


def _stored_lake(s, d):
    folder = fresh_folder(s, "lake")
    lake.load(table(s, d, "raw_lake").repartition(4), folder)
    return folder


def lake_scan(s, d):
    """The board's rows of a lake written by month and source, read under the declared schema."""
    got = lake.scan(s, _stored_lake(s, d), "hh", with_file=True)
    return got.groupBy(_month("fetched_at").alias("month")).agg(
        F.count("*").alias("rows"), F.countDistinct("vacancy_id").alias("ids"), F.count("professional_role_id").alias("with_role"), F.sum(F.length("raw_json")).alias("chars"),
        F.sum(F.when(F.contains("file", F.lit("source=hh")), 1).otherwise(0)).alias("in_place"),
    )


def lake_compacted(s, d):
    """Rows by month and source after the closed months were compacted to one file each."""
    folder = _stored_lake(s, d)
    trash = fresh_folder(s, "trash")
    for part, _ in lake.compaction_plan(s, folder, "2026-05-20"):
        lake.compact_partition(s, part, folder, trash)
    left = len(lake.compaction_plan(s, folder, "2026-05-20"))
    return lake.scan(s, folder).groupBy("source", _month("fetched_at").alias("month")).agg(F.count("*").alias("rows"), F.countDistinct("content_hash").alias("hashes")).withColumn("still_split", F.lit(left).cast("bigint"))


def event_store(s, d):
    """Events by day and type from files by day."""
    folder = fresh_folder(s, "events")
    lake.write_events(events(s, d), folder)
    return s.read.parquet(folder).groupBy("year", "month", "day", "type").agg(F.count("*").alias("n")).select(F.make_date("year", "month", "day").alias("day"), "type", "n")


def vector_store(s, d):
    """The first and last numbers of vectors after every 20th was replaced, stored and exported."""
    old = table(s, d, "embeddings").select(F.col("vec_id").cast("string").alias("vacancy_id"), F.col("embedding").cast("array<float>").alias("vector"))
    new = old.where("cast(vacancy_id as bigint) % 20 = 0").withColumn("vector", F.transform("vector", lambda x: (x * 2).cast("float")))
    folder = fresh_folder(s, "vectors")
    lake.export_vectors(lake.merge_vectors(new, old), folder, 64)
    return s.read.parquet(folder).select("vacancy_id", F.round(F.get("vector", F.lit(0)).cast("double"), 4).alias("first"), F.round(F.element_at("vector", -1).cast("double"), 4).alias("last"))


def artifact_store(s, d):
    """Postings of the published artifact by source and level."""
    folder = fresh_folder(s, "artifact")
    lake.write_artifact(slim_op.artifact_rows(kept_snapshot(s, d)), folder, 1)
    return publish.load_artifact(s, folder, "id string, src string, sr string", 1).groupBy("src", "sr").agg(F.count("*").alias("n"))


def board_records(s, d):
    """Lake rows made anew from the board's payloads."""
    items = table(s, d, "raw_lake").where("source = 'hh'").select("ingest_seq", "raw_json").distinct()
    got = records.board_records(items.select("raw_json"), "raw_json", F.lit("2026-06-01 00:00:00").cast("timestamp"), "it")
    return got.select("vacancy_id", "source", "employer_id", "market_scope", "professional_role_id", "posted_at")


def chat_records(s, d):
    """Lake rows of the five newest messages with a text of each channel."""
    got = records.chat_records(records.last_messages(table(s, d, "tg_messages"), 5), F.lit("2026-06-01 00:00:00").cast("timestamp"))
    return got.select("vacancy_id", "source", "posted_at", F.get_json_object("raw_json", "$.text").alias("text"))


QUERIES = {
    "lake_scan": lake_scan,
    "lake_compacted": lake_compacted,
    "event_store": event_store,
    "vector_store": vector_store,
    "artifact_store": artifact_store,
    "board_records": board_records,
    "chat_records": chat_records,
    "detail_work_list": lambda s, d: details.work_list(table(s, d, "vacancies"), kept_snapshot(s, d), 300),
}

_MONTH = "strftime(cast(fetched_at at time zone 'UTC' as date), '%Y-%m')"
_J = "json_extract_string(raw_json, '$.{}')"
_ROLE = " , ".join(f"try_cast(json_extract_string(raw_json, '$.{k}{p}') as bigint)" for k in records.ROLE_KEYS for p in ("", "[0]", "[0].id", ".id", "[0].professionalRoleId[0]", "[0].professionalRoleId"))

SQL = {
    "lake_scan": f"select {_MONTH} as month, count(*) as rows, count(distinct vacancy_id) as ids, count(professional_role_id) as with_role, cast(sum(length(raw_json)) as bigint) as chars, count(*) as in_place from raw_lake where source = 'hh' group by 1",
    "lake_compacted": f"select source, {_MONTH} as month, count(*) as rows, count(distinct content_hash) as hashes, 0::bigint as still_split from raw_lake group by all",
    "event_store": f"with {EVENTS_SQL} select cast(ts at time zone 'UTC' as date) as day, type, count(*) as n from ev group by all",
    "vector_store": "select cast(vec_id as varchar) as vacancy_id, round((case when vec_id % 20 = 0 then 2 else 1 end * embedding[1]::float)::double, 4) as first, round((case when vec_id % 20 = 0 then 2 else 1 end * embedding[-1]::float)::double, 4) as last from embeddings",
    "artifact_store": f"with recursive {snapshot_sql()} select source as src, seniority as sr, count(*) as n from snap where title <> '' or description_teaser <> '' group by all",
    "board_records": f"""select vacancy_id, 'hh' as source, employer_id, 'it' as market_scope, coalesce({_ROLE}) as professional_role_id,
  cast(regexp_replace(coalesce({_J.format('publicationTime')}, {_J.format('published_at')}, {_J.format('created_at')}), '([+-]\\d\\d)(\\d\\d)$', '\\1:\\2') as timestamptz) as posted_at from (select distinct ingest_seq, vacancy_id, employer_id, raw_json from raw_lake where source = 'hh')""",
    "chat_records": """with m as (select distinct * from tg_messages where trim(text) <> '')
select 'tg:' || channel || ':' || message_id as vacancy_id, 'telegram' as source, date as posted_at, text from m qualify row_number() over (partition by channel order by message_id desc) <= 5""",
    "detail_work_list": f"""with recursive {snapshot_sql()}, w as (select distinct vacancy_id from vacancies)
select vacancy_id from w left join (select distinct vacancy_id, 0 as f from snap where source = 'hh' and seniority = 'unknown') using (vacancy_id) order by coalesce(f, 1), vacancy_id limit 300""",
}
