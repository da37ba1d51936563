"""The incremental path: changes as records arrive, and event counts with late data."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workloom.operators.snapshots import latest_per_key, payload_pay
from workloom.operators.state import append_new, derive_events, event_id, upsert
from workloom.sources.lake import exists


def daily_counts(events: DataFrame, late: str = "2 days", size: str = "1 day") -> DataFrame:
    """Events per window and type; a second delivery of an event_id within the watermark counts once."""
    seen = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    return seen.groupBy(F.window("ts", size), "type").agg(F.count("*").alias("n")).select("window.start", "type", "n")


def weekly_counts(events: DataFrame, late: str = "2 days") -> DataFrame:
    """The same per week from Monday: windows start at the epoch, a Thursday, so they are moved by four days."""
    seen = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    return seen.groupBy(F.window("ts", "7 days", "7 days", "4 days"), "type").agg(F.count("*").alias("n")).select(F.col("window.start").cast("date").alias("week_start"), "type", "n")


#: State of one posting: hash and pay of its latest record, and when it was fetched.
STATE = "content_hash string, lo double, hi double, cur string, fetched_at timestamp"
CHANGES = "event_id string, vacancy_id string, employer_id string, ts timestamp, type string"


def _changes(key, batches: Iterator[pd.DataFrame], state, keep_ms: int | None = None) -> Iterator[pd.DataFrame]:
    empty = pd.DataFrame([], columns=["event_id", "vacancy_id", "employer_id", "ts", "type"])
    if state.hasTimedOut:
        state.remove()
        yield empty
        return
    rows = pd.concat(list(batches)).sort_values(["fetched_at", "ingest_seq"])
    old = state.get if state.exists else None
    out = []
    for r in rows.itertuples(index=False):
        now = tuple(None if pd.isna(x) else x for x in (r.content_hash, r.lo, r.hi, r.cur)) + (r.fetched_at.to_pydatetime(),)
        if old is not None and now[4] < old[4]:
            continue  # late: a newer record decided already
        kind = "appeared" if old is None else None if old[0] == now[0] else "salary_changed" if old[1:4] != now[1:4] else "desc_changed"
        if kind:
            out.append((f"{key[0]}|{r.fetched_at.isoformat()}|{kind}", key[0], r.employer_id, r.fetched_at, kind))
        old = now
    state.update(old)
    if keep_ms:
        state.setTimeoutDuration(keep_ms)
    yield pd.DataFrame(out, columns=empty.columns)


def changes(lake: DataFrame, *, keep_ms: int | None = None) -> DataFrame:
    """appeared, salary_changed and desc_changed events of a stream of lake records, by the state of each
    posting. `closed` needs a complete sweep and stays with the batch path. keep_ms: the state of a
    posting without records for so long is dropped, and it appears anew; by default it stays."""
    flat = lake.where("vacancy_id is not null").select("vacancy_id", "employer_id", "content_hash", "fetched_at", "ingest_seq", payload_pay(F.col("raw_json")).alias("p")).select("*", "p.lo", "p.hi", "p.cur").drop("p")

    def one(key, batches, state):
        return _changes(key, batches, state, keep_ms)

    return flat.groupBy("vacancy_id").applyInPandasWithState(one, CHANGES, STATE, "append", "ProcessingTimeTimeout" if keep_ms else "NoTimeout")


def sweep_writer(state_folder: str, event_folder: str, *, complete: bool = False) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: diffs each batch with the state table, appends the new events and then
    writes a new version of the state. Events have stable ids, so a batch that is run again adds none,
    the first one neither. Records older than the state of their posting are late and change nothing.
    complete: each batch is a whole sweep, so what it lacks has closed and leaves the state; otherwise
    absence says nothing. An empty batch is no sweep."""
    columns = ["vacancy_id", "employer_id", "content_hash", "raw_json", "fetched_at", "ingest_seq"]

    def write(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        got = latest_per_key(batch.select(*columns), ["vacancy_id"], ["fetched_at", "ingest_seq"])
        before = f"{state_folder}/{number - 1}"
        old = spark.read.schema(got.schema).parquet(before) if exists(spark, before) else got.limit(0)
        at = old.select("vacancy_id", F.struct("fetched_at", "ingest_seq").alias("at"))
        fresh = got.join(at, "vacancy_id", "left").where(F.col("at").isNull() | (F.struct("fetched_at", "ingest_seq") > F.col("at"))).select(*columns)
        moment = batch.agg(F.max("fetched_at")).first()[0]
        whole = complete and moment is not None
        seen = got.select("vacancy_id")
        gone = old.join(seen, "vacancy_id", "left_anti").where(F.col("fetched_at") < F.lit(moment)) if whole else old.limit(0)
        events = derive_events(old.join(fresh.select("vacancy_id"), "vacancy_id", "left_semi"), fresh, "1970-01-01", complete=False).drop("event_id", "ts")
        events = events.join(fresh.select("vacancy_id", F.col("fetched_at").alias("ts")), "vacancy_id")
        if whole:
            closed = gone.select("vacancy_id", "employer_id", F.lit("closed").alias("type"), F.lit(None).cast("string").alias("payload"), F.lit(moment).alias("ts"))
            events = events.unionByName(closed)
        events = events.select(event_id("vacancy_id", F.col("ts").cast("string"), "type").alias("event_id"), "vacancy_id", "employer_id", "ts", "type", "payload")
        if exists(spark, event_folder):
            events = append_new(spark.read.parquet(event_folder), events)
        events.write.mode("append").parquet(event_folder)
        kept = upsert(old, fresh, ["vacancy_id"], ["fetched_at", "ingest_seq"])
        kept.join(gone.select("vacancy_id"), "vacancy_id", "left_anti").write.mode("overwrite").parquet(f"{state_folder}/{number}")

    return write
