"""Event log and state tables: diffs of two states, backfill, retention, upserts, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from workloom.operators.snapshots import latest_per_key, payload_pay
from workloom.runtime import materialise, small

EVENT_TYPES = ("appeared", "seen", "closed", "salary_changed", "desc_changed", "republished")


def event_id(*parts) -> F.Column:
    """The same id for the same event, so that a retried append adds nothing."""
    return F.sha2(F.concat_ws("|", *parts), 256)


#: The pay fields whose change counts, of either payload shape: also how pay is meant (mode, gross).
PAY_TERMS = "compensation struct<`from`:string,`to`:string,currencyCode:string,mode:string>, salary struct<`from`:string,`to`:string,currency:string,gross:string>"


def pay_terms(raw) -> F.Column:
    """(lower, upper, currency, terms) of a payload: those of its compensation if it has one, else of its salary; null
    if it has neither."""
    j = F.from_json(raw, PAY_TERMS)
    side = lambda p, cur, terms: F.struct(p["from"].alias("lo"), p["to"].alias("hi"), p[cur].alias("cur"), p[terms].alias("terms"))
    return F.when(j["compensation"].isNotNull(), side(j["compensation"], "currencyCode", "mode")).when(j["salary"].isNotNull(), side(j["salary"], "currency", "gross"))


def checked_types(log: DataFrame) -> DataFrame:
    """The log, failing on the first event of an unknown type."""
    known = F.col("type").isin(*EVENT_TYPES)
    return log.withColumn("type", F.when(known, F.col("type")).otherwise(F.raise_error(F.concat(F.lit("unknown type of event: "), F.coalesce("type", F.lit("null")))).cast("string")))


def pay_payload(old, new) -> F.Column:
    side = lambda p: F.struct(p["cur"].alias("currency"), p["lo"].cast("bigint").alias("from"), p["hi"].cast("bigint").alias("to"))
    return F.to_json(F.struct(side(new).alias("new"), side(old).alias("old")), {"ignoreNullFields": "false"})


def derive_events(prev: DataFrame, curr: DataFrame, ts: str, *, complete: bool = True, payloads: DataFrame | None = None) -> DataFrame:
    """Events between two states (vacancy_id, employer_id, content_hash, raw_json): one full outer join.

    `closed` needs proof that the current state is complete; with complete=False none is derived, as for
    chats, whose sweeps are always partial: only current ids are looked at. Pay has changed if an amount,
    the currency or its terms (mode, gross) did. Null ids are left out.

    Ids and hashes are compared first; payloads are fetched and parsed for changed postings only. With
    `payloads` (vacancy_id, ingest_seq, raw_json) the states hold ingest_seq instead of raw_json, so the
    first pass reads no payload at all.
    """
    has = ["employer_id", "content_hash", *(["ingest_seq"] if payloads is not None else [])]
    p = prev.where("vacancy_id is not null").select("vacancy_id", F.struct(*has).alias("p"))
    c = curr.where("vacancy_id is not null").select("vacancy_id", F.struct(*has).alias("c"))
    both = p.join(c, "vacancy_id", "full_outer" if complete else "right").where("p is null or c is null or not (p.content_hash <=> c.content_hash)")
    both = materialise(both, "changed")
    changed = F.col("p").isNotNull() & F.col("c").isNotNull()

    def pay_of(side: str, state: DataFrame) -> DataFrame:
        terms = [payload_pay(F.col("raw_json")).alias(f"{side}_pay"), pay_terms(F.col("raw_json")).alias(f"{side}_terms")]
        if payloads is None:
            wanted = small(both.where(changed).select("vacancy_id"))
            return state.join(wanted, "vacancy_id", "left_semi").select("vacancy_id", *terms)
        wanted = small(both.where(changed).select("vacancy_id", f"{side}.ingest_seq"))
        return payloads.join(wanted, ["vacancy_id", "ingest_seq"], "left_semi").dropDuplicates(["vacancy_id", "ingest_seq"]).select("vacancy_id", *terms)

    told = both.join(pay_of("p", prev), "vacancy_id", "left").join(pay_of("c", curr), "vacancy_id", "left")
    pay = changed & ~F.col("p_terms").eqNullSafe(F.col("c_terms"))
    kind = F.when(F.col("p").isNull(), "appeared").when(F.col("c").isNull(), "closed").when(pay, "salary_changed").otherwise("desc_changed")
    out = told.select("vacancy_id", F.coalesce("c.employer_id", "p.employer_id").alias("employer_id"), F.lit(ts).cast("timestamp").alias("ts"), kind.alias("type"), F.when(pay, pay_payload(F.col("p_pay"), F.col("c_pay"))).alias("payload"))
    return out.select(event_id("vacancy_id", F.lit(ts), "type").alias("event_id"), *out.columns)


def backfill(lake: DataFrame, known: DataFrame) -> DataFrame:
    """Events of postings that have none: the first record appears, each later change of the hash is
    a change. One window per posting; records repeated at one moment count once."""
    todo = lake.join(known.select("vacancy_id").distinct(), "vacancy_id", "left_anti")
    one = latest_per_key(todo.select("vacancy_id", "fetched_at", "employer_id", "content_hash", payload_pay(F.col("raw_json")).alias("pay"), "ingest_seq"), ["vacancy_id", "fetched_at"], ["ingest_seq"])
    w = Window.partitionBy("vacancy_id").orderBy("fetched_at")
    v = one.select("*", F.lag("content_hash").over(w).alias("h"), F.lag("pay").over(w).alias("old"), F.row_number().over(w).alias("k"))
    v = v.where("k = 1 or not (h <=> content_hash)")
    kind = F.when(F.col("k") == 1, "appeared").when(~F.col("old").eqNullSafe(F.col("pay")), "salary_changed").otherwise("desc_changed")
    return v.select("vacancy_id", F.col("fetched_at").alias("ts"), "employer_id", kind.alias("type"))


def append_new(log: DataFrame, fresh: DataFrame) -> DataFrame:
    """The fresh events whose id the log doesn't have, once each."""
    return fresh.dropDuplicates(["event_id"]).join(log.select("event_id"), "event_id", "left_anti")


def last_days(log: DataFrame, now: str, days: int = 30) -> DataFrame:
    return log.where(F.col("ts") >= F.lit(now).cast("timestamp") - F.make_interval(days=F.lit(days)))


def retained(log: DataFrame, today: str, days: int) -> DataFrame:
    """The log without events from days before today - days."""
    if days < 1:
        raise ValueError("days must be at least 1")
    return log.where(F.to_date(F.to_utc_timestamp("ts", F.current_timezone())) >= F.date_sub(F.lit(today).cast("date"), days))


def without_payload(log: DataFrame, kind: str) -> DataFrame:
    return log.withColumn("payload", F.when(F.col("type") != kind, F.col("payload")))


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key of both; the greatest `order` wins, and of equals the new one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, list(key), [*order, "_new"]).drop("_new")


def missing(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    return wanted.join(have.select(key), key, "left_anti")


def compact(spark: SparkSession, folder: str, to: str, files: int = 1) -> int:
    """Rewrites a partition's small files as `files` files elsewhere and returns the row count, which is
    checked against the original; the caller swaps the folders."""
    rows = spark.read.parquet(folder)
    before = rows.count()
    rows.coalesce(files).write.mode("overwrite").option("compression", "zstd").parquet(to)
    after = spark.read.parquet(to).count()
    if before != after:
        raise RuntimeError(f"{to} has {after} rows, {folder} has {before}")
    return after
