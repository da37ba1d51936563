"""The enriched snapshot: one row for each active posting, from the raw lake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workloom.functions import extract, rules
from workloom.runtime import small

#: Monthly pay in roubles outside these bounds is a slip of the pen and becomes null.
PAY_BOUNDS = (10_000, 5_000_000)

SLIM = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("vacancy_id", T.StringType()), ("title", T.StringType()), ("employer_id", T.StringType()), ("employer_name", T.StringType()),
        ("salary_rub_min", T.LongType()), ("salary_rub_max", T.LongType()), ("salary_currency", T.StringType()), ("salary_disclosed", T.BooleanType()),
        ("city", T.StringType()), ("region", T.StringType()), ("remote_type", T.StringType()), ("seniority", T.StringType()),
        ("description_teaser", T.StringType()), ("skills", T.ArrayType(T.StringType())), ("source", T.StringType()), ("market_scope", T.StringType()),
        ("professional_role_id", T.LongType()), ("source_url", T.StringType()), ("first_seen_at", T.TimestampType()), ("last_seen_at", T.TimestampType()), ("posted_at", T.TimestampType()),
    )]
)

#: The fields of both payload shapes of the board and of a chat message that the snapshot uses.
PAYLOAD = (
    "name string, vacancyId bigint, company struct<name:string,visibleName:string>, employer struct<name:string>,"
    " compensation struct<`from`:bigint,`to`:bigint,currencyCode:string>, salary struct<`from`:bigint,`to`:bigint,currency:string>,"
    " address struct<city:string>, area struct<name:string>, links struct<desktop:string,mobile:string>, alternate_url string,"
    " workFormats array<struct<workFormatsElement:array<string>>>, schedule struct<id:string>, workExperience string, experience struct<id:string>,"
    " channel string, message_id bigint, text string"
)


def outlier_null(amount: Column) -> Column:
    return F.when(amount.between(*PAY_BOUNDS), amount)


def latest_rates(rates: DataFrame, on=None) -> DataFrame:
    """(code, rate): roubles per unit on the latest date of each code at or before `on`, RUB and RUR as 1."""
    known = rates.where("nominal > 0 and value is not null" + ("" if on is None else f" and date <= date'{on}'"))
    per = known.groupBy(F.upper(F.trim("char_code")).alias("code")).agg(F.max_by(F.col("value") / F.col("nominal"), F.struct("date", "value")).alias("rate"))
    fixed = rates.sparkSession.createDataFrame([("RUB", 1.0), ("RUR", 1.0)], "code string, rate double")
    return per.where("code not in ('RUB', 'RUR')").unionByName(fixed)


def to_roubles(amount: Column, rate: Column) -> Column:
    """Whole roubles, halves to the even number; null without an amount or a rate."""
    return F.bround(amount.cast("double") * rate, 0).cast("bigint")


def latest_records(lake: DataFrame, since=None) -> DataFrame:
    """The latest record of each posting with first_seen_at and last_seen_at over all its records.
    `since` drops postings not seen from then on, after these are known. One aggregation: the payload
    travels only in the row that wins, and is combined on the map side."""
    keep = ["source", "employer_id", "raw_json", "posted_at", "market_scope", "professional_role_id"]
    by = F.struct("fetched_at", "ingest_seq")
    got = lake.where("vacancy_id is not null").groupBy("vacancy_id").agg(
        F.min("fetched_at").alias("first_seen_at"), F.max("fetched_at").alias("last_seen_at"), F.max_by(F.struct(*keep), by).alias("r")
    )
    got = got.select("vacancy_id", "first_seen_at", "last_seen_at", "r.*")
    return got if since is None else got.where(F.col("last_seen_at") >= since)


def region_of(city: Column, by_city: dict[str, str], by_subject: dict[str, str]) -> Column:
    """The region of a city as people write it: with an administrative prefix, or with the name of
    its province in brackets, which decides if the city isn't listed."""
    text = F.regexp_replace(F.trim(F.lower(city)), r"^(?:городской\s+округ|город|г\.)\s+", "")
    inside = F.regexp_extract(text, r"\(([^)]*)\)", 1)
    bare = F.trim(F.regexp_replace(text, r"\([^)]*\)", ""))
    subject = F.trim(F.regexp_replace(F.regexp_replace(F.trim(inside), r"\s+(?:область|край|республика|автономн\S+\s+(?:область|округ)|ао|округ|г\.?)$", ""), r"^республика\s+", ""))
    table = lambda d, c: F.element_at(F.create_map(*[F.lit(x) for kv in d.items() for x in kv]), c) if d else F.lit(None).cast("string")
    return F.coalesce(table(by_city, text), table(by_city, bare), table(by_subject, subject))


def build(lake: DataFrame, rates: DataFrame, *, since=None, details: DataFrame | None = None, taxonomy=None, by_city: dict[str, str] | None = None, by_subject: dict[str, str] | None = None) -> DataFrame:
    """Rows of SLIM. Board payloads of both shapes and chat posts are read in one pass; the text rules
    are CASE chains, only pay, years and skills of free texts run in Python.

    Defined cases: a payload that isn't JSON gives nulls and the title '' (board) or '(untitled)'
    (chat); pay without a known rate is null; `salary_disclosed` needs an amount that remains.
    """
    rec = latest_records(lake, since).withColumn("p", F.from_json("raw_json", PAYLOAD)).drop("raw_json")
    chat = F.col("source") == "telegram"
    if details is not None:
        rec = rec.join(details.select("vacancy_id", F.col("description_teaser").alias("_teaser"), F.col("description_fts").alias("_fts")), "vacancy_id", "left")
    else:
        rec = rec.withColumns({"_teaser": F.lit(None).cast("string"), "_fts": F.lit(None).cast("string")})
    said = F.when(chat, F.coalesce("p.text", F.lit("")))
    lines = F.filter(F.transform(F.split(said, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    title = F.when(chat, F.coalesce(F.left(F.get(lines, 0), F.lit(200)), F.lit("(untitled)"))).otherwise(F.coalesce("p.name", F.lit("")))
    rec = rec.withColumns({"_said": said, "title": title, "_chat": chat})
    body = F.nullif(F.concat_ws(" ", F.nullif("_teaser", F.lit("")), F.nullif("_fts", F.lit(""))), F.lit(""))
    words = F.when(F.col("_chat"), F.col("_said")).otherwise(F.concat_ws(" ", F.nullif("title", F.lit("")), body))
    # pay, years and skills in one step, so that the texts pass to Python once
    rec = rec.withColumns({"_body": body, "_pay": extract.pay("_said"), "_years": extract.years(F.coalesce("_said", body)), "_skills": extract.skills(words, taxonomy)})
    lo, hi, cur = (F.coalesce(f"p.compensation.{a}", f"p.salary.{b}") for a, b in (("from", "from"), ("to", "to"), ("currencyCode", "currency")))
    rec = rec.withColumns({
        "_lo": F.when(chat, F.col("_pay.min")).otherwise(lo), "_hi": F.when(chat, F.col("_pay.max")).otherwise(hi),
        "salary_currency": F.when(chat, F.col("_pay.currency")).otherwise(cur),
        "_disclosed": F.when(chat, F.col("_pay.disclosed")).otherwise((F.coalesce(lo, F.lit(0)) != 0) | (F.coalesce(hi, F.lit(0)) != 0)),
    })
    rec = rec.join(small(latest_rates(rates)), F.upper("salary_currency") == F.col("code"), "left")
    rec = rec.withColumns({c: outlier_null(to_roubles(F.col(x), F.col("rate"))) for c, x in (("salary_rub_min", "_lo"), ("salary_rub_max", "_hi"))})
    seen = F.when(F.col("_chat"), F.col("_said")).otherwise(F.col("title"))
    rec = rec.withColumns({
        "city": F.when(chat, rules.city(F.col("_said"))).otherwise(F.coalesce("p.address.city", "p.area.name")),
        "_stated": rules.stated_level(seen, F.when(~F.col("_chat"), F.col("_body"))),
        "_place": rules.workplace(F.when(F.col("_chat"), F.col("_said")).otherwise(F.concat_ws(" ", F.nullif("title", F.lit("")), "_teaser"))),
    })
    formats = F.flatten(F.transform("p.workFormats", lambda x: x["workFormatsElement"]))
    native = F.coalesce(
        rules.lookup(F.get(F.filter(formats, lambda x: x.isin(*rules.WORK_FORMAT)), 0), rules.WORK_FORMAT), rules.lookup(F.col("p.schedule.id"), rules.SCHEDULE)
    )
    level = F.coalesce("_stated", extract.level_of_years(F.col("_years")), rules.lookup(F.coalesce("p.workExperience", "p.experience.id"), rules.EXPERIENCE_LEVEL), F.lit("unknown"))
    url = F.when(F.col("_chat"), F.concat(F.lit("https://t.me/"), "p.channel", F.lit("/"), F.col("p.message_id").cast("string")))
    out = rec.select(
        "vacancy_id", "title", F.when(~F.col("_chat"), F.concat("source", F.lit(":"), F.nullif("employer_id", F.lit("")))).alias("employer_id"),
        F.coalesce("p.company.visibleName", "p.company.name", "p.employer.name").alias("employer_name"),
        "salary_rub_min", "salary_rub_max", "salary_currency",
        (F.col("_disclosed") & (F.col("salary_rub_min").isNotNull() | F.col("salary_rub_max").isNotNull())).alias("salary_disclosed"),
        "city", region_of(F.col("city"), by_city or {}, by_subject or {}).alias("region"),
        F.coalesce(native, "_place").alias("remote_type"), level.alias("seniority"),
        F.when(F.col("_chat"), F.left("_said", F.lit(500))).otherwise(F.col("_teaser")).alias("description_teaser"), F.col("_skills").alias("skills"),
        "source", "market_scope", "professional_role_id",
        F.coalesce(url, "p.links.desktop", "p.links.mobile", "p.alternate_url").alias("source_url"), "first_seen_at", "last_seen_at", "posted_at",
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in SLIM.fields])


#: Characters of a description that its teaser has at most.
TEASER = 500


def details_of(adverts: DataFrame) -> DataFrame:
    """(vacancy_id, description_teaser, description_fts) from adverts: the whole text, and its start cut
    between words. Of several texts of a vacancy the latest first seen counts."""
    rows = adverts.where("vacancy_id is not null and text is not null").groupBy("vacancy_id").agg(F.max_by("text", F.struct("first_seen_at", "text")).alias("t"))
    start = F.regexp_replace(F.left("t", F.lit(TEASER)), r"(?s)^(.+) [^ ]*$", "$1")
    return rows.select("vacancy_id", F.when(F.length("t") > TEASER, start).otherwise(F.col("t")).alias("description_teaser"), F.col("t").alias("description_fts"))


#: Pictures and marks that a cleaned title has not.
_PICTURES = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2190}-\x{21FF}\x{2300}-\x{23FF}\x{2B00}-\x{2BFF}\x{FE00}-\x{FE0F}\x{200D}]+"
_EDGE = r"[\s\-–—|·•:]+"


def clean_title(text: Column) -> Column:
    """A text without zero-width characters, links, markup and pictures, with single spaces."""
    steps = [("[​﻿]", ""), (r"\[([^\]]+)\]\([^)]*\)", "$1"), (r"\]\([^)\s]*\)?", ""), (r"https?://\S+", ""), (r"[*_`>#\[\]]+", ""), (_PICTURES, ""), (r"\s+", " ")]
    text = F.coalesce(text, F.lit(""))
    for pattern, to in steps:
        text = F.regexp_replace(text, pattern, to)
    return F.regexp_replace(F.regexp_replace(text, "^" + _EDGE, ""), _EDGE + "$", "")


def artifact_rows(slim: DataFrame) -> DataFrame:
    """(id, row): the compact JSON row of each posting for the browser; nulls and empties are left
    out. A title that cleans away is taken from the teaser; a row with neither is dropped."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    r = slim.select("*", clean_title(F.col("title")).alias("t0"), clean_title(F.col("description_teaser")).alias("d0")).where("t0 <> '' or d0 <> ''")
    rescued = F.concat(F.rtrim(F.left("d0", F.lit(80))), F.when(F.length("d0") > 80, "…").otherwise(""))
    r = r.withColumn("t", F.when(F.col("t0") != "", F.col("t0")).otherwise(rescued)).withColumn("d1", F.when(F.col("t0") != "", F.col("d0")).otherwise(""))
    rest = F.expr("substring(d1, length(t) + 1)")
    same = F.startswith(F.lower("d1"), F.lower("t"))
    r = r.withColumn("d2", F.when(same, F.regexp_replace(F.regexp_replace(rest, "^" + _EDGE, ""), _EDGE + "$", "")).otherwise(F.col("d1")))
    r = r.withColumn("d3", F.when(F.length("d2") > 160, F.concat(F.rtrim(F.left("d2", F.lit(160))), F.lit("…"))).otherwise(F.col("d2")))
    full = lambda c: F.nullif(c, F.lit(""))
    row = F.to_json(F.struct(
        F.col("vacancy_id").alias("id"), F.col("t"), full("employer_name").alias("e"), full("city").alias("c"), full("region").alias("rg"),
        F.col("salary_rub_min").alias("smin"), F.col("salary_rub_max").alias("smax"), F.coalesce("remote_type", F.lit("unknown")).alias("rt"),
        F.coalesce("seniority", F.lit("unknown")).alias("sr"), F.col("source").alias("src"), full("source_url").alias("u"),
        F.when(F.size("skills") > 0, F.col("skills")).alias("sk"), day("last_seen_at").alias("ls"), day("posted_at").alias("ps"), full("d3").alias("ds"),
    ))
    return r.select(F.col("vacancy_id").alias("id"), row.alias("row"))
