"""Queries of the lake's state: latest rows, diffs, backfill, rates, upserts, hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from workloom.functions import extract
from workloom.operators import slim as slim_op
from workloom.operators import snapshots, state, units
from workloom.plans.views import EVENTS_SQL, events
from workloom.runtime import small, table, utc_date

CUT = "2026-04-28 23:59:59"
_LATEST = ["vacancy_id", "source", "fetched_at", "ingest_seq", "content_hash", "employer_id"]


def _lake(s, d):
    return table(s, d, "raw_lake")


def _at(s, d, cut, *more):
    return snapshots.as_of(_lake(s, d).select(*_LATEST, *more), ["vacancy_id"], "fetched_at", F.lit(cut).cast("timestamp"), ["ingest_seq"])


def snapshot_diff(s, d):
    """Events between the board's states before and after one sweep, with payloads."""
    board = _lake(s, d).where("source = 'hh'")
    day = lambda x: snapshots.latest_per_key(board.where(utc_date("fetched_at") == x).select(*_LATEST), ["vacancy_id"], ["fetched_at", "ingest_seq"])
    return state.derive_events(day("2026-05-11"), day("2026-05-18"), "2026-05-18 00:00:00", payloads=board.select("vacancy_id", "ingest_seq", "raw_json")).drop("ts")


def fx_asof(s, d):
    """Roubles per unit on each day that a pay was posted, by the latest rate at or before it."""
    days = table(s, d, "salary_parses").select(F.col("posted_on").alias("day")).distinct()
    until = days.agg(F.max("day")).first()[0]
    rates = small(units.daily_rates(table(s, d, "cbr_rates"), until))
    return days.join(rates, "day").select("day", "code", F.round(F.col("num") / F.col("den"), 8).cast("double").alias("rate"))


def salary_normalize(s, d):
    """Board pay in roubles by the latest rates, halves to even, outliers nulled."""
    pay = _lake(s, d).where("source = 'hh'").select("ingest_seq", snapshots.payload_pay(F.col("raw_json")).alias("p")).distinct()
    got = pay.join(small(slim_op.latest_rates(table(s, d, "cbr_rates"))), F.upper("p.cur") == F.col("code"), "left")
    rub = lambda c: slim_op.to_roubles(F.col(c), F.col("rate"))
    return got.select("ingest_seq", rub("p.lo").alias("rub_min"), rub("p.hi").alias("rub_max"), slim_op.outlier_null(rub("p.lo")).alias("kept_min"))


def shape_dispatch(s, d):
    """Title, employer, city, pay and experience of a payload of either shape."""
    p = F.from_json("raw_json", slim_op.PAYLOAD)
    rows = _lake(s, d).where("source = 'hh'").select("ingest_seq", p.alias("p")).distinct()
    shape = F.when(F.col("p.vacancyId").isNotNull(), "web").otherwise("api")
    return rows.select(
        "ingest_seq", shape.alias("shape"), F.col("p.name").alias("title"), F.coalesce("p.company.visibleName", "p.company.name", "p.employer.name").alias("employer"),
        F.coalesce("p.address.city", "p.area.name").alias("city"), F.coalesce("p.compensation.from", "p.salary.from").alias("pay_from"), F.coalesce("p.workExperience", "p.experience.id").alias("experience"),
    )


def rates_upsert(s, d):
    """The rates from May 15 on upserted into those before June, one row per date and code, however its letters were
    written: of a day in both the later delivery, here marked by a doubled nominal, stays."""
    rates = table(s, d, "cbr_rates").withColumn("char_code", F.upper("char_code")).distinct()
    later = rates.where("date >= '2026-05-15'").withColumn("nominal", F.col("nominal") * 2)
    return state.upsert(rates.where("date < '2026-06-01'"), later, ["date", "char_code"])


def closed_ids(s, d):
    """Ids of the first sweep that the last one has not, by set difference."""
    day = lambda x: _lake(s, d).where(utc_date("fetched_at") == x).select("vacancy_id")
    return day("2026-04-06").subtract(day("2026-05-25"))


def common_ids(s, d):
    day = lambda x: _lake(s, d).where(utc_date("fetched_at") == x).select("vacancy_id")
    return day("2026-04-06").intersect(day("2026-05-25"))


def details_upsert(s, d):
    """Details seen from May 1 on upserted into those seen before May 15: rows of only one side are kept, rows of both
    are taken from the later text, and of equal ones the new."""
    rows = table(s, d, "vacancies").select("vacancy_id", "title", "first_seen_at").distinct()
    at = lambda day: F.lit(f"{day} 00:00:00Z").cast("timestamp")
    old = rows.where(F.col("first_seen_at") < at("2026-05-15")).select("vacancy_id", F.concat(F.coalesce("title", F.lit("")), F.lit(" (old)")).alias("title"), "first_seen_at")
    return state.upsert(old, rows.where(F.col("first_seen_at") >= at("2026-05-01")), ["vacancy_id"], ["first_seen_at"])


QUERIES = {
    "latest_snapshot": lambda s, d: snapshots.latest_per_key(_lake(s, d).select(*_LATEST), ["vacancy_id"], ["fetched_at", "ingest_seq"]).select(*_LATEST),
    "snapshot_as_of": lambda s, d: _at(s, d, CUT).select(*_LATEST),
    "snapshot_diff": snapshot_diff,
    "event_backfill": lambda s, d: state.backfill(_lake(s, d), events(s, d)),
    "events_last_30d": lambda s, d: state.last_days(events(s, d), "2026-04-20 00:00:00").select("event_id", "vacancy_id", "type"),
    "events_retention": lambda s, d: state.retained(events(s, d), "2026-04-06", 14).groupBy("type").agg(F.count("*").alias("n")),
    "payload_nullout": lambda s, d: state.without_payload(events(s, d), "salary_changed").groupBy("type").agg(F.count("payload").alias("with_payload"), F.count("*").alias("n")),
    "append_idempotent": lambda s, d: state.append_new(events(s, d).where("type = 'closed'"), table(s, d, "slim_events")).groupBy("type").agg(F.count("*").alias("n")),
    "fx_asof": fx_asof,
    "salary_normalize": salary_normalize,
    "rates_upsert": rates_upsert,
    "details_upsert": details_upsert,
    "missing_details_antijoin": lambda s, d: state.missing(table(s, d, "vacancies").select("vacancy_id").distinct(), table(s, d, "slim_events"), "vacancy_id"),
    "active_semijoin": lambda s, d: table(s, d, "vacancies").select("vacancy_id", "city").distinct().join(events(s, d).where("type = 'appeared'").select("vacancy_id"), "vacancy_id", "left_semi"),
    "content_hash": lambda s, d: table(s, d, "tg_messages").distinct().select("channel", "message_id", F.substring(F.sha2("text", 256), 1, 16).alias("hash")),
    "canonical_json_hash": lambda s, d: _lake(s, d).select("ingest_seq", "raw_json").distinct().select("ingest_seq", extract.canonical_hash("raw_json").alias("hash")),
    "shape_dispatch_json": shape_dispatch,
    "ids_difference": closed_ids,
    "ids_intersection": common_ids,
    "freshness_gate": lambda s, d: _lake(s, d).agg(F.count("*").alias("rows"), F.max("fetched_at").alias("newest"), (F.max("fetched_at") >= F.lit("2026-05-25 00:00:00").cast("timestamp")).alias("fresh")).withColumn("newest", F.date_format(F.to_utc_timestamp("newest", F.current_timezone()), "yyyy-MM-dd HH:mm:ss")),
}

_PAY = """coalesce(json_extract_string({0}, '$.compensation.from'), json_extract_string({0}, '$.salary.from')) as lo,
  coalesce(json_extract_string({0}, '$.compensation.to'), json_extract_string({0}, '$.salary.to')) as hi,
  coalesce(json_extract_string({0}, '$.compensation.currencyCode'), json_extract_string({0}, '$.salary.currency')) as cur"""


def _pay_struct(j: str) -> str:
    pairs = (("lo", "from", "from"), ("hi", "to", "to"), ("cur", "currencyCode", "currency"))
    return ", ".join(f"{k} := coalesce(json_extract_string({j}, '$.compensation.{a}'), json_extract_string({j}, '$.salary.{b}'))" for k, a, b in pairs)


_DAY = "cast(fetched_at at time zone 'UTC' as date)"
_COLS = ", ".join(_LATEST)
_STATE = "(select vacancy_id, arg_max(struct_pack(h := content_hash, e := employer_id, j := raw_json), (fetched_at, ingest_seq)) as r from raw_lake where source = 'hh' and " + _DAY + " = date '{0}' group by 1)"
_RATES = """rates as (select upper(trim(char_code)) as code, arg_max(value / nominal, (date, value)) as rate from cbr_rates where nominal > 0 and value is not null
  and upper(trim(char_code)) not in ('RUB', 'RUR') group by 1 union all select * from (values ('RUB', 1.0), ('RUR', 1.0)))"""

SQL = {
    "latest_snapshot": f"select {_COLS} from (select distinct {_COLS} from raw_lake) qualify row_number() over (partition by vacancy_id order by fetched_at desc, ingest_seq desc) = 1",
    "snapshot_as_of": f"select {_COLS} from (select distinct {_COLS} from raw_lake where fetched_at <= '{CUT}+00') qualify row_number() over (partition by vacancy_id order by fetched_at desc, ingest_seq desc) = 1",
    "snapshot_diff": f"""
with p as (select vacancy_id, r.h as h, r.e as e, r.j as j from {_STATE.format('2026-05-11')}), c as (select vacancy_id, r.h as h, r.e as e, r.j as j from {_STATE.format('2026-05-18')}),
b as (select coalesce(p.vacancy_id, c.vacancy_id) as vacancy_id, coalesce(c.e, p.e) as employer_id, p.vacancy_id is null as new, c.vacancy_id is null as gone, p.h as ph, c.h as ch,
  struct_pack({_pay_struct('p.j')}) as a, struct_pack({_pay_struct('c.j')}) as b
  from p full outer join c using (vacancy_id)),
k as (select *, a.lo is distinct from b.lo or a.hi is distinct from b.hi or a.cur is distinct from b.cur as pay from b where new or gone or ph is distinct from ch)
select sha256(vacancy_id || '|2026-05-18 00:00:00|' || case when new then 'appeared' when gone then 'closed' when pay then 'salary_changed' else 'desc_changed' end) as event_id,
  vacancy_id, employer_id, case when new then 'appeared' when gone then 'closed' when pay then 'salary_changed' else 'desc_changed' end as type,
  case when not new and not gone and pay then '{{"new":{{"currency":' || coalesce('"' || b.cur || '"', 'null') || ',"from":' || coalesce(b.lo, 'null') || ',"to":' || coalesce(b.hi, 'null')
    || '}},"old":{{"currency":' || coalesce('"' || a.cur || '"', 'null') || ',"from":' || coalesce(a.lo, 'null') || ',"to":' || coalesce(a.hi, 'null') || '}}}}' end as payload
from k""",
    "event_backfill": f"""
with one as (select vacancy_id, fetched_at, arg_max(struct_pack(h := content_hash, e := employer_id, j := raw_json), ingest_seq) as r from raw_lake
  where vacancy_id not in (select vacancy_id from slim_events) group by all),
x as (select vacancy_id, fetched_at, r.e as e, r.h as h, {_PAY.format('r.j')} from one),
v as (select *, lag(h) over w as ph, lag(lo) over w as plo, lag(hi) over w as phi, lag(cur) over w as pcur, row_number() over w as k from x window w as (partition by vacancy_id order by fetched_at))
select vacancy_id, fetched_at as ts, e as employer_id, case when k = 1 then 'appeared' when lo is distinct from plo or hi is distinct from phi or cur is distinct from pcur then 'salary_changed' else 'desc_changed' end as type
from v where k = 1 or h is distinct from ph""",
    "events_last_30d": f"with {EVENTS_SQL} select event_id, vacancy_id, type from ev where ts >= '2026-03-21 00:00:00+00'",
    "events_retention": f"with {EVENTS_SQL} select type, count(*) as n from ev where cast(ts at time zone 'UTC' as date) >= date '2026-03-23' group by 1",
    "payload_nullout": f"with {EVENTS_SQL} select type, count(case when type <> 'salary_changed' then payload end) as with_payload, count(*) as n from ev group by 1",
    "append_idempotent": f"with {EVENTS_SQL} select type, count(*) as n from ev where event_id not in (select event_id from ev where type = 'closed') group by 1",
    "fx_asof": """
with c as (select upper(trim(char_code)) as code, date, max(value / nominal) as rate from cbr_rates where nominal > 0 group by all),
d as (select distinct posted_on as day from salary_parses)
select day, code, round(arg_max(rate, date), 8) as rate from d join c on c.date <= d.day where code not in ('RUB', 'RUR') group by day, code""",
    "salary_normalize": f"""
with {_RATES}, p as (select distinct ingest_seq, {_PAY.format('raw_json')} from raw_lake where source = 'hh'),
r as (select ingest_seq, cast(round_even(cast(lo as double) * rate, 0) as bigint) as a, cast(round_even(cast(hi as double) * rate, 0) as bigint) as b from p left join rates on upper(cur) = code)
select ingest_seq, a as rub_min, b as rub_max, case when a between 10000 and 5000000 then a end as kept_min from r""",
    "rates_upsert": "select date, upper(char_code) as char_code, cast(any_value(nominal) * case when date >= '2026-05-15' then 2 else 1 end as int) as nominal, any_value(value) as value from cbr_rates group by date, upper(char_code)",
    "details_upsert": """with r as (select distinct vacancy_id, title, first_seen_at from vacancies),
u as (select vacancy_id, coalesce(title, '') || ' (old)' as title, first_seen_at, 0 as new from r where first_seen_at < '2026-05-15 00:00:00+00' union all select *, 1 from r where first_seen_at >= '2026-05-01 00:00:00+00')
select vacancy_id, title, first_seen_at from u qualify row_number() over (partition by vacancy_id order by first_seen_at desc, new desc) = 1""",
    "missing_details_antijoin": "select distinct vacancy_id from vacancies where vacancy_id not in (select vacancy_id from slim_events)",
    "active_semijoin": "select distinct vacancy_id, city from vacancies where vacancy_id in (select vacancy_id from slim_events where type = 'appeared')",
    "content_hash": "select channel, message_id, substr(sha256(text), 1, 16) as hash from (select distinct * from tg_messages)",
    # the keys of the payloads are sorted already, so the text without blanks is the canonical one
    "canonical_json_hash": "select ingest_seq, substr(sha256(cast(json(raw_json) as varchar)), 1, 16) as hash from (select distinct ingest_seq, raw_json from raw_lake)",
    "shape_dispatch_json": """
select ingest_seq, case when json_exists(raw_json, '$.vacancyId') then 'web' else 'api' end as shape, json_extract_string(raw_json, '$.name') as title,
  coalesce(json_extract_string(raw_json, '$.company.visibleName'), json_extract_string(raw_json, '$.company.name'), json_extract_string(raw_json, '$.employer.name')) as employer,
  coalesce(json_extract_string(raw_json, '$.address.city'), json_extract_string(raw_json, '$.area.name')) as city,
  cast(coalesce(json_extract_string(raw_json, '$.compensation.from'), json_extract_string(raw_json, '$.salary.from')) as bigint) as pay_from,
  coalesce(json_extract_string(raw_json, '$.workExperience'), json_extract_string(raw_json, '$.experience.id')) as experience
from (select distinct ingest_seq, raw_json from raw_lake where source = 'hh')""",
    "ids_difference": f"select vacancy_id from raw_lake where {_DAY} = date '2026-04-06' except select vacancy_id from raw_lake where {_DAY} = date '2026-05-25'",
    "ids_intersection": f"select vacancy_id from raw_lake where {_DAY} = date '2026-04-06' intersect select vacancy_id from raw_lake where {_DAY} = date '2026-05-25'",
    "freshness_gate": "select count(*) as rows, strftime(max(fetched_at) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as newest, max(fetched_at) >= '2026-05-25 00:00:00+00' as fresh from raw_lake",
}
