"""Queries of the general data problems (p1, p3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workloom.operators import snapshots, units
from workloom.runtime import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every vacancy that appeared, closed or changed between consecutive snapshots of its source."""
    out = snapshots.lake_changes(table(spark, d, "raw_lake"))
    return out.select("vacancy_id", F.date_format("snapshot", "yyyy-MM-dd").alias("snapshot_day"), "type").distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Both pay bounds in roubles per month."""
    out = units.monthly_roubles(table(spark, d, "salary_parses"), table(spark, d, "cbr_rates"), table(spark, d, "pay_periods"))
    absent = lambda c: F.coalesce(F.col(c), F.lit(-1)).cast("bigint").alias(c)
    return out.where("review is null").select("parse_id", absent("rub_min"), absent("rub_max")).distinct()


def p3_review(spark: SparkSession, d: str) -> DataFrame:
    """One row for each row with a bound: its outcome in p3_found, where the rules check the predicted units and
    settle what is under review, and the outcome of the predictions alone, each `converted` or the
    reason why not, with where each unit came from."""
    rows, days = units.with_units(table(spark, d, "salary_parses"), table(spark, d, "cbr_rates"))
    out = []
    for prefix, conventions in (("", True), ("predicted_", False)):
        got = units.settled(rows, days, table(spark, d, "pay_periods"), conventions=conventions)
        named = [F.coalesce("review", F.lit("converted")).alias(f"{prefix}outcome"), *(F.col(c).alias(f"{prefix}{c}") for c in ("currency_from", "period_from", "scale_from"))]
        out.append(got.select("parse_id", *named).distinct())
    return out[0].join(out[1], "parse_id")


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p3_review": p3_review}

_GAP = "[\\s\u00a0\u2007\u2009\u202f'\u2019]".replace("'", "''")
_NUMBER = "(\\d+(?:[.,]\\d+)?)[\\s\u00a0\u202f]*(?:(т\\.\\s?р|тыс|млн|миллион|million|mln)|(тр)(?:[^а-я]|$)|([kкmм])(?:[^a-zа-я]|$))?"


def _named_sql(text: str, words: tuple) -> str:
    free = lambda p: p.replace("(?<![а-я])", "(?:^|[^а-я])").replace("(?<![a-z])", "(?:^|[^a-z])").replace("(?![а-я])", "(?:$|[^а-я])").replace("(?![a-z])", "(?:$|[^a-z])")
    return "case " + " ".join(f"when regexp_matches({text}, '{free(p)}') then '{name}'" for name, p in words) + " end"


def _scale_sql(bound: str, at: str) -> str:
    hits = f"list_filter(range(1, len(numbers) + 1), lambda i: numbers[i] = cast({bound} as varchar))"
    return f"coalesce(case when len({hits}) > 0 then coalesce(scales[{hits}[{at}]], list_filter(scales, lambda s: s is not null)[1]) end, 1)"


def _roubles_sql(bound: str, scale: str) -> str:
    over, under = f"({bound}::hugeint * {scale}::hugeint * num::hugeint * rate_num::hugeint)", "(den::hugeint * rate_den::hugeint)"
    return f"case when {bound} is null then -1 else cast((2 * {over} + {under}) // (2 * {under}) as bigint) end"


SQL = {
    "p3_found": f"""
with p as (select distinct parse_id, posted_on, min as lo, max as hi, lower(currency) as c, lower(salary_text) as t from salary_parses where min is not null or max is not null),
flat as (select *, regexp_replace(regexp_replace(coalesce(t, ''), '(\\d){_GAP}(\\d\\d\\d)', '\\1\\2', 'g'), '(\\d){_GAP}(\\d\\d\\d)', '\\1\\2', 'g') as f from p),
named as (select *, coalesce({_named_sql('c', units.CURRENCY_WORDS)}, {_named_sql('t', units.CURRENCY_WORDS)}) as code, coalesce({_named_sql('t', units.PERIOD_WORDS)}, 'month') as period,
  regexp_extract_all(f, '{_NUMBER}', 1) as numbers,
  list_transform(range(1, len(regexp_extract_all(f, '{_NUMBER}', 1)) + 1), lambda i: concat(regexp_extract_all(f, '{_NUMBER}', 2)[i], regexp_extract_all(f, '{_NUMBER}', 3)[i], regexp_extract_all(f, '{_NUMBER}', 4)[i])) as words from flat),
scaled as (select *, list_transform(words, lambda w: case when regexp_matches(w, '^(т\\.\\s?р|тыс|тр|[kк])') then 1000 when w <> '' then 1000000 end) as scales from named),
sized as (select *, {_scale_sql('lo', '1')} as scale_lo, {_scale_sql('hi', '-1')} as scale_hi from scaled),
rates as (select code, date, max(struct_pack(rate := value / nominal, num := cast(round(value * 1000000) as bigint), den := nominal::bigint * 1000000)) as r
  from (select upper(trim(char_code)) as code, date, value, nominal from cbr_rates where value is not null and nominal > 0 and date is not null) group by all),
asof_ as (select code, day, arg_max(r, date) as r from rates join (select distinct posted_on as day from p) on date <= day group by all),
every as (select code, day, r.num as rate_num, r.den as rate_den from asof_ where code not in ('RUB', 'RUR') union all select distinct 'RUB', posted_on, 1, 1 from p),
joined as (select s.*, rate_num, rate_den, per_month_num as num, per_month_den as den from sized s join every e on s.code = e.code and s.posted_on = e.day join pay_periods k on k.period = s.period)
select distinct parse_id, {_roubles_sql('lo', 'scale_lo')} as rub_min, {_roubles_sql('hi', 'scale_hi')} as rub_max from joined
""",
    "p1_found": """
with latest as (
  select source, vacancy_id, cast(fetched_at at time zone 'UTC' as date) as d,
         arg_max(content_hash, (fetched_at, ingest_seq)) as h,
         arg_max(raw_json, (fetched_at, ingest_seq)) as j
  from raw_lake group by all),
days as (
  select source, d, lead(d) over (partition by source order by d) as nxt,
         lag(d) over (partition by source order by d) as prv
  from (select distinct source, d from latest)),
paid as (
  select l.*, days.nxt, days.prv,
    coalesce(json_extract_string(j, '$.compensation.from'), json_extract_string(j, '$.salary.from')) as lo,
    coalesce(json_extract_string(j, '$.compensation.to'), json_extract_string(j, '$.salary.to')) as hi,
    coalesce(json_extract_string(j, '$.compensation.currencyCode'), json_extract_string(j, '$.salary.currency')) as cur
  from latest l join days using (source, d)),
a as (select * from paid where nxt is not null),
b as (select * from paid where prv is not null)
select coalesce(b.vacancy_id, a.vacancy_id) as vacancy_id,
       strftime(coalesce(b.d, a.nxt), '%Y-%m-%d') as snapshot_day,
       case when a.vacancy_id is null then 'appeared' when b.vacancy_id is null then 'closed'
            when a.lo is distinct from b.lo or a.hi is distinct from b.hi or a.cur is distinct from b.cur then 'salary_changed'
            else 'desc_changed' end as type
from a full outer join b on a.source = b.source and a.vacancy_id = b.vacancy_id and a.nxt = b.d
where a.h is distinct from b.h or a.vacancy_id is null or b.vacancy_id is null
""",
}
