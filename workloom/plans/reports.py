"""The monthly, employer and skill reports, and the queries that the data contracts promise."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workloom.plans.views import EVENTS_SQL, SLIM_SQL, events, slim
from workloom.plans.weekly import _ROLE, _SKILLS, _lake_salary, role_salaries, skill_mentions
from workloom.runtime import utc_date

MONTH, NEXT = "2026-03-01", "2026-04-01"
EMPLOYER = "hh:100000"


def _month(log: DataFrame) -> DataFrame:
    return log.where(f"ts >= timestamp'{MONTH} 00:00:00Z' and ts < timestamp'{NEXT} 00:00:00Z'")


def event_mix(log: DataFrame) -> DataFrame:
    return _month(log).groupBy("type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type")


def daily_new_closed(log: DataFrame) -> DataFrame:
    n = lambda t: F.count_if(F.col("type") == t)
    return _month(log).groupBy(utc_date("ts").alias("day")).agg(n("appeared").alias("new_n"), n("closed").alias("closed_n")).orderBy("day")


def top_employers(log: DataFrame, postings: DataFrame, k: int = 25) -> DataFrame:
    """Employers with the most new postings; the top k are known before names are joined."""
    new = _month(log).where("type = 'appeared' and employer_id is not null").groupBy("employer_id").agg(F.count("*").alias("new_n"))
    new = new.orderBy(F.desc("new_n"), "employer_id").limit(k)
    stats = postings.groupBy("employer_id").agg(F.min("employer_name").alias("employer_name"), F.round(F.avg(F.col("disclosed").cast("int")), 6).alias("rate"))
    return new.join(stats, "employer_id", "left").select("employer_id", "employer_name", "new_n", F.coalesce("rate", F.lit(0.0)).alias("disclosure_rate"))


def _skills(postings: DataFrame) -> DataFrame:
    return postings.select("vacancy_id", "smin", F.explode("skills").alias("skill")).where("skill is not null and skill <> ''")


def top_skills(postings: DataFrame, k: int = 20) -> DataFrame:
    return _skills(postings).groupBy("skill").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "skill").limit(k)


def salary_by_seniority(postings: DataFrame) -> DataFrame:
    """Continuous quartiles of the lower bound; halves to even."""
    q = lambda p: F.bround(F.percentile("smin", F.lit(p)), 0).cast("int")
    got = postings.where("smin is not null").groupBy("seniority").agg(F.count("smin").alias("sample"), q(0.25).alias("p25"), q(0.5).alias("median"), q(0.75).alias("p75"))
    return got.where("sample >= 3").orderBy(F.desc_nulls_last("median"), "seniority")


def employer_profile(postings: DataFrame, employer: str = EMPLOYER) -> DataFrame:
    own = postings.where(F.col("employer_id") == employer)
    return own.select("vacancy_id", "title", "city", "seniority", F.coalesce("smin", "smax", F.lit(0)).cast("int").alias("salary_min"), F.count("*").over(Window.partitionBy("employer_name")).alias("active_under_name")).orderBy(F.desc("salary_min"), "vacancy_id")


def employer_events(log: DataFrame, employer: str = EMPLOYER) -> DataFrame:
    return log.where(F.col("employer_id") == employer).groupBy(utc_date("ts").alias("day"), "type").agg(F.count("*").alias("n")).orderBy("day", "type")


def skill_landscape(postings: DataFrame, k: int = 30) -> DataFrame:
    per = _skills(postings).groupBy("skill").agg(F.count("*").alias("n"), F.round(F.avg("smin"), 0).cast("bigint").alias("avg_salary"))
    return per.orderBy(F.desc("n"), "skill").limit(k)


def skill_pairs(postings: DataFrame, top: int = 15, k: int = 50) -> DataFrame:
    """How often two of the most frequent skills stand in one posting. The pairs come from within a
    posting's own list, so no join is needed; the 15 names are a top-k result of known size."""
    best = top_skills(postings, top).agg(F.collect_list("skill").alias("best"))  # one row of 15 names
    kept = postings.where(F.size("skills") > 0).join(F.broadcast(best), F.lit(True)).select(F.array_intersect("skills", "best").alias("s"))
    one = kept.select(F.explode("s").alias("skill_a"), "s").select("skill_a", F.explode("s").alias("skill_b")).where("skill_a < skill_b")
    return one.groupBy("skill_a", "skill_b").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "skill_a", "skill_b").limit(k)


def hires_last_week(log: DataFrame, now: str) -> DataFrame:
    """Per employer over the last 7 days."""
    since = F.lit(now).cast("timestamp") - F.expr("interval 7 days")
    return log.where("type = 'appeared' and employer_id is not null").where(F.col("ts") >= since).groupBy("employer_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "employer_id").limit(50)


def salary_trail(log: DataFrame) -> DataFrame:
    """Every change of pay of the posting with the most changes, in order."""
    changes = log.where("type = 'salary_changed'")
    most = changes.groupBy("vacancy_id").agg(F.count("*").alias("k")).orderBy(F.desc("k"), "vacancy_id").limit(1)
    pick = lambda side, f: F.get_json_object("payload", f"$.{side}.{f}").cast("bigint")
    return changes.join(F.broadcast(most), "vacancy_id").select("vacancy_id", "event_id", *[pick(s, f).alias(f"{s}_{f}") for s in ("old", "new") for f in ("from", "to")])


def growing_skills(mentions: DataFrame, least: int = 50) -> DataFrame:
    last = mentions.agg(F.max("week_start").alias("week_start"))
    return mentions.join(F.broadcast(last), "week_start").where(f"mentions_this_week >= {least} and delta_pct > 0").select("skill", "mentions_this_week", "delta_pct")


QUERIES = {
    "event_mix_month": lambda s, d: event_mix(events(s, d)),
    "daily_new_closed": lambda s, d: daily_new_closed(events(s, d)),
    "top_employers_month": lambda s, d: top_employers(events(s, d), slim(s, d)),
    "top_skills": lambda s, d: top_skills(slim(s, d)),
    "salary_by_seniority": lambda s, d: salary_by_seniority(slim(s, d)),
    "employer_profile": lambda s, d: employer_profile(slim(s, d)),
    "employer_events": lambda s, d: employer_events(events(s, d)),
    "skill_landscape": lambda s, d: skill_landscape(slim(s, d)),
    "skill_cooccurrence": lambda s, d: skill_pairs(slim(s, d)),
    "weekly_hires": lambda s, d: hires_last_week(events(s, d), "2026-04-01 00:00:00"),
    "vacancy_salary_trail": lambda s, d: salary_trail(events(s, d)),
    "growing_skills": lambda s, d: growing_skills(skill_mentions(slim(s, d)), 10),
    "national_heat_map": lambda s, d: _lake_salary(s, d).where("city is null").groupBy("role_canonical", "seniority").agg(F.max("salary_rub_median").alias("top_median"), F.count("*").alias("weeks")),
    "national_role_salary": lambda s, d: role_salaries(slim(s, d)).where("city is null").drop("city"),
}

_M = f"ts >= '{MONTH} 00:00:00+00' and ts < '{NEXT} 00:00:00+00'"
SQL = {
    "event_mix_month": f"with {EVENTS_SQL} select type, count(*) as n from ev where {_M} group by type",
    "daily_new_closed": f"""with {EVENTS_SQL} select cast(ts at time zone 'UTC' as date) as day, cast(sum(case when type = 'appeared' then 1 else 0 end) as bigint) as new_n,
  cast(sum(case when type = 'closed' then 1 else 0 end) as bigint) as closed_n from ev where {_M} group by day""",
    "top_employers_month": f"""with {SLIM_SQL}, {EVENTS_SQL},
n as (select employer_id, count(*) as new_n from ev where type = 'appeared' and {_M} and employer_id is not null group by 1 order by new_n desc, employer_id limit 25)
select n.employer_id, st.employer_name, n.new_n, coalesce(st.rate, 0) as disclosure_rate from n left join
  (select employer_id, min(employer_name) as employer_name, round(avg(disclosed::int), 6) as rate from slim group by 1) st using (employer_id)""",
    "top_skills": f"with {SLIM_SQL} select skill, count(*) as n from (select unnest(skills) as skill from slim) where skill <> '' group by skill order by n desc, skill limit 20",
    "salary_by_seniority": f"""with {SLIM_SQL} select seniority, count(*) as sample, cast(round_even(quantile_cont(smin, 0.25), 0) as int) as p25,
  cast(round_even(quantile_cont(smin, 0.5), 0) as int) as median, cast(round_even(quantile_cont(smin, 0.75), 0) as int) as p75
from slim where smin is not null group by seniority having count(*) >= 3""",
    "employer_profile": f"""with {SLIM_SQL} select vacancy_id, title, city, seniority, cast(coalesce(smin, smax, 0) as int) as salary_min, count(*) over (partition by employer_name) as active_under_name
from slim where employer_id = '{EMPLOYER}'""",
    "employer_events": f"with {EVENTS_SQL} select cast(ts at time zone 'UTC' as date) as day, type, count(*) as n from ev where employer_id = '{EMPLOYER}' group by all",
    "skill_landscape": f"""with {SLIM_SQL} select skill, count(*) as n, cast(round(avg(smin)) as bigint) as avg_salary from (select smin, unnest(skills) as skill from slim)
where skill <> '' group by skill order by n desc, skill limit 30""",
    "skill_cooccurrence": f"""with {SLIM_SQL},
t as (select skill, count(*) as n from (select unnest(skills) as skill from slim) where skill <> '' group by skill order by n desc, skill limit 15),
e as (select vacancy_id, skill from (select vacancy_id, unnest(skills) as skill from slim) where skill in (select skill from t))
select a.skill as skill_a, b.skill as skill_b, count(*) as n from e a join e b on a.vacancy_id = b.vacancy_id and a.skill < b.skill group by all order by n desc, skill_a, skill_b limit 50""",
    "weekly_hires": f"with {EVENTS_SQL} select employer_id, count(*) as n from ev where type = 'appeared' and employer_id is not null and ts >= '2026-03-25 00:00:00+00' group by 1 order by n desc, employer_id limit 50",
    "vacancy_salary_trail": f"""with {EVENTS_SQL}, c as (select * from ev where type = 'salary_changed'),
m as (select vacancy_id from c group by 1 order by count(*) desc, vacancy_id limit 1)
select vacancy_id, event_id, cast(json_extract_string(payload, '$.old.from') as bigint) as old_from, cast(json_extract_string(payload, '$.old.to') as bigint) as old_to,
  cast(json_extract_string(payload, '$.new.from') as bigint) as new_from, cast(json_extract_string(payload, '$.new.to') as bigint) as new_to from c where vacancy_id in (select vacancy_id from m)""",
    "growing_skills": f"with {SLIM_SQL}, {_SKILLS} select skill, mentions_this_week, delta_pct from velocity where week_start = (select max(week_start) from velocity) and mentions_this_week >= 10 and delta_pct > 0",
    "national_role_salary": f"""with {SLIM_SQL}, b as (select cast(date_trunc('week', first_seen_at at time zone 'UTC') as date) as week_start, {_ROLE} as role_canonical, seniority,
  coalesce(cast(trunc((smin + smax) / 2) as bigint), smin, smax) as pay from slim where smin is not null or smax is not null),
g as (select week_start, role_canonical, seniority, count(*) as n_vacancies, list_sort(list(pay)) as x from b group by all)
select week_start, role_canonical, seniority, n_vacancies, x[1 + cast(round((n_vacancies - 1) * 0.25) as bigint)] as salary_rub_p25, x[1 + cast(round((n_vacancies - 1) * 0.5) as bigint)] as salary_rub_median,
  x[1 + cast(round((n_vacancies - 1) * 0.75) as bigint)] as salary_rub_p75 from g where n_vacancies >= 3""",
    "national_heat_map": "select role_canonical, seniority, max(salary_rub_median) as top_median, count(*) as weeks from (select distinct * from weekly_role_salary) where city is null group by all",
}
