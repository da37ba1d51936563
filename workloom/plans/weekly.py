"""Weekly and daily aggregates of the active postings and the event log, and the trends over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from workloom.functions import rules
from workloom.operators.cumulative import nearest_rank
from workloom.plans.views import EVENTS_SQL, NOW, SLIM_SQL, events, slim
from workloom.runtime import table, utc_date

TODAY = NOW[:10]


def week(ts) -> F.Column:
    return F.date_trunc("week", utc_date(ts)).cast("date")


def _usable():
    return F.col("disclosed") & (F.col("smin").isNotNull() | F.col("smax").isNotNull())


def skill_mentions(postings: DataFrame, least: int = 5) -> DataFrame:
    """Mentions of each skill per week (Monday) with the week before that had any, the change in
    percent (null from 0) and the rank in the week (ties by name)."""
    said = postings.where(F.size("skills") > 0).select(week("first_seen_at").alias("week_start"), F.explode("skills").alias("skill")).where("week_start is not null and skill is not null")
    per = said.groupBy("week_start", "skill").agg(F.count("*").alias("mentions_this_week")).where(F.col("mentions_this_week") >= least)
    prev = F.lag("mentions_this_week", 1, 0).over(Window.partitionBy("skill").orderBy("week_start"))
    per = per.withColumn("mentions_prev_week", prev)
    change = (F.col("mentions_this_week") - F.col("mentions_prev_week")) / F.col("mentions_prev_week") * 100
    rank = F.row_number().over(Window.partitionBy("week_start").orderBy(F.desc("mentions_this_week"), "skill"))
    return per.select("*", F.when(F.col("mentions_prev_week") != 0, F.round(change, 4)).alias("delta_pct"), rank.alias("rank_this_week"))


def role_salaries(postings: DataFrame, least: int = 3) -> DataFrame:
    """Quartiles of the middle of the pay by week, role and level, for the country (city null) and for
    each city. The two levels are grouping sets of one pass; a row without a city counts only for
    the country, which grouping_id keeps apart."""
    pay = F.coalesce(((F.col("smin") + F.col("smax")) / 2).cast("bigint"), "smin", "smax")
    base = postings.select(week("first_seen_at").alias("week_start"), rules.role(F.col("title")).alias("role_canonical"), "seniority", F.nullif("city", F.lit("")).alias("city"), pay.alias("pay"))
    base = base.where("pay is not null and week_start is not null")
    key = ["week_start", "role_canonical", "seniority", "city", "in_city"]
    both = base.select("*", F.explode(F.when(F.col("city").isNotNull(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("in_city"))
    both = both.withColumn("city", F.when(F.col("in_city"), F.col("city")))
    got = nearest_rank(both, key, "pay", {"salary_rub_p25": 0.25, "salary_rub_median": 0.5, "salary_rub_p75": 0.75})
    return got.where(F.col("n") >= least).select(*key[:4], F.col("n").alias("n_vacancies"), "salary_rub_p25", "salary_rub_median", "salary_rub_p75")


def role_counts(postings: DataFrame) -> DataFrame:
    """Postings and mean pay by role and level with subtotals, as GROUPING SETS."""
    base = postings.select(rules.role(F.col("title")).alias("role"), "seniority", "smin")
    sets = base.groupingSets([["role", "seniority"], ["role"], []], "role", "seniority")
    return sets.agg(F.grouping_id().cast("bigint").alias("gid"), F.count("*").alias("n"), F.round(F.avg("smin"), 4).alias("mean_pay"))


def employer_top(log: DataFrame, postings: DataFrame, since: str, top: int = 50) -> DataFrame:
    """The employers with the most new postings of each week, with name and share of usable pay."""
    count = lambda t: F.count_if(F.col("type") == t)
    per = log.where(f"ts >= timestamp'{since} 00:00:00Z' and employer_id is not null").groupBy(week("ts").alias("week_start"), "employer_id").agg(count("appeared").alias("new_vacancies"), count("closed").alias("closed_vacancies"))
    per = per.where("new_vacancies > 0 or closed_vacancies > 0")
    rank = F.row_number().over(Window.partitionBy("week_start").orderBy(F.desc("new_vacancies"), "employer_id"))
    per = per.withColumn("rk", rank).where(F.col("rk") <= top).drop("rk")
    stats = postings.groupBy("employer_id").agg(F.min("employer_name").alias("employer_name"), F.avg(_usable().cast("int")).alias("rate"))
    return per.join(stats, "employer_id", "left").select("week_start", "employer_id", "employer_name", "new_vacancies", "closed_vacancies", F.round(F.coalesce("rate", F.lit(0.0)), 6).alias("disclosure_rate"))


def market_pulse(log: DataFrame, postings: DataFrame, today: str, days: int = 90) -> DataFrame:
    """New (by publication) and closed postings per day; today's row also has the state of the market."""
    day = F.lit(today).cast("date")
    posted = postings.select(utc_date("posted_at").alias("date"), F.lit(1).alias("a"), F.lit(0).alias("c"))
    closed = log.where("type = 'closed'").select(utc_date("ts").alias("date"), F.lit(0).alias("a"), F.lit(1).alias("c"))
    now = postings.sparkSession.range(1).select(day.alias("date"), F.lit(0).alias("a"), F.lit(0).alias("c"))
    every = posted.unionByName(closed).where(F.col("date").between(F.date_sub(day, days), day)).unionByName(now)
    per = every.groupBy("date").agg(F.sum("a").alias("new_vacancies"), F.sum("c").alias("closed_vacancies"))
    state = postings.agg(F.count("*").alias("n"), F.avg(_usable().cast("int")).alias("rate"), F.median(F.datediff(day, utc_date("first_seen_at"))).alias("age"))
    at = lambda c: F.when(F.col("date") == day, c)
    return per.join(F.broadcast(state), F.lit(True)).select(
        "date", at(F.col("n")).alias("total_active"), "new_vacancies", "closed_vacancies", at(F.round("rate", 6)).alias("salary_disclosure_rate"), at(F.round("age", 4)).alias("median_active_age_days")
    )


def weighted(salary: DataFrame, *by: str) -> DataFrame:
    """Means of the quartiles weighted by the number of postings."""
    w = lambda c: F.round(F.sum(F.col(c) * F.col("n_vacancies")) / F.sum("n_vacancies"), 4)
    return salary.where("salary_rub_median is not null and n_vacancies > 0").groupBy(*by).agg(
        w("salary_rub_median").alias("med"), w("salary_rub_p25").alias("p25"), w("salary_rub_p75").alias("p75"), F.sum("n_vacancies").alias("n")
    )


def salary_by_level(salary: DataFrame) -> DataFrame:
    """Weekly weighted medians per level with at least 15 postings a week, levels with at least 3 weeks."""
    per = weighted(salary.where(F.col("seniority").isin("junior", "middle", "senior", "lead")), "week_start", "seniority").where("n >= 15")
    weeks = F.count("*").over(Window.partitionBy("seniority"))
    return per.withColumn("weeks", weeks).where("weeks >= 3").select("week_start", "seniority", "med", "n")


def movers(skills: DataFrame, least: int = 25, k: int = 8) -> DataFrame:
    """The k skills of the latest week that rose most and the k that fell most."""
    last = skills.join(F.broadcast(skills.agg(F.max("week_start").alias("week_start"))), "week_start", "left_semi")
    known = last.where(f"delta_pct is not null and mentions_this_week >= {least}").select("skill", "mentions_this_week", "mentions_prev_week", F.round("delta_pct", 1).alias("delta_pct"))
    up = known.orderBy(F.desc("delta_pct"), "skill").limit(k).withColumn("direction", F.lit("up"))
    return up.unionByName(known.orderBy("delta_pct", "skill").limit(k).withColumn("direction", F.lit("down")))


def intake(log: DataFrame, today: str, days: int = 18) -> DataFrame:
    """New postings per full day and source with the mean of the last 7 days that have any."""
    day = F.lit(today).cast("date")
    new = log.where("type = 'appeared'").withColumn("d", utc_date("ts")).where((F.col("d") >= F.date_sub(day, days)) & (F.col("d") < day))
    wide = new.groupBy("d").pivot("source", ["hh", "tg"]).agg(F.count(F.lit(1))).fillna(0, ["hh", "tg"])
    mean = F.bround(F.avg(F.col("hh") + F.col("tg")).over(Window.orderBy("d").rowsBetween(-6, 0)), 0)  # one row a day
    return wide.select("d", "hh", "tg", mean.cast("bigint").alias("ma7"))


def all_weekly(log: DataFrame, postings: DataFrame, today: str, since: str) -> dict[str, DataFrame]:
    """The weekly aggregates by name, for lake.write_aggregates: all from one snapshot, which the caller keeps."""
    return {
        "weekly_skill_velocity": skill_mentions(postings), "weekly_role_salary": role_salaries(postings),
        "weekly_employer_top": employer_top(log, postings, since), "daily_market_pulse": market_pulse(log, postings, today),
    }


def weekly_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Rows and weeks (days) of each weekly aggregate, all made from the one kept snapshot."""
    tables = all_weekly(events(spark, d), slim(spark, d), TODAY, "2026-03-01")
    at = {k: "date" if k.startswith("daily") else "week_start" for k in tables}
    one = [df.agg(F.count("*").alias("rows"), F.countDistinct(at[k]).alias("periods")).select(F.lit(k).alias("name"), "rows", "periods") for k, df in tables.items()]
    return one[0].unionByName(one[1]).unionByName(one[2]).unionByName(one[3])


def _lake_salary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "weekly_role_salary").distinct()


QUERIES = {
    "skill_velocity": lambda s, d: skill_mentions(slim(s, d)),
    "weekly_sizes": weekly_sizes,
    "role_salary_grouping_sets": lambda s, d: role_salaries(slim(s, d)),
    "role_counts_rollup": lambda s, d: role_counts(slim(s, d)),
    "employer_top": lambda s, d: employer_top(events(s, d), slim(s, d), "2026-03-01"),
    "market_pulse": lambda s, d: market_pulse(events(s, d), slim(s, d), TODAY),
    "salary_trend_weighted": lambda s, d: weighted(_lake_salary(s, d), "week_start"),
    "salary_by_level": lambda s, d: salary_by_level(_lake_salary(s, d)),
    "skill_movers": lambda s, d: movers(skill_mentions(slim(s, d)), least=10),
    "intake_pulse": lambda s, d: intake(events(s, d), "2026-04-05"),
}

_SKILLS = """
per as (select cast(date_trunc('week', first_seen_at at time zone 'UTC') as date) as week_start, skill, count(*) as m
  from (select first_seen_at, unnest(skills) as skill from slim where len(skills) > 0) group by all having count(*) >= 5),
lagged as (select *, lag(m, 1, 0) over (partition by skill order by week_start) as p from per),
velocity as (select week_start, skill, m as mentions_this_week, p as mentions_prev_week,
  case when p <> 0 then round((m - p)::double / p * 100, 4) end as delta_pct,
  cast(row_number() over (partition by week_start order by m desc, skill) as int) as rank_this_week from lagged)
"""
_USABLE = "(disclosed and (smin is not null or smax is not null))"
_ROLE = rules.duckdb_case("title", rules.ROLES, "other")
_W = "round(sum({0} * n_vacancies) / sum(n_vacancies), 4)"
_WEIGHTED = f"""{_W.format('salary_rub_median')} as med, {_W.format('salary_rub_p25')} as p25, {_W.format('salary_rub_p75')} as p75, cast(sum(n_vacancies) as bigint) as n
from (select distinct * from weekly_role_salary) where salary_rub_median is not null and n_vacancies > 0"""

SQL = {
    "skill_velocity": f"with {SLIM_SQL}, {_SKILLS} select * from velocity",
    "role_salary_grouping_sets": f"""
with {SLIM_SQL},
base as (select cast(date_trunc('week', first_seen_at at time zone 'UTC') as date) as week_start, {_ROLE} as role_canonical, seniority, nullif(city, '') as city,
  coalesce(cast(trunc((smin + smax) / 2) as bigint), smin, smax) as pay from slim where smin is not null or smax is not null),
g as (select week_start, role_canonical, seniority, city, grouping(city) as gid, count(*) as n_vacancies, list_sort(list(pay)) as x
  from base group by grouping sets ((week_start, role_canonical, seniority), (week_start, role_canonical, seniority, city)))
select week_start, role_canonical, seniority, city, n_vacancies,
  x[1 + cast(round((n_vacancies - 1) * 0.25) as bigint)] as salary_rub_p25, x[1 + cast(round((n_vacancies - 1) * 0.5) as bigint)] as salary_rub_median,
  x[1 + cast(round((n_vacancies - 1) * 0.75) as bigint)] as salary_rub_p75
from g where n_vacancies >= 3 and (gid = 1 or city is not null)""",
    "role_counts_rollup": f"""
with {SLIM_SQL}, b as (select {_ROLE} as role, seniority, smin from slim)
select role, seniority, cast(grouping_id(role, seniority) as bigint) as gid, count(*) as n, round(avg(smin), 4) as mean_pay from b group by grouping sets ((role, seniority), (role), ())""",
    "employer_top": f"""
with {SLIM_SQL}, {EVENTS_SQL},
per as (select cast(date_trunc('week', ts at time zone 'UTC') as date) as week_start, employer_id, cast(sum(case when type = 'appeared' then 1 else 0 end) as bigint) as new_vacancies,
  cast(sum(case when type = 'closed' then 1 else 0 end) as bigint) as closed_vacancies from ev where ts >= '2026-03-01 00:00:00+00' and employer_id is not null group by all
  having sum(case when type = 'appeared' then 1 else 0 end) > 0 or sum(case when type = 'closed' then 1 else 0 end) > 0),
st as (select employer_id, min(employer_name) as employer_name, avg({_USABLE}::int) as rate from slim group by 1)
select week_start, employer_id, employer_name, new_vacancies, closed_vacancies, round(coalesce(rate, 0.0), 6) as disclosure_rate
from (select *, row_number() over (partition by week_start order by new_vacancies desc, employer_id) as rk from per) left join st using (employer_id) where rk <= 50""",
    "market_pulse": f"""
with {SLIM_SQL}, {EVENTS_SQL},
u as (select cast(posted_at at time zone 'UTC' as date) as date, 1 as a, 0 as c from slim union all
      select cast(ts at time zone 'UTC' as date), 0, 1 from ev where type = 'closed'),
v as (select * from u where date between date '{TODAY}' - 90 and date '{TODAY}' union all select date '{TODAY}', 0, 0),
st as (select count(*) as n, avg({_USABLE}::int) as rate, median(date_diff('day', cast(first_seen_at at time zone 'UTC' as date), date '{TODAY}')) as age from slim)
select date, case when date = date '{TODAY}' then any_value(n) end as total_active, cast(sum(a) as bigint) as new_vacancies, cast(sum(c) as bigint) as closed_vacancies,
  case when date = date '{TODAY}' then round(any_value(rate), 6) end as salary_disclosure_rate, case when date = date '{TODAY}' then round(any_value(age), 4) end as median_active_age_days
from v, st group by date""",
    "salary_trend_weighted": f"select week_start, {_WEIGHTED} group by week_start",
    "salary_by_level": f"""
select week_start, seniority, med, n from (select *, count(*) over (partition by seniority) as w from (
  select week_start, seniority, {_WEIGHTED} and seniority in ('junior', 'middle', 'senior', 'lead') group by week_start, seniority) where n >= 15) where w >= 3""",
    "skill_movers": f"""
with {SLIM_SQL}, {_SKILLS},
k as (select skill, mentions_this_week, mentions_prev_week, round(delta_pct, 1) as delta_pct from velocity
  where week_start = (select max(week_start) from velocity) and delta_pct is not null and mentions_this_week >= 10)
select *, 'up' as direction from (from k order by delta_pct desc, skill limit 8) union all select *, 'down' as direction from (from k order by delta_pct, skill limit 8)""",
    "intake_pulse": f"""
with {EVENTS_SQL},
w as (select cast(ts at time zone 'UTC' as date) as d, count(*) filter (where source = 'hh') as hh, count(*) filter (where source = 'tg') as tg
  from ev where type = 'appeared' group by 1 having d >= date '2026-04-05' - 18 and d < date '2026-04-05')
select d, hh, tg, cast(round_even(avg(hh + tg) over (order by d rows between 6 preceding and current row), 0) as bigint) as ma7 from w""",
}
_ALL = (("weekly_skill_velocity", "skill_velocity", "week_start"), ("weekly_role_salary", "role_salary_grouping_sets", "week_start"), ("weekly_employer_top", "employer_top", "week_start"), ("daily_market_pulse", "market_pulse", "date"))
SQL["weekly_sizes"] = " union all ".join(f"select '{name}' as name, count(*) as rows, count(distinct {at}) as periods from ({SQL[q]})" for name, q, at in _ALL)
