"""Search over the active postings, facets and capacity figures; text rules; duplicates; vectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workloom.functions import extract, rules
from workloom.operators import dedup, slim as slim_op, vectors
from workloom.operators.cumulative import nearest_rank, running_totals
from workloom.plans import slim_sql as stated
from workloom.plans.views import SLIM_SQL, adverts, kept_snapshot, slim, snapshot
from workloom.runtime import table


def search(postings: DataFrame, query: str, *, sources=None, city=None, seniority=None, remote=None, floor=None, page: int | None = None) -> DataFrame:
    """Postings that hold every word of the query in title or text and meet the facets, best first: 3
    for each word in the title, then the latest seen, then by id. page: only that page, from 0; the first
    has PAGES[0] postings, each further one PAGES[1]."""
    words = query.lower().split()
    title, text = F.lower(F.coalesce("title", F.lit(""))), F.lower(F.concat_ws(" ", "title", "text"))
    ok: list[Column] = [F.contains(text, F.lit(w)) for w in words]
    for c, v in (("city", city), ("seniority", seniority), ("remote_type", remote)):
        if v is not None:
            ok.append(F.col(c) == v)
    if sources:
        ok.append(F.col("source").isin(*sources))
    if floor is not None:
        ok.append((F.col("smin") >= floor) | (F.col("smax") >= floor))
    score = sum((F.when(F.contains(title, F.lit(w)), 3).otherwise(0) for w in words), F.lit(0))
    hits = postings.where(reduce(Column.__and__, ok, F.lit(True))).withColumn("score", score)
    found = hits.orderBy(F.desc("score"), F.desc("last_seen_at"), "vacancy_id").select("vacancy_id", "title", "city", "seniority", "smin", "smax", "score")
    if page is None:
        return found
    return found.offset(PAGES[0] + (page - 1) * PAGES[1] if page else 0).limit(PAGES[1] if page else PAGES[0])


#: Postings of the first page of a search and of each further one.
PAGES = (100, 400)


def kpis(postings: DataFrame) -> DataFrame:
    """Number, share with pay (0 is none), upper median of it, distinct cities and employers."""
    pay = F.coalesce(F.nullif("smin", F.lit(0)), F.nullif("smax", F.lit(0)))
    rows = postings.withColumn("pay", pay)
    upper = running_totals(rows.where("pay is not null").groupBy(F.lit(1).alias("one"), "pay").agg(F.count("*").alias("k")), ["one"], ["pay"], "k", upto="to", whole="all")
    upper = upper.where((F.col("to") > F.floor(F.col("all") / 2)) & (F.col("to") - F.col("k") <= F.floor(F.col("all") / 2))).select(F.col("pay").alias("median"))
    one = rows.agg(F.count("*").alias("n"), F.round(F.count("pay") / F.count("*") * 100, 4).alias("paid_pct"), F.countDistinct("city").alias("cities"), F.countDistinct("employer_name").alias("employers"))
    return one.join(F.broadcast(upper), F.lit(True), "left")


def facets(postings: DataFrame, top: int = 200) -> DataFrame:
    """How many postings have each value of each facet; of the cities the `top` most frequent."""
    long = postings.select(F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in ("source", "city", "seniority", "remote_type")])).alias("x")).select("x.*")
    per = long.where("value is not null and value <> ''").groupBy("facet", "value").agg(F.count("*").alias("n"))
    cities = per.where("facet = 'city'").orderBy(F.desc("n"), "value").limit(top)
    return per.where("facet <> 'city'").unionByName(cities)


def token_statistics(postings: DataFrame) -> DataFrame:
    """Size of an inverted index over title and text: distinct words of at least 2 letters per posting."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.concat_ws(" ", "title", "text")), r"(?U)[^\w]+"), lambda w: F.length(w) >= 2))
    per = postings.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("unique_tokens"), F.sum("n").alias("postings"), F.round(F.avg("n"), 4).alias("avg_postings"))


def row_bytes(postings: DataFrame) -> DataFrame:
    """Bytes of the texts of a posting: total, mean and the 95th percentile (position floor(0.95 n))."""
    size = F.octet_length(F.concat_ws("", "vacancy_id", "title", "employer_name", "city", "text")).cast("bigint")
    sized = postings.select(F.lit(1).alias("one"), size.alias("b"))
    r = running_totals(sized.groupBy("one", "b").agg(F.count("*").alias("k")), ["one"], ["b"], "k", upto="to", whole="all")
    at = F.least(F.floor(F.col("all") * 0.95), F.col("all") - 1)
    p = r.where((F.col("to") > at) & (F.col("to") - F.col("k") <= at)).select(F.col("b").alias("p95_bytes"))
    return sized.agg(F.count("*").alias("rows"), F.sum("b").alias("total_bytes"), F.round(F.avg("b"), 4).alias("avg_bytes")).join(F.broadcast(p), F.lit(True), "left")


def capacity(postings: DataFrame, rows: DataFrame) -> DataFrame:
    """What a search backend would have to hold, as (measure, value): rows and bytes of the compact rows (total, mean,
    95th percentile), words and postings of the inverted index, postings of facets and skills."""
    size = F.octet_length("row").cast("bigint")
    sized = rows.select(F.lit(1).alias("one"), size.alias("b"))
    r = running_totals(sized.groupBy("one", "b").agg(F.count("*").alias("k")), ["one"], ["b"], "k", upto="to", whole="all")
    at = F.least(F.floor(F.col("all") * 0.95), F.col("all") - 1)
    long = lambda df: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in df.columns])).alias("x")).select("x.*")
    parts = [
        sized.agg(F.count("*").alias("rows"), F.sum("b").alias("row_bytes"), F.round(F.avg("b"), 4).alias("row_bytes_mean")),
        r.where((F.col("to") > at) & (F.col("to") - F.col("k") <= at)).select(F.col("b").alias("row_bytes_p95")), token_statistics(postings),
        facets(postings).agg(F.count("*").alias("facet_values"), F.sum("n").alias("facet_postings")), postings.agg(F.sum(F.size("skills")).alias("skill_postings")),
    ]
    return reduce(DataFrame.unionByName, [long(p) for p in parts])


def quota_verdict(used: dict[str, float], quota: dict[str, float], most: float = 0.7) -> tuple[dict[str, float], bool]:
    """(per cent of each quota that is used, whether all stay within the share `most`)."""
    share = {k: used.get(k, 0.0) / q for k, q in quota.items()}
    return {k: round(100 * v, 1) for k, v in share.items()}, all(v <= most for v in share.values())


def _messages(s, d):
    return table(s, d, "tg_messages").distinct()


def _advert():
    return F.concat_ws(" ", "title", "employer_name", "city", "text")


def _pairs(s, d):
    reps, _ = dedup.contents(adverts(s, d), "vacancy_id", _advert())
    return dedup.alike(reps)


def _lsh(s, d):
    reps, _ = dedup.contents(adverts(s, d), "vacancy_id", _advert())
    return dedup.verified(dedup.minhash_candidates(reps), reps, dedup.SAME)


def _members(s, d):
    _, members = dedup.contents(adverts(s, d), "vacancy_id", _advert())
    return members


def _encoding(s, d):
    text = F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 16)
    new = adverts(s, d).select("vacancy_id", text.alias("h"))
    old = adverts(s, d).where("source = 'hh'").select("vacancy_id", F.when(F.col("city").isNull(), "stale").otherwise(text).alias("h"))
    return vectors.encoding_plan(new, old, "vacancy_id", "h")


#: Postings of the snapshot were seen from then on.
ACTIVE_SINCE = "2026-05-12 00:00:00"


def _every_20th(s, d, stored=None):
    e = table(s, d, "embeddings")
    got = vectors.neighbours(e.where("vec_id % 20 = 0"), e if stored is None else e.join(stored, "vec_id", "left_semi"), "vec_id", "embedding", 10)
    return got.withColumn("cosine", F.round("cosine", 6))


QUERIES = {
    "faceted_search": lambda s, d: search(slim(s, d), "sql разраб", floor=100_000),
    "faceted_search_page": lambda s, d: search(slim(s, d), "о", remote="unknown", page=1),
    "search_kpis": lambda s, d: kpis(slim(s, d)),
    "facet_counts": lambda s, d: facets(slim(s, d)),
    "token_index_stats": lambda s, d: token_statistics(adverts(s, d)),
    "search_capacity": lambda s, d: capacity(slim(s, d), slim_op.artifact_rows(kept_snapshot(s, d))),
    "p95_bytes": lambda s, d: row_bytes(adverts(s, d)),
    "role_classifier": lambda s, d: adverts(s, d).select("vacancy_id", rules.role(F.col("title")).alias("role")),
    "seniority_classifier": lambda s, d: adverts(s, d).select("vacancy_id", rules.stated_level(F.col("title"), F.col("text")).alias("level")),
    "remote_classifier": lambda s, d: _messages(s, d).select("channel", "message_id", rules.workplace(F.col("text")).alias("workplace")),
    "city_classifier": lambda s, d: table(s, d, "documents").select("doc_id", rules.city(F.col("text")).alias("city")),
    "experience_years": lambda s, d: adverts(s, d).select("vacancy_id", extract.years("text").alias("years")),
    "salary_parse": lambda s, d: table(s, d, "salary_parses").distinct().select("parse_id", extract.pay("salary_text").alias("p")).select("parse_id", "p.*"),
    "skill_extract": lambda s, d: adverts(s, d).select("vacancy_id", extract.skills(F.col("text")).alias("skills")),
    "title_clean": lambda s, d: adverts(s, d).select("vacancy_id", slim_op.clean_title(F.col("title")).alias("title")),
    "html_text": lambda s, d: adverts(s, d).select("vacancy_id", extract.html_text(F.concat(F.lit("<div data-x='1'><p>"), F.regexp_replace(F.coalesce("text", F.lit("")), "\n", "<br>"), F.lit("</p></div>"))).alias("text")),
    "slim_snapshot": lambda s, d: snapshot(s, d, since=ACTIVE_SINCE),
    "artifact_rows": lambda s, d: slim_op.artifact_rows(snapshot(s, d, since=ACTIVE_SINCE)),
    "chat_messages_to_slim": lambda s, d: snapshot(s, d, "telegram"),
    "near_duplicates_exact": _pairs,
    "near_duplicates_members": _members,
    "near_duplicates_cross_source": lambda s, d: dedup.cross_source_pairs(adverts(s, d), "vacancy_id", "source", _advert(), 0.7),
    "near_duplicates_lsh": _lsh,
    "cross_source_dedup": lambda s, d: dedup.across_sources(adverts(s, d), "vacancy_id", "source", _advert(), {"hh": 0, "telegram": 1}).select("vacancy_id", "source"),
    "cosine_topk": lambda s, d: _every_20th(s, d),
    "similar_active": lambda s, d: _every_20th(s, d, table(s, d, "documents").where("lang = 'ru'").select(F.col("doc_id").alias("vec_id"))),
    "reencode_plan": _encoding,
    "title_length_ranks": lambda s, d: nearest_rank(adverts(s, d).withColumn("len", F.length("title")), ["source"], "len", {"p25": 0.25, "p50": 0.5, "p75": 0.75}),
}

_WORD = r"[^\p{L}\p{N}_]+"
_SETS = """
adverts as (select distinct vacancy_id, source, title, employer_name, city, text from vacancies),
w as (select vacancy_id as id, source, regexp_extract_all(lower(concat_ws(' ', title, employer_name, city, text)), '[\\p{L}\\p{N}_]+') as w from adverts),
sh as (select id, source, list_sort(list_distinct(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3])
  when len(w) > 0 then [array_to_string(w, ' ')] else []::varchar[] end)) as g from w),
members as (select id, source, g, min(id) over (partition by g) as rep from sh where len(g) > 0),
reps as (select id as rep, g, len(g) as n from members where id = rep),
x as (select rep, n, unnest(g) as k from reps),
c as (select a.rep as a, b.rep as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as c from x a join x b on a.k = b.k and a.rep < b.rep group by all),
pairs as (select a, b, round(c / (na + nb - c), 4) as jaccard from c where c / (na + nb - c) >= 0.88 - 1e-12)
"""
_COS = "list_inner_product(a.embedding::double[], b.embedding::double[]) / sqrt(list_inner_product(a.embedding::double[], a.embedding::double[]) * list_inner_product(b.embedding::double[], b.embedding::double[]))"
_TOP = f"""select query, rank, neighbour, round(c, 6) as cosine from (select a.vec_id as query, b.vec_id as neighbour, round({_COS}, 12) as c,
  cast(row_number() over (partition by a.vec_id order by round({_COS}, 12) desc, b.vec_id) as int) as rank
  from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0 {{0}}) where rank <= 10"""

_ARTIFACT = f"""r0 as (select *, {stated.cleaned('title')} as t0, {stated.cleaned('description_teaser')} as d0 from snap),
r1 as (select *, case when t0 <> '' then t0 else rtrim(left(d0, 80)) || case when length(d0) > 80 then '…' else '' end end as t, case when t0 <> '' then d0 else '' end as d1 from r0 where t0 <> '' or d0 <> ''),
r2 as (select *, case when starts_with(lower(d1), lower(t)) then regexp_replace(regexp_replace(substr(d1, length(t) + 1), '^{slim_op._EDGE}', ''), '{slim_op._EDGE}$', '') else d1 end as d2 from r1),
r3 as (select *, case when length(d2) > 160 then rtrim(left(d2, 160)) || '…' else d2 end as ds from r2)"""
_FIELDS = (
    ("id", "vacancy_id"), ("t", "t"), ("e", "nullif(employer_name, '')"), ("c", "nullif(city, '')"), ("rg", "nullif(region, '')"), ("smin", "salary_rub_min"), ("smax", "salary_rub_max"),
    ("rt", "coalesce(remote_type, 'unknown')"), ("sr", "coalesce(seniority, 'unknown')"), ("src", "source"), ("u", "nullif(source_url, '')"), ("sk", "case when len(skills) > 0 then skills end"),
    ("ls", "strftime(last_seen_at at time zone 'UTC', '%Y-%m-%d')"), ("ps", "strftime(posted_at at time zone 'UTC', '%Y-%m-%d')"), ("ds", "nullif(ds, '')"),
)
_ROW = "'{' || array_to_string([" + ", ".join(f"""'"{k}":' || cast(to_json({e}) as varchar)""" for k, e in _FIELDS) + "], ',') || '}'"

SQL = {
    "slim_snapshot": f"with recursive {stated.snapshot_sql(since=ACTIVE_SINCE)} select {stated.SNAP_COLUMNS} from snap",
    "chat_messages_to_slim": f"with recursive {stated.snapshot_sql('telegram')} select {stated.SNAP_COLUMNS} from snap",
    "artifact_rows": f"with recursive {stated.snapshot_sql(since=ACTIVE_SINCE)}, {_ARTIFACT} select vacancy_id as id, {_ROW} as row from r3",
    "experience_years": f"with recursive x as (select distinct vacancy_id as id, text as t from vacancies), {stated.years_ctes('x')} select vacancy_id, years from (select distinct * from vacancies) left join years on id = vacancy_id",
    "salary_parse": f"""with recursive x as (select distinct parse_id as id, salary_text as t from salary_parses), {stated.pay_ctes('x')}
select parse_id, lo as min, hi as max, cur as currency, coalesce(pay.disclosed, false) as disclosed from (select distinct * from salary_parses) left join pay on id = parse_id""",
    "skill_extract": f"select vacancy_id, {stated.skills_of('text')} as skills from (select distinct * from vacancies)",
    "title_clean": f"select vacancy_id, {stated.cleaned('title')} as title from (select distinct * from vacancies)",
    "faceted_search": f"""with {SLIM_SQL} select vacancy_id, title, city, seniority, smin, smax,
  cast(3 * contains(lower(coalesce(title, '')), 'sql')::int + 3 * contains(lower(coalesce(title, '')), 'разраб')::int as int) as score
from slim where contains(lower(concat_ws(' ', title, text)), 'sql') and contains(lower(concat_ws(' ', title, text)), 'разраб') and (smin >= 100000 or smax >= 100000)""",
    "faceted_search_page": f"""with {SLIM_SQL}, h as (select *, cast(3 * contains(lower(coalesce(title, '')), 'о')::int as int) as score from slim where contains(lower(concat_ws(' ', title, text)), 'о') and remote_type = 'unknown')
select vacancy_id, title, city, seniority, smin, smax, score from h order by score desc, last_seen_at desc, vacancy_id limit 400 offset 100""",
    "search_kpis": f"""with {SLIM_SQL}, p as (select *, coalesce(nullif(smin, 0), nullif(smax, 0)) as pay from slim), s as (select list_sort(list(pay)) as x from p where pay is not null)
select count(*) as n, round(count(pay) / count(*) * 100, 4) as paid_pct, count(distinct city) as cities, count(distinct employer_name) as employers,
  (select x[1 + len(x) // 2] from s) as median from p""",
    "facet_counts": f"""with {SLIM_SQL}, l as (select 'source' as facet, source as value from slim union all select 'city', city from slim union all select 'seniority', seniority from slim union all select 'remote_type', remote_type from slim),
g as (select facet, value, count(*) as n from l where value <> '' group by all)
select * from g where facet <> 'city' union all select * from (from g where facet = 'city' order by n desc, value limit 200)""",
    "token_index_stats": f"""with t as (select unnest(list_distinct(list_filter(regexp_split_to_array(lower(concat_ws(' ', title, text)), '{_WORD}'), lambda w: len(w) >= 2))) as w
  from (select distinct vacancy_id, title, text, employer_name, city, source, first_seen_at from vacancies)), g as (select w, count(*) as n from t group by w)
select count(*) as unique_tokens, cast(sum(n) as bigint) as postings, round(avg(n), 4) as avg_postings from g""",
    "search_capacity": f"""with {SLIM_SQL}, {_ARTIFACT}, rows_ as (select strlen({_ROW}) as b from r3), bytes_ as (select list_sort(list(b)) as x from rows_),
words_ as (select w, count(*) as n from (select unnest(list_distinct(list_filter(regexp_split_to_array(lower(concat_ws(' ', title, text)), '{_WORD}'), lambda w: len(w) >= 2))) as w from slim) group by w),
facets_ as (select f, v, count(*) as n from (select 'source' as f, source as v from slim union all select 'city', city from slim union all select 'seniority', seniority from slim union all select 'remote_type', remote_type from slim) where v <> '' group by all),
shown_ as (from facets_ where f <> 'city' union all (from facets_ where f = 'city' order by n desc, v limit 200)),
m as (select 'rows' as measure, count(*)::double as value from rows_ union all select 'row_bytes', sum(b)::double from rows_ union all select 'row_bytes_mean', round(avg(b), 4) from rows_
  union all select 'row_bytes_p95', x[1 + least(cast(floor(len(x) * 0.95) as bigint), len(x) - 1)]::double from bytes_
  union all select 'unique_tokens', count(*)::double from words_ union all select 'postings', sum(n)::double from words_ union all select 'avg_postings', round(avg(n), 4) from words_
  union all select 'facet_values', count(*)::double from shown_ union all select 'facet_postings', sum(n)::double from shown_ union all select 'skill_postings', sum(len(skills))::double from slim)
select * from m""",
    "p95_bytes": """with b as (select strlen(concat_ws('', vacancy_id, title, employer_name, city, text)) as b from (select distinct * from vacancies)), l as (select list_sort(list(b)) as x from b)
select count(*) as rows, cast(sum(b) as bigint) as total_bytes, round(avg(b), 4) as avg_bytes, (select x[1 + least(cast(floor(len(x) * 0.95) as bigint), len(x) - 1)] from l) as p95_bytes from b""",
    "role_classifier": f"select vacancy_id, {rules.duckdb_case('title', rules.ROLES, 'other')} as role from (select distinct * from vacancies)",
    "seniority_classifier": f"""select vacancy_id, coalesce({rules.duckdb_case('title', rules.LEVELS_IN_TITLE)}, {rules.duckdb_case('title', rules.LEVELS)}, {rules.duckdb_case('text', rules.LEVELS)}) as level
from (select distinct * from vacancies)""",
    "remote_classifier": f"select channel, message_id, {rules.duckdb_case('text', rules.WORKPLACES, 'unknown')} as workplace from (select distinct * from tg_messages)",
    "city_classifier": f"select doc_id, {rules.duckdb_case('text', rules.CITIES)} as city from documents",
    "html_text": "select vacancy_id, trim(regexp_replace(coalesce(text, ''), '[\\s\\x{A0}]+', ' ', 'g')) as text from (select distinct * from vacancies)",
    "near_duplicates_exact": f"with {_SETS} select * from pairs",
    "near_duplicates_cross_source": f"""with {_SETS.replace('0.88', '0.7')}, near as (select a, b, jaccard from pairs union all select rep, rep, 1.0 from reps)
select distinct least(x.id, y.id) as id_a, greatest(x.id, y.id) as id_b, jaccard from near join members x on x.rep = a join members y on y.rep = b where x.source <> y.source and x.id <> y.id""",
    "near_duplicates_members": f"with {_SETS} select id, rep from members",
    "near_duplicates_lsh": f"with {_SETS} select * from pairs",
    "cross_source_dedup": f"""with {_SETS},
near as (select a, b from pairs union all select b, a from pairs union all select rep, rep from reps),
hh as (select distinct near.a as rep from near join members on members.rep = near.b where members.source = 'hh')
select vacancy_id, source from adverts where not (source = 'telegram' and vacancy_id in (select id from members where rep in (select rep from hh)))""",
    "cosine_topk": _TOP.format(""),
    "similar_active": _TOP.format("and b.vec_id in (select doc_id from documents where lang = 'ru')"),
    "reencode_plan": """with v as (select distinct * from vacancies), a as (select vacancy_id, substr(sha256(coalesce(text, '')), 1, 16) as h from v),
b as (select vacancy_id, case when city is null then 'stale' else substr(sha256(coalesce(text, '')), 1, 16) end as h from v where source = 'hh')
select coalesce(a.vacancy_id, b.vacancy_id) as id, case when b.vacancy_id is null then 'new' when a.vacancy_id is null then 'drop' when a.h = b.h then 'keep' else 'changed' end as plan from a full outer join b using (vacancy_id)""",
    "title_length_ranks": """with g as (select source, list_sort(list(len(title))) as x, count(title) as n from (select distinct * from vacancies) where title is not null group by 1)
select source, n, x[1 + cast(round((n - 1) * 0.25) as bigint)] as p25, x[1 + cast(round((n - 1) * 0.5) as bigint)] as p50, x[1 + cast(round((n - 1) * 0.75) as bigint)] as p75 from g""",
}
