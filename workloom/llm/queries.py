"""Queries of the training-data problems (p2, p4 to p10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workloom.llm import components, leakage, lookalikes, mapping, mixing, neardup, quantiles, readlevel
from workloom.runtime import table


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    """(field, record_id, value, ref_id) of every typed city and role, with rows as often as recorded."""
    out = []
    for field, of, record, value, ref, key, name in (
        ("city", "vacancies", "vacancy_id", "city", "city_reference", "city_id", "city"),
        ("role_canonical", "weekly_role_salary", "row_id", "role_canonical", "role_reference", "role_id", "role_canonical"),
    ):
        reference = table(spark, d, ref)
        typed = mapping.typed_values(table(spark, d, of), record, value, reference, name)
        mapped = mapping.map_values(typed, "value", reference, key, name, "aliases")
        out.append(mapped.select(F.lit(field).alias("field"), "record_id", "value", "ref_id").where("record_id is not null"))
    return out[0].unionByName(out[1])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The reference entry that each typed city and role means."""
    return _mapped(spark, d).select("field", "record_id", "ref_id").distinct()


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The report of cities and roles that mean no entry, with their number of records."""
    return _mapped(spark, d).where("ref_id = -1").distinct().groupBy("field", "value").agg(F.count("*").alias("records"))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    titles = table(spark, d, "vacancies").select(F.lit("title").alias("field"), F.col("vacancy_id").alias("id"), F.col("title").alias("text"))
    said = table(spark, d, "tg_messages").select(
        F.lit("message_text").alias("field"), F.concat(F.lit("tg:"), "channel", F.lit(":"), F.col("message_id").cast("string")).alias("id"), "text"
    )
    return titles.unionByName(said)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of records whose texts differ in their characters and look the same."""
    return lookalikes.lookalike_pairs(_texts(spark, d))


def p4_forms(spark: SparkSession, d: str) -> DataFrame:
    """The consistent form of every title and message."""
    return lookalikes.forms(_texts(spark, d)).select("field", "id", "form").distinct()


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """For each record the first record that looks the same, and how many different texts do."""
    return lookalikes.lookalike_classes(_texts(spark, d))


GROUP = ["role_canonical", "seniority", "city"]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups of at least 15 rows whose 90th percentile is at least twice the median."""
    rows = table(spark, d, "weekly_role_salary").where(" and ".join(f"{c} is not null" for c in GROUP))
    counts = quantiles.row_frequencies(rows, GROUP, "salary_rub_median", "row_id")
    got = quantiles.percentiles(counts, GROUP, {"p50": 0.5, "p90": 0.9})
    return got.where("n >= 15 and p90 >= 2 * p50").select(*GROUP)


def p5_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact percentiles of every group (also those with null keys), combined from single collectors."""
    counts = quantiles.row_frequencies(table(spark, d, "weekly_role_salary"), GROUP, "salary_rub_median", "row_id", by=["collector"])
    return quantiles.percentiles(counts, GROUP, {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9})


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """One group identifier for every vacancy in the pairs."""
    out = components.connected(table(spark, d, "duplicate_pairs"), "id_a", "id_b")
    return out.select(F.col("id").alias("vacancy_id"), "group_id")


def _adverts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "vacancies").where("text is not null")
    return rows.select("vacancy_id", F.concat_ws(" ", "title", "employer_name", "text").alias("advert"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of adverts whose runs of four words are alike to at least 0.7."""
    return neardup.expand(*neardup.similar_pairs(_adverts(spark, d), "vacancy_id", "advert", size=4, t=0.7))


def p6_classes(spark: SparkSession, d: str) -> DataFrame:
    """The group of re-posted adverts that each advert belongs to, and its number of links."""
    return neardup.classes(_adverts(spark, d), "vacancy_id", "advert", size=4, t=0.7)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that contain twelve or more consecutive words of an evaluation item."""
    hits = leakage.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")
    return hits.where("run >= 12").select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p8_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """All overlaps with evaluation items, also with replaced words."""
    hits = leakage.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")
    return hits.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "run", "span", "same")


def _mix(spark: SparkSession, d: str):
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mix with their repeat counts and first training positions."""
    records = _mix(spark, d)[0]
    return records.select(F.col("id").alias("doc_id"), "source", "tokens", "repeats", F.round("first_position", 9).alias("first_position"))


def p9_order(spark: SparkSession, d: str) -> DataFrame:
    """Every copy of a document at its training position, in order."""
    copies = _mix(spark, d)[1]
    return copies.select(F.col("id").alias("doc_id"), "source", "tokens", "copy", F.round("position", 9).alias("position"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share that each source really reached, with caps and shortfalls."""
    return _mix(spark, d)[2]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents at the hardest level."""
    return readlevel.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels")).where("level = 4").select(F.col("id").alias("doc_id")).distinct()


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    """The reading level of every document."""
    out = readlevel.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels"))
    return out.select(F.col("id").alias("doc_id"), "level", F.round("confidence", 6).alias("confidence"), F.round("score", 6).alias("score"))


QUERIES = {
    "p2_found": p2_found, "p2_unmatched": p2_unmatched, "p4_found": p4_found, "p4_forms": p4_forms, "p4_classes": p4_classes,
    "p5_found": p5_found, "p5_percentiles": p5_percentiles, "p6_found": p6_found, "p6_classes": p6_classes, "p7_found": p7_found,
    "p8_found": p8_found, "p8_overlaps": p8_overlaps, "p9_mix": p9_mix, "p9_order": p9_order, "p9_shares": p9_shares,
    "p10_found": p10_found, "p10_levels": p10_levels,
}

_FORMS = f"""t as (select distinct 'title' as field, vacancy_id as id, title as text from vacancies
  union select 'message_text', 'tg:' || channel || ':' || message_id, text from tg_messages),
f as (select field, id, text, {lookalikes.form_sql('text')} as form from t)"""

_ALIKE = """w as (
  select distinct vacancy_id as id, regexp_extract_all(lower(concat_ws(' ', title, employer_name, text)), '[\\p{L}\\p{N}_]+') as w
  from vacancies where text is not null),
s as (select distinct id, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] as g
      from (select id, w, unnest(range(1, len(w) - 2)) as i from w)),
n as (select id, count(*) as n, list_sort(list(g)) as content from s group by id),
c as (select a.id as id_a, b.id as id_b, count(*) as c from s a join s b on a.g = b.g and a.id < b.id group by all),
pairs as (select id_a, id_b from c join n x on x.id = id_a join n y on y.id = id_b where 10 * c >= 7 * (x.n + y.n - c))"""

SQL = {
    "p6_classes": f"""with recursive {_ALIKE},
e as (select id_a as a, id_b as b from pairs union all select id_b, id_a from pairs),
r as (select id as v, id as g from n union select r.v, e.b from r join e on r.g = e.a),
l as (select e.a as id, count(distinct y.content) as links from e join n x on x.id = e.a join n y on y.id = e.b where x.content <> y.content group by 1)
select v as id, min(g) as class_id, coalesce(any_value(links), 0) as links from r left join l on l.id = r.v group by v""",
    "p4_found": f"""with {_FORMS} select distinct a.field, a.id as id_a, b.id as id_b from f a join f b on a.field = b.field and a.form = b.form and a.text <> b.text and a.id < b.id""",
    "p4_forms": f"with {_FORMS} select distinct field, id, form from f",
    "p4_classes": f"""with {_FORMS} select distinct field, id, class_id, texts from f
join (select field, form, min(id) as class_id, count(distinct text) as texts from f where text is not null and id is not null group by all) using (field, form)""",
    "p6_found": """
with w as (
  select distinct vacancy_id as id, regexp_extract_all(lower(concat_ws(' ', title, employer_name, text)), '[\\p{L}\\p{N}_]+') as w
  from vacancies where text is not null),
s as (select distinct id, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] as g
      from (select id, w, unnest(range(1, len(w) - 2)) as i from w)),
n as (select id, count(*) as n from s group by id),
c as (select a.id as id_a, b.id as id_b, count(*) as c from s a join s b on a.g = b.g and a.id < b.id group by all)
select id_a, id_b from c join n x on x.id = id_a join n y on y.id = id_b where 10 * c >= 7 * (x.n + y.n - c)
""",
    "p8_found": """
with d as (select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') as w from documents where text is not null),
i as (select item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') as w from eval_items),
dg as (select distinct doc_id, array_to_string(w[k:k+11], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 10)) as k from d)),
ig as (select distinct item_id, array_to_string(w[k:k+11], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 10)) as k from i))
select distinct doc_id, item_id from dg join ig using (g)
""",
    "p5_found": """
select role_canonical, seniority, city from (
  select distinct row_id, role_canonical, seniority, city, salary_rub_median as x from weekly_role_salary
  where salary_rub_median is not null and role_canonical is not null and seniority is not null and city is not null)
group by all having count(*) >= 15 and quantile_disc(x, 0.9) >= 2 * quantile_disc(x, 0.5)
""",
    "p5_percentiles": """
select role_canonical, seniority, city, count(*) as n,
  quantile_disc(x, 0.1) as p10, quantile_disc(x, 0.25) as p25, quantile_disc(x, 0.5) as p50,
  quantile_disc(x, 0.75) as p75, quantile_disc(x, 0.9) as p90
from (select distinct row_id, role_canonical, seniority, city, salary_rub_median as x from weekly_role_salary
  where salary_rub_median is not null)
group by role_canonical, seniority, city
""",
    "p7_found": """
with recursive e as (
  select id_a as a, id_b as b from duplicate_pairs where id_a is not null and id_b is not null and id_a <> id_b
  union select id_b, id_a from duplicate_pairs where id_a is not null and id_b is not null and id_a <> id_b),
r as (select a as v, a as g from e union select r.v, e.b from r join e on r.g = e.a)
select v as vacancy_id, min(g) as group_id from r group by v
""",
}
