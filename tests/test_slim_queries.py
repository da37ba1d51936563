from pyspark.sql import functions as F

from workloom.functions import extract, regions
from workloom.operators import slim
from workloom.plans.search import QUERIES


def test_snapshot_has_regions_and_descriptions(spark, data):
    texts = {r.vacancy_id: r.text for r in spark.read.parquet(f"{data}/vacancies.parquet").collect()}
    places = {r.city.lower(): r.region for r in spark.read.parquet(f"{data}/city_reference.parquet").collect()}
    finder = extract.SkillFinder(extract.DEFAULT_SKILLS)
    rows = [r for r in QUERIES["slim_snapshot"](spark, data).collect() if r.source == "hh"]
    listed = [r for r in rows if (r.city or "").lower() in places]
    assert listed and all(r.region == places[r.city.lower()] for r in listed)
    described = [r for r in rows if texts.get(r.vacancy_id)]
    assert described and all(texts[r.vacancy_id].startswith(r.description_teaser) and len(r.description_teaser) <= slim.TEASER for r in described)
    assert all(set(finder.find(texts[r.vacancy_id])) <= set(r.skills) for r in described) and any(set(r.skills) - set(finder.find(r.title)) for r in described)


def test_details_and_region_maps(spark):
    long = "слово " * 100 + "конец"
    df = spark.createDataFrame([("a", "x y", 1), ("a", long, 2), ("b", None, 1), ("c", "z" * 600, 1)], "vacancy_id string, text string, first_seen_at int")
    got = {r.vacancy_id: (r.description_teaser, r.description_fts) for r in slim.details_of(df).collect()}
    assert got == {"a": (long[: long.rfind(" ", 0, 500)], long), "c": ("z" * 500, "z" * 600)}
    cities = spark.createDataFrame([(1, "Бор", "Луговая область", ["бр"]), (2, "Ухта", "Северный край", [])], "city_id int, city string, region string, aliases array<string>")
    rows = [("г. Бор", "Луговая область"), ("БР", "Луговая область"), ("Заря (Северный край)", "Северный край"), ("Москва", "ЦФО"), ("Арск (Республика Татарстан)", "ПФО"), ("Нигде", None)]
    out = spark.createDataFrame(rows, "c string, want string").select(slim.region_of(F.col("c"), *regions.maps(cities))).collect()
    assert [r[0] for r in out] == [r[1] for r in rows]
