import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from workloom.functions import extract, rules
from workloom.operators import slim


@pytest.mark.parametrize(
    "text,expected",
    [
        ("ЗП: 250 000 ₽", (250_000, None, "RUR", True)), ("от 200к до 300к", (200_000, 300_000, "RUR", True)), ("200-300к", (200_000, 300_000, "RUR", True)), ("$3000-5000", (3000, 5000, "USD", True)),
        ("до 500к", (None, 500_000, "RUR", True)), ("300 000 — 450 000 ₽", (300_000, 450_000, "RUR", True)), ("хорошая зарплата", (None, None, None, False)), ("1200 руб/час", (None, None, "RUR", False)),
        ("60k usd/year", (5000, None, "USD", True)), ("", (None, None, None, False)), (None, (None, None, None, False)), ("https://x.y/200-300k", (None, None, None, False)), ("x" * 100_000, (None, None, None, False)),
    ],
)
def test_pay(text, expected):
    assert extract.parse_pay(text) == expected


@given(st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_pay_is_ordered_and_disclosed_only_with_an_amount(text):
    lo, hi, _, disclosed = extract.parse_pay(text)
    assert disclosed == (lo is not None or hi is not None)
    assert lo is None or hi is None or lo <= hi


def test_years_need_a_word_about_experience():
    assert extract.experience_years("опыт работы от 5 лет, 3+ года с SQL") == 5
    assert extract.experience_years("Более 20 лет на рынке") is None
    assert extract.experience_years("опыт от 25 лет") is None
    assert extract.experience_years(None) is None


def test_skills():
    find = extract.SkillFinder([("R", ["r", "r-lang"], ["&", "/3"]), ("C++", ["c++"], []), ("SQL", [], []), ("PostgreSQL", ["postgres"], []), ("Go", ["go"], [])]).find
    assert find("R&D and R /3; c++, SQL. google PostgreSQL") == ["C++", "PostgreSQL", "SQL"]
    assert find("язык R, *r*ust, Go") == ["Go", "R"]
    assert find("https://go.dev") == [] and find(None) == [] and extract.SkillFinder([]).find("x") == []


def test_synonyms_merge_shared_names():
    got = extract.synonyms([("Python", ["py", "питон"], []), ("Питон", ["питон"], [])])
    assert got["питон"] == ["python", "питон"] and "py" not in got


def test_pages():
    assert extract.page_text("<p>a<b>b</b> &amp; c</p>") == "a b & c"
    page = '<div>x<div data-qa="vacancy-description">y<div>z<br></div>w</div>q</div>'
    assert extract.page_text(page, ("data-qa", "vacancy-description")) == "y z w"
    assert extract.page_text("<div>x</div>", ("data-qa", "vacancy-description")) is None and extract.page_text(None) is None


def test_rules(spark):
    rows = [("Дата Аналитик", "data_analyst"), ("Senior Backend Developer", "backend_engineer"), ("Продавец", "other"), (None, "other"), ("", "other")]
    df = spark.createDataFrame(rows, "t string, want string")
    assert all(r.want == r.got for r in df.select("want", rules.role(F.col("t")).alias("got")).collect())
    rows = [("Ведущий специалист", None, "middle"), ("Ведущий разработчик", None, "lead"), ("Аналитик", "руководитель ищет", None), ("Аналитик", "нужен senior", "senior"), ("Principal Architect", None, "principal"), ("Staff member", None, None), ("младший юрист", None, "junior"), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, b string, want string")
    assert [r.got for r in df.select(rules.stated_level(F.col("t"), F.col("b")).alias("got")).collect()] == [r[2] for r in rows]
    rows = [("гибрид или офис", "hybrid"), ("удалённо", "remote"), ("офис у реки", "office"), ("офисный", "unknown"), ("", "unknown")]
    assert [r[0] for r in spark.createDataFrame(rows, "t string, w string").select(rules.workplace(F.col("t"))).collect()] == [r[1] for r in rows]
    assert spark.createDataFrame([("спб, центр",)], "t string").select(rules.city(F.col("t"))).first()[0] == "Санкт-Петербург"


def test_regions(spark):
    by_city, by_subject = {"москва": "ЦФО", "киров": "ПФО"}, {"тверская": "ЦФО", "татарстан": "ПФО"}
    rows = [("Москва", "ЦФО"), ("город Москва", "ЦФО"), ("Киров (Калужская область)", "ПФО"), ("Бор (Тверская область)", "ЦФО"), ("Арск (Республика Татарстан)", "ПФО"), ("Нигде", None), (None, None), ("", None)]
    df = spark.createDataFrame(rows, "c string, want string")
    assert [r[0] for r in df.select(slim.region_of(F.col("c"), by_city, by_subject)).collect()] == [r[1] for r in rows]


def test_clean_title(spark):
    rows = [("🔥 **Разработчик** [ссылка](http://x.y)", "Разработчик ссылка"), ("— Аналитик: ", "Аналитик"), (None, ""), ("https://a.b", "")]
    df = spark.createDataFrame(rows, "t string, w string")
    assert [r[0] for r in df.select(slim.clean_title(F.col("t"))).collect()] == [r[1] for r in rows]


def test_slim_of_both_shapes_and_chat(spark):
    from datetime import date, datetime

    t = datetime(2026, 4, 27, 10)
    web = '{"vacancyId": 1, "name": "Senior Python Developer", "company": {"name": "A", "visibleName": "ACME"}, "compensation": {"from": 1000, "to": 3000000, "currencyCode": "USD"}, "area": {"name": "Москва"}, "workFormats": [{"workFormatsElement": ["REMOTE"]}]}'
    api = '{"id": "2", "name": "Аналитик", "employer": {"name": "B"}, "salary": {"from": 5000, "to": null, "currency": "RUR"}, "area": {"name": "Тверь"}, "schedule": {"id": "fullDay"}, "experience": {"id": "between1And3"}}'
    chat = '{"channel": "jobs", "message_id": 7, "text": "\\nData Engineer\\nМосква, удалённо\\n$5000\\nSQL, Spark"}'
    rows = [(1, "hh:1", "hh", t, None, "9", web, "it", 96), (2, "hh:2", "hh", t, None, None, api, None, None), (3, "tg:jobs:7", "telegram", t, None, None, chat, None, None), (4, "hh:4", "hh", t, None, None, "oops", None, None)]
    lake = spark.createDataFrame(rows, "ingest_seq bigint, vacancy_id string, source string, fetched_at timestamp, posted_at timestamp, employer_id string, raw_json string, market_scope string, professional_role_id bigint")
    rates = spark.createDataFrame([(date(2026, 4, 1), "USD", 1, 80.5)], "date date, char_code string, nominal int, value double")
    got = {r.vacancy_id: r for r in slim.build(lake, rates).collect()}
    a, b, c, d = (got[k] for k in ("hh:1", "hh:2", "tg:jobs:7", "hh:4"))
    assert (a.salary_rub_min, a.salary_rub_max, a.salary_disclosed, a.remote_type, a.seniority, a.employer_id, a.employer_name) == (80_500, None, True, "remote", "senior", "hh:9", "ACME")
    assert (b.salary_rub_min, b.salary_disclosed, b.remote_type, b.seniority, b.city) == (None, False, "office", "middle", "Тверь")
    assert (c.title, c.salary_rub_min, c.city, c.remote_type, c.skills, c.employer_id, c.source_url) == ("Data Engineer", 402_500, "Москва", "remote", ["SQL", "Spark"], None, "https://t.me/jobs/7")
    assert (d.title, d.seniority, d.skills) == ("", "unknown", [])
    assert slim.build(lake.limit(0), rates).collect() == []
