import json
from datetime import datetime

from pyspark.sql import functions as F

from workloom.schemas import LAKE
from workloom.sources import records

NOW = datetime(2026, 4, 1, 12)


def items(spark, *rows):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False), "clash") for r in rows], "item string, vacancy_id string")


def build(spark, *rows):
    return [r for r in records.board_records(items(spark, *rows), "item", F.lit(NOW), "it").collect()]


def test_times(spark):
    rows = [("2026-03-01T10:00:00+0300", datetime(2026, 3, 1, 7)), ("2026-03-01T10:00:00+03:00", datetime(2026, 3, 1, 7)), ("2026-03-01T10:00:00Z", datetime(2026, 3, 1, 10)), ("2026-03-01", datetime(2026, 3, 1)), ("2026-03-01 10:00", datetime(2026, 3, 1, 10)), ("2026-03-01T10:00:00.123+00:00", datetime(2026, 3, 1, 10, 0, 0, 123000)), ("yesterday", None), ("2026-13-45T00:00:00", None), ("", None), (None, None)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string, w timestamp").select(F.to_utc_timestamp(records.iso_timestamp(F.col("t")), F.current_timezone())).collect()]
    assert got == [w for _, w in rows]


ROLES = [
        ({"professional_roles": [{"id": "96", "name": "x"}]}, 96), ({"professionalRoles": ["x", {"id": 10}]}, 10), ({"professionalRoleIds": [[{"@id": "7"}]]}, 7), ({"professional_role": {"professionalRoleId": 5}}, 5), ({"professionalRole": {"id": 0, "professional_role_id": "8"}}, 8),
        ({"professional_role_id": "12"}, 12), ({"professionalRoleId": 13}, 13), ({"professional_roles": [], "professionalRoleId": 4}, 4), ({"professional_roles": None, "professionalRoleIds": [{"professionalRoleId": [3]}]}, 3), ({"professionalRoleId": "x"}, None), ({}, None),
    ]


def test_role_ids(spark):
    got = items(spark, *[p for p, _ in ROLES]).select(records.role_id(F.col("item"))).collect()
    assert [r[0] for r in got] == [w for _, w in ROLES]


def test_board_items_of_both_shapes(spark):
    search = {"vacancyId": 5, "name": "Повар", "company": {"id": 77}, "publicationTime": {"@timestamp": 1, "$": "2026-03-01T10:00:00+03:00"}, "responsesCount": 3, "professionalRoleIds": [{"professionalRoleId": [96]}]}
    api = {"id": "6", "published_at": "2026-03-02T00:00:00+0300", "employer": {"id": None}, "professional_roles": [{"id": "11"}]}
    a, b, c, d = build(spark, search, {**search, "responsesCount": 9}, {**search, "name": "Кок"}, api, "not json", {"name": "no id"})
    assert [f.name for f in LAKE.fields] == list(a.asDict())
    assert (a.vacancy_id, a.source, a.employer_id, a.market_scope, a.professional_role_id, a.fetched_at) == ("hh:5", "hh", "77", "it", 96, NOW)
    assert a.content_hash == b.content_hash != c.content_hash and len(a.content_hash) == 16 and json.loads(a.raw_json) == search
    assert (d.vacancy_id, d.employer_id, d.professional_role_id, d.posted_at is not None) == ("hh:6", None, 11, True)


def test_plain_times_and_nothing(spark):
    (r,) = build(spark, {"vacancyId": "9", "creationTime": "2026-03-01T00:00:00Z"})
    assert r.posted_at is not None and r.professional_role_id is None and r.employer_id is None
    assert records.board_records(items(spark, {"id": 1}).limit(0), "item", F.lit(NOW)).collect() == []


def test_chat_records_and_last_messages(spark):
    rows = [("jobs", 1, NOW, "first", 5, "x"), ("jobs", 2, NOW, " ", None, "x"), ("jobs", 3, NOW, "third", None, "x"), ("jobs", 3, NOW, "third", None, "x"), ("jobs", 4, NOW, "Четвёртое", 1, "x"), ("news", 1, NOW, None, 1, "x"), (None, 1, NOW, "t", 1, "x")]
    df = spark.createDataFrame(rows, "channel string, message_id int, date timestamp, text string, views int, source string")
    last = records.last_messages(df, 2)
    assert sorted((r.channel, r.message_id) for r in last.collect()) == [("jobs", 3), ("jobs", 4)]
    got = {r.vacancy_id: r for r in records.chat_records(last, F.lit(NOW)).collect()}
    assert set(got) == {"tg:jobs:3", "tg:jobs:4"} and got["tg:jobs:4"].source == "telegram" and got["tg:jobs:4"].posted_at == NOW
    assert json.loads(got["tg:jobs:4"].raw_json)["text"] == "Четвёртое" and got["tg:jobs:3"].content_hash != got["tg:jobs:4"].content_hash


def test_ids(spark):
    df = spark.createDataFrame([("hh:12",), ("tg:a:3",), ("12",), (None,)], "v string")
    assert [tuple(r) for r in df.select(records.source_of(F.col("v")), records.bare_id(F.col("v"))).collect()] == [("hh", "12"), ("telegram", None), (None, None), (None, None)]
