import json
import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from workloom.functions import extract
from workloom.operators import details, state, vectors
from workloom.schemas import DETAILS, LAKE
from workloom.sources import feeds, lake, publish


def batch(spark, *rows):
    return spark.createDataFrame([(v, "hh", t, "h", "{}") for v, t in rows], "vacancy_id string, source string, fetched_at timestamp, content_hash string, raw_json string")


def test_newest_file_answers_for_the_lake(spark, tmp_path):
    folder = str(tmp_path / "lake")
    assert not lake.newest_has(spark, folder, "raw_json")
    lake.append(batch(spark, ("a", datetime(2026, 3, 1))), folder)
    assert lake.newest_has(spark, folder, "raw_json") and not lake.newest_has(spark, folder, "market_scope")
    lake.append(batch(spark, ("a", datetime(2026, 4, 1))).withColumn("market_scope", F.lit("it")), folder)
    assert lake.newest_has(spark, folder, "market_scope")
    files = {r.vacancy_id: r.file for r in lake.scan(spark, folder, with_file=True).where("market_scope is not null").collect()}
    assert "month=04" in files["a"] and "file" in lake.scan(spark, str(tmp_path / "none"), with_file=True).columns


def test_closed_months_are_compacted_and_old_files_kept(spark, tmp_path):
    folder, trash = str(tmp_path / "lake"), str(tmp_path / "trash")
    for month, ids in ((3, "abc"), (3, "de"), (4, "f"), (4, "g"), (2, "h")):
        lake.append(batch(spark, *[(i, datetime(2026, month, 1)) for i in ids]).coalesce(1), folder)
    before = sorted(r.vacancy_id for r in lake.scan(spark, folder).collect())
    plan = lake.compaction_plan(spark, folder, "2026-04-20")
    assert [(p.rsplit("lake/", 1)[1], n) for p, n in plan] == [("year=2026/month=03/source=hh", 2)]
    assert lake.compact_partition(spark, plan[0][0], folder, trash) == 5
    assert lake.compaction_plan(spark, folder, "2026-04-20") == [] and sorted(r.vacancy_id for r in lake.scan(spark, folder).collect()) == before
    assert len([f for f in os.listdir(tmp_path / "trash/year=2026/month=03/source=hh") if f.endswith(".parquet")]) == 2
    assert {f.name for f in lake.scan(spark, folder).schema} == set(LAKE.names)


def test_snapshot_and_aggregates(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    lake.write_snapshot(df, str(tmp_path / "slim"), 1)
    lake.write_snapshot(df.union(df), str(tmp_path / "slim"), 1)
    assert spark.read.parquet(str(tmp_path / "slim")).count() == 2
    lake.write_aggregates({"one": df, "none": df.limit(0)}, str(tmp_path / "agg"))
    assert spark.read.parquet(str(tmp_path / "agg/none.parquet")).columns == ["a", "b"]
    lake.require_rows({"one": df})
    with pytest.raises(lake.Stale, match="none"):
        lake.require_rows({"one": df, "none": df.limit(0)})
    lake.require_success(0, 0)
    lake.require_success(2, 10)
    with pytest.raises(lake.Stale):
        lake.require_success(1, 1)


def test_events_by_day(spark, tmp_path):
    rows = spark.createDataFrame([("b", datetime(2026, 3, 9, 5), "seen"), ("a", datetime(2026, 3, 9, 5), "seen"), ("c", datetime(2026, 11, 12), "closed")], "event_id string, ts timestamp, type string")
    lake.write_events(rows, str(tmp_path / "e"))
    assert (tmp_path / "e/year=2026/month=03/day=09").exists() and spark.read.parquet(str(tmp_path / "e")).count() == 3


def test_vectors_merge_and_export(spark, tmp_path):
    old = spark.createDataFrame([("a", [1.0, 0.0], "x"), ("b", [0.0, 1.0], "y"), (None, [0.0, 1.0], "y")], "vacancy_id string, vector array<float>, text_hash string")
    new = spark.createDataFrame([("b", [1.0, 1.0], "z"), ("c", [2.0, 2.0], "w")], "vacancy_id string, vector array<float>, text_hash string")
    merged = lake.merge_vectors(new, old)
    assert {r.vacancy_id: r.text_hash for r in merged.collect()} == {"a": "x", "b": "z", "c": "w"}
    assert lake.export_vectors(merged, str(tmp_path / "v"), 2) == 3 and lake.export_vectors(merged.limit(0), str(tmp_path / "n"), 2) == 0
    assert spark.read.parquet(str(tmp_path / "n")).columns == ["vacancy_id", "vector"]
    with pytest.raises(ValueError, match="size 3"):
        lake.export_vectors(merged, str(tmp_path / "x"), 3)
    assert not (tmp_path / "x").exists()
    assert lake.checked_vectors(merged, "vector", 2).count() == 3


def test_encode_and_rerank(spark):
    docs = spark.createDataFrame([("a", "red green"), ("b", "red green blue"), ("c", "night shift cook"), ("n", None), (None, "red")], "k string, t string")
    got = vectors.encode(docs, "k", "t", 64, vectors.hashed_embedding(64))
    rows = {r.id: r for r in got.collect()}
    assert set(rows) == {"a", "b", "c"} and abs(np.linalg.norm(rows["a"].vector) - 1) < 1e-5 and len(rows["a"].text_hash) == 16
    hits = spark.createDataFrame([("c", 3.0), ("a", 2.9), ("b", 2.9), ("x", 1.0)], "id string, score double")
    assert [r.id for r in vectors.rerank(hits, got, "id", "vector", weight=0.9, top=3).collect()][:2] in (["a", "b"], ["b", "a"])
    assert [r.id for r in vectors.rerank(hits, got.limit(0), "id", "vector").collect()] == ["c", "a", "b", "x"]
    with pytest.raises(Exception, match="encoder gave"):
        vectors.encode(docs, "k", "t", 3, vectors.hashed_embedding(4)).collect()


def test_vectors_of_several_dimensions_meet_their_own(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [1.0, 0.0, 0.0]), (4, [0.0, 1.0, 0.0]), (5, [0.8, 0.1, 0.0])], "id bigint, v array<double>")
    got = {(r.query, r.neighbour) for r in vectors.neighbours(df, df, "id", "v", 1).collect()}
    assert got == {(1, 2), (2, 1), (3, 5), (5, 3), (4, 5)}


def test_work_list_and_details(spark):
    slim = spark.createDataFrame([("b", "hh", "unknown"), ("c", "hh", "senior"), ("d", "telegram", "unknown")], "vacancy_id string, source string, seniority string")
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("b",), (None,)], "vacancy_id string")
    assert [r[0] for r in details.work_list(wanted, slim).collect()] == ["b", "a", "c", "d"] and details.work_list(wanted, slim, 2).count() == 2
    cache = spark.createDataFrame([("c", datetime(2026, 1, 1), "old", "old", "old")], DETAILS)

    def fetch(i):
        if i == "d":
            raise OSError("blocked")
        return None if i == "a" else f'<div data-qa="vacancy-description">{"слово " * 200}</div>'

    got, failed = details.fetch_missing(wanted, cache, fetch)
    rows = {r.vacancy_id: r for r in got.collect()}
    assert set(rows) == {"a", "b", "c"} and rows["c"].description_text == "old" and rows["a"].description_text is None
    assert len(rows["b"].description_teaser) <= 500 and rows["b"].description_teaser.endswith("слово") and [r.vacancy_id for r in failed.collect()] == ["d"]
    with pytest.raises(lake.Stale):
        details.fetch_missing(wanted.where("vacancy_id = 'd'"), cache, fetch)
    assert details.cut_between_words("x" * 9, 5) == "x" * 5 and details.cut_between_words("ab cd", 4) == "ab"


def test_mirror_and_retries(spark, tmp_path):
    with pytest.raises(lake.Stale, match="slim_active"):
        publish.mirror_plan(spark, str(tmp_path))
    df = spark.createDataFrame([(1,)], "a int")
    for p in ("derived/slim_active.parquet", "derived/agg/weekly_role_salary.parquet"):
        df.write.parquet(str(tmp_path / p))
    assert [to for _, to in publish.mirror_plan(spark, str(tmp_path))] == ["slim/active.parquet", "agg"]
    calls, pauses = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise publish.Transient("later")
        return "done"

    assert publish.with_retries(flaky, 3, 2.0, pauses.append) == "done" and pauses == [2.0, 4.0]
    with pytest.raises(publish.Transient):
        publish.with_retries(lambda: (_ for _ in ()).throw(publish.Transient()), 2, 0, pauses.append)
    with pytest.raises(ValueError):
        publish.with_retries(flaky, 0)


def test_artifact_synonyms_and_scopes(spark, tmp_path):
    rows = spark.createDataFrame([("1", '{"id":"1","t":"x"}'), ("2", '{"id":"2","t":"y"}')], "id string, row string")
    lake.write_artifact(rows, str(tmp_path / "art"), 1)
    assert sorted(r.id for r in publish.load_artifact(spark, str(tmp_path / "art"), "id string, t string", 2).collect()) == ["1", "2"]
    with pytest.raises(lake.Stale):
        publish.load_artifact(spark, str(tmp_path / "art"), "id string", 3)
    assert publish.write_synonyms([("Python", ["py3", "питон"], [])], str(tmp_path / "s.json")) == 3
    assert json.loads((tmp_path / "s.json").read_text(encoding="utf-8"))["питон"] == ["py3", "python", "питон"]
    roles = feeds.roles_table(spark, [{"id": 11, "name": "IT", "roles": [{"id": "96", "name": "dev"}, {"id": "10", "name": "qa"}]}, {"id": 2, "name": "Склад", "roles": None}])
    assert publish.scope_roles(roles, category_id=11) == [10, 96] == publish.scope_roles(roles, category="IT") and publish.scope_roles(roles, ids=["5"]) == [5]
    with pytest.raises(ValueError):
        publish.scope_roles(roles, category="нет")
    channels = spark.createDataFrame([("@Jobs", "it"), ("news", "other"), (None, "it"), ("", "it")], "username string, role string")
    assert [r[0] for r in publish.scope_channels(channels, usernames=["JOBS"]).collect()] == ["@Jobs"] == [r[0] for r in publish.scope_channels(channels, roles=["it"]).collect()]


def test_pay_terms_and_event_types(spark):
    one = lambda mode: '{"compensation": {"from": 1, "to": null, "currencyCode": "RUR", "mode": "%s"}}' % mode
    rows = lambda h, j: spark.createDataFrame([("a", "1", h, j)], "vacancy_id string, employer_id string, content_hash string, raw_json string")
    (e,) = state.derive_events(rows("x", one("HOUR")), rows("y", one("MONTH")), "2026-05-01").collect()
    assert e.type == "salary_changed"
    assert state.checked_types(spark.createDataFrame([("seen",)], "type string")).count() == 1
    with pytest.raises(Exception, match="unknown type of event"):
        state.checked_types(spark.createDataFrame([("odd",)], "type string")).collect()


def test_a_missing_page_ends_its_segment(spark, tmp_path):
    for page in (0, 1, 3):
        (tmp_path / f"s-{page}.json").write_text(json.dumps({"items": [{"id": page, "n": {"a": "б"}}], "pages": 5}, ensure_ascii=False))
    (tmp_path / "e-0.json").write_text("oops")
    got = feeds.paged(spark, str(tmp_path)).collect()
    assert sorted(r.page for r in got) == [0, 1] and json.loads(got[0].item)["n"] == {"a": "б"}


def test_json_hash_without_fields(spark):
    df = spark.createDataFrame([('{"b": 1, "a": 2}',), ('{"a":2,"b":9}',), ("oops",), (None,)], "j string")
    h = [r[0] for r in df.select(extract.hash_of_json(F.col("j"), ["b"])).collect()]
    assert h[0] == h[1] and h[2] and h[3] is None and extract.canonical_json('{"b": 1, "a": 2}') == '{"a":2,"b":1}'


def test_rates_of_days(spark):
    days = spark.createDataFrame([("2026-01-01",), ("2026-01-02",), ("2026-01-02",), (None,)], "d string")
    page = "<ValCurs><Valute><CharCode>USD</CharCode><Nominal>1</Nominal><Value>92,5</Value></Valute><Valute><CharCode>BAD</CharCode><Nominal>x</Nominal><Value>1</Value></Valute></ValCurs>"
    got = feeds.rates_of_days(days, lambda day: page if day.endswith("01") else None).collect()
    assert [(str(r.date), r.char_code, r.nominal, r.value) for r in got] == [("2026-01-01", "USD", 1, 92.5)]

    def broken(day):
        raise OSError("down")

    with pytest.raises(Exception, match="down"):
        feeds.rates_of_days(days, broken).collect()


def test_crawl_splits_drains_and_goes_on(spark):
    size = {"a": 7, "b": 3, "c": 9, "d": 1, "e": 2}

    def count(s):
        if s == ("e",):
            raise OSError("count")
        return sum(size[x] for x in s)

    def drain(s):
        if "d" in s:
            raise OSError("drain")
        return [f"{x}{i}" for x in s for i in range(size[x])]

    split = lambda s: [s[: len(s) // 2], s[len(s) // 2 :]] if len(s) > 1 else []
    items, ledger = feeds.crawl(spark, [("a", "b", "c"), ("d",), ("e",)], count, split, drain, cap=8)
    assert sorted(r.item[0] for r in items.collect()) == ["a"] * 7 + ["b"] * 3
    assert ledger == {"closed": [("a",), ("b",)], "uncovered": [("c",)], "failed": [("d",), ("e",)]}
    items, again = feeds.crawl(spark, [("a",), ("b",)], count, split, drain, cap=8, closed=ledger["closed"])
    assert items.collect() == [] and again["closed"] == ledger["closed"]


def test_regions_and_lemmas(spark, tmp_path):
    from workloom.functions import regions

    (tmp_path / "r.json").write_text(json.dumps({"cities": {"Бор ": "ПФО", "x": None}, "subjects": {"Тверская": "ЦФО"}}, ensure_ascii=False), encoding="utf-8")
    assert regions.load(str(tmp_path / "r.json")) == ({"бор": "ПФО"}, {"тверская": "ЦФО"})
    df = spark.createDataFrame([(["SQL", "Go"], ["Excel", "Go"]), (["SQL"], None)], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(extract.with_lemmas(F.col("a"), F.col("b"))).collect()] == [["Excel", "Go", "SQL"], ["SQL"]]
    assert [r[0] for r in df.select(extract.with_lemmas(F.col("a"))).collect()] == [["SQL", "Go"], ["SQL"]]


def test_quotas():
    from workloom.plans.search import quota_verdict

    assert quota_verdict({"bytes": 50, "commands": 10}, {"bytes": 100, "commands": 100}) == ({"bytes": 50.0, "commands": 10.0}, True)
    assert quota_verdict({"bytes": 90}, {"bytes": 100})[1] is False


def test_search_filters_by_place_and_pages(spark):
    from workloom.plans import search

    rows = [(f"{i:04d}", "Data engineer" if i % 2 else "Cook", "text", "remote" if i % 3 else "office", "hh", "senior", "Бор", 100, None, datetime(2026, 3, 1)) for i in range(1000)]
    df = spark.createDataFrame(rows, "vacancy_id string, title string, text string, remote_type string, source string, seniority string, city string, smin int, smax int, last_seen_at timestamp")
    whole = [r.vacancy_id for r in search.search(df, "text", remote="remote").collect()]
    pages = [[r.vacancy_id for r in search.search(df, "text", remote="remote", page=p).collect()] for p in range(4)]
    assert len(whole) == 666 and sum(pages, []) == whole and [len(p) for p in pages] == [100, 400, 166, 0]


def test_messages_at_once_and_as_a_stream(spark, tmp_path):
    lines = [{"channel": "a", "message_id": 1, "date": "2026-03-01T00:00:00Z", "text": "x", "views": 2}, {"channel": "a", "message_id": 2, "text": None}, {"text": "no id"}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/m.json").write_text("\n".join(map(json.dumps, lines)) + "\nnot json\n")
    assert sorted(r.message_id for r in feeds.messages(spark, str(tmp_path / "in")).collect()) == [1, 2]
    q = feeds.messages(spark, str(tmp_path / "in"), stream=True).writeStream.format("memory").queryName("messages").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.table("messages").count() == 2


def test_the_package_is_shipped(spark):
    from workloom import runtime

    runtime.ship(spark)
    assert any(f.endswith("workloom.zip") for f in spark.sparkContext.listFiles)


def test_stages_are_released(spark):
    from workloom import runtime

    df = runtime.materialise(spark.range(3), "test")
    assert df.count() == 3 and runtime.is_kept(df) and runtime.changed_at(spark, df.stage_path) > 0
    runtime.release(df)
    assert not runtime.is_kept(df) and runtime.changed_at(spark, df.stage_path) == 0
