from datetime import datetime

import pytest
from pyspark.sql import functions as F

from workloom.operators import dedup, state, vectors
from workloom.sources import feeds, lake
from workloom.streaming import live


def snap(spark, rows):
    return spark.createDataFrame(rows, "vacancy_id string, employer_id string, content_hash string, raw_json string")


def pay(lo):
    return '{"compensation": {"from": %d, "to": null, "currencyCode": "RUR"}}' % lo


def test_derived_events(spark):
    prev = snap(spark, [("a", "1", "x", pay(100)), ("b", "1", "x", pay(100)), ("c", None, "x", None), ("d", "1", "x", pay(1)), (None, "1", "x", None)])
    curr = snap(spark, [("a", "1", "y", pay(150)), ("b", "1", "y", pay(100)), ("d", "1", "x", pay(1)), ("e", "2", "z", None)])
    got = {r.vacancy_id: r for r in state.derive_events(prev, curr, "2026-05-01").collect()}
    assert {k: r.type for k, r in got.items()} == {"a": "salary_changed", "b": "desc_changed", "c": "closed", "e": "appeared"}
    assert got["a"].payload == '{"new":{"currency":"RUR","from":150,"to":null},"old":{"currency":"RUR","from":100,"to":null}}' and got["b"].payload is None
    assert {r.type for r in state.derive_events(prev, curr, "2026-05-01", complete=False).collect()} == {"salary_changed", "desc_changed", "appeared"}
    assert state.append_new(state.derive_events(prev, curr, "2026-05-01"), state.derive_events(prev, curr, "2026-05-01")).count() == 0
    assert state.derive_events(prev.limit(0), curr.limit(0), "2026-05-01").collect() == []


def test_upsert_and_retention(spark):
    a = spark.createDataFrame([("k", 1, "old"), ("m", 1, "old")], "k string, t int, v string")
    b = spark.createDataFrame([("k", 1, "new"), ("n", 0, "new")], "k string, t int, v string")
    assert sorted(tuple(r) for r in state.upsert(a, b, ["k"], ["t"]).collect()) == [("k", 1, "new"), ("m", 1, "old"), ("n", 0, "new")]
    log = spark.createDataFrame([(datetime(2026, 4, d), "seen", "p") for d in range(1, 11)], "ts timestamp, type string, payload string")
    assert state.retained(log, "2026-04-10", 3).count() == 4 and state.last_days(log, "2026-04-10", 2).count() == 3
    assert state.without_payload(log, "seen").where("payload is not null").count() == 0
    with pytest.raises(ValueError):
        state.retained(log, "2026-04-10", 0)


def test_lake_round_trip_and_gates(spark, tmp_path):
    folder = str(tmp_path / "lake")
    assert lake.scan(spark, folder).count() == 0
    rows = spark.createDataFrame([("hh:1", "hh", datetime(2026, 3, 1, 5), "h", "{}"), ("tg:a:1", "telegram", datetime(2026, 3, 1, 5), "h", "{}")], "vacancy_id string, source string, fetched_at timestamp, content_hash string, raw_json string")
    lake.append(rows, folder)
    assert (tmp_path / "lake" / "year=2026" / "month=03" / "source=hh").exists()
    got = lake.scan(spark, folder, "hh")
    assert [(r.vacancy_id, r.market_scope) for r in got.collect()] == [("hh:1", None)]
    assert "PartitionFilters: [isnotnull(source" in got._jdf.queryExecution().executedPlan().toString()
    assert state.compact(spark, folder, str(tmp_path / "small")) == 2
    with pytest.raises(ValueError):
        lake.append(rows.limit(0), folder)
    with pytest.raises(lake.Stale):
        lake.require_fresh(got, "fetched_at", datetime(2026, 3, 2))
    with pytest.raises(lake.Stale):
        lake.write_artifact(spark.createDataFrame([("a", "{}")], "id string, row string"), str(tmp_path / "art"), 2)
    assert lake.write_artifact(spark.createDataFrame([("a", "{}")], "id string, row string"), str(tmp_path / "art"), 1) == 1


def test_rates_xml(spark, tmp_path):
    p = tmp_path / "r.xml"
    p.write_text("<ValCurs><Valute><CharCode>USD</CharCode><Nominal>1</Nominal><Value>92,5000</Value></Valute><Valute><CharCode>CNY</CharCode><Nominal>10</Nominal><Value>127,5</Value></Valute><Valute><CharCode>BAD</CharCode><Nominal>x</Nominal><Value>1</Value></Valute></ValCurs>")
    assert sorted((r.char_code, r.nominal, r.value) for r in feeds.rates_xml(spark, str(p), "2026-01-01").collect()) == [("CNY", 10, 127.5), ("USD", 1, 92.5)]


def test_paged_json(spark, tmp_path):
    for seg, pages in (("a", 2), ("b", 1)):
        for p in range(pages):
            (tmp_path / f"{seg}-{p}.json").write_text('{"vacancySearchResult": {"vacancies": [{"id": "%s%d"}], "paging": {"lastPage": {"page": %d}}}}' % (seg, p, pages - 1))
    got = feeds.paged(spark, str(tmp_path))
    assert sorted((r.segment, r.page) for r in got.collect()) == [("a", 0), ("a", 1), ("b", 0)]
    assert feeds.paged(spark, str(tmp_path), 1).count() == 2


def test_segments_and_trees():
    size = {"a": 6, "b": 3, "c": 1, "d": 1}
    assert feeds.split_segments(lambda p: sum(size[x] for x in p), list("abcd"), 4) == [["a"], ["b"], ["c", "d"]]
    assert [x["id"] for x in feeds.children_of([{"id": "1", "areas": [{"id": "113", "areas": [{"id": "2"}]}]}], "113")] == ["2"]


def test_neighbours_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    m = rng.normal(size=(60, 8))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(m)] + [(99, None, 0), (98, [0.0] * 8, 0), (None, [1.0] * 8, 0)], "id bigint, v array<double>, rank int")
    got = {}
    for r in vectors.neighbours(df.where("id % 20 = 0"), df, "id", "v", 3).orderBy("query", "rank").collect():
        got.setdefault(r.query, []).append(r.neighbour)
    u = m / np.linalg.norm(m, axis=1)[:, None]
    for q in (0, 20, 40):
        s = u @ u[q]
        s[q] = -9
        assert got[q] == np.argsort(-s)[:3].tolist()
    assert vectors.neighbours(df.limit(0), df, "id", "v", 3).collect() == []


def test_minhash_recall(spark):
    import random

    rnd = random.Random(3)
    docs = []
    for i in range(40):
        w = [f"w{rnd.randrange(500)}" for _ in range(80)]
        docs.append((f"{i:02d}a", " ".join(w)))
        w[rnd.randrange(80)] = "x"
        docs.append((f"{i:02d}b", " ".join(w)))
    df = spark.createDataFrame(docs + [("n", None), (None, "a b c d")], "id string, t string")
    reps, members = dedup.contents(df, "id", F.col("t"))
    exact = {(r.a, r.b) for r in dedup.alike(reps).collect()}
    close = {(r.a, r.b) for r in dedup.verified(dedup.minhash_candidates(reps), reps, dedup.SAME).collect()}
    assert len(exact) == 40 and close <= exact and len(close) >= 0.9 * len(exact)
    assert members.count() == 80


def events(spark):
    rows = [("1", datetime(2026, 3, 2, 1), "appeared"), ("1", datetime(2026, 3, 2, 1), "appeared"), ("2", datetime(2026, 3, 8, 23), "closed"), ("3", datetime(2026, 3, 9, 0), "appeared")]
    return spark.createDataFrame(rows, "event_id string, ts timestamp, type string")


def drain(query):
    q = query.start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_streaming_counts_match_batch(spark, tmp_path):
    events(spark).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id string, ts timestamp, type string").parquet(str(tmp_path / "in"))
    drain(live.weekly_counts(stream).writeStream.format("memory").queryName("weekly").outputMode("complete").option("checkpointLocation", str(tmp_path / "c1")))
    assert sorted((str(r.week_start), r.type, r.n) for r in spark.table("weekly").collect()) == [("2026-03-02", "appeared", 1), ("2026-03-02", "closed", 1), ("2026-03-09", "appeared", 1)]


def lake_rows(spark, rows):
    return spark.createDataFrame([(i, v, "e", h, j, datetime(2026, 3, d)) for i, (v, h, j, d) in enumerate(rows)], "ingest_seq bigint, vacancy_id string, employer_id string, content_hash string, raw_json string, fetched_at timestamp")


def test_streaming_changes(spark, tmp_path):
    first, second = [("a", "1", pay(1), 1), ("b", "1", pay(1), 1)], [("a", "2", pay(2), 8), ("b", "2", pay(1), 8), ("a", "0", pay(9), 5), ("c", "1", None, 8)]
    schema = lake_rows(spark, first).schema
    lake_rows(spark, first).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for rows in (None, second):
        if rows:
            lake_rows(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        drain(live.changes(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", cp))
    got = sorted((r.vacancy_id, r.ts.day, r.type) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1, "appeared"), ("a", 5, "salary_changed"), ("a", 8, "salary_changed"), ("b", 1, "appeared"), ("b", 8, "desc_changed"), ("c", 8, "appeared")]


def test_sweeps_by_batch_are_idempotent(spark, tmp_path):
    write = live.sweep_writer(str(tmp_path / "state"), str(tmp_path / "events"))
    write(lake_rows(spark, [("a", "1", pay(1), 1)]), 0)
    for _ in range(2):
        write(lake_rows(spark, [("a", "2", pay(2), 8), ("b", "1", None, 8)]), 1)
    got = sorted((r.vacancy_id, r.type) for r in spark.read.parquet(str(tmp_path / "events")).collect())
    assert got == [("a", "appeared"), ("a", "salary_changed"), ("b", "appeared")]


def test_the_first_batch_run_again_adds_nothing_and_late_records_change_nothing(spark, tmp_path):
    write = live.sweep_writer(str(tmp_path / "state"), str(tmp_path / "events"))
    for _ in range(2):
        write(lake_rows(spark, [("a", "1", pay(1), 5), ("b", "1", None, 5)]), 0)
    write(lake_rows(spark, [("a", "0", pay(9), 3), ("b", "2", None, 6)]), 1)
    got = sorted((r.vacancy_id, r.ts.day, r.type) for r in spark.read.parquet(str(tmp_path / "events")).collect())
    assert got == [("a", 5, "appeared"), ("b", 5, "appeared"), ("b", 6, "desc_changed")]
    assert {r.vacancy_id: r.content_hash for r in spark.read.parquet(str(tmp_path / "state" / "1")).collect()} == {"a": "1", "b": "2"}


def test_complete_sweeps_close_what_they_lack_and_partial_ones_do_not(spark, tmp_path):
    for complete in (True, False):
        write = live.sweep_writer(str(tmp_path / f"s{complete}"), str(tmp_path / f"e{complete}"), complete=complete)
        write(lake_rows(spark, [("a", "1", None, 1), ("b", "1", None, 1)]), 0)
        write(lake_rows(spark, []), 1)
        for _ in range(2):
            write(lake_rows(spark, [("a", "1", None, 8)]), 2)
        write(lake_rows(spark, [("a", "1", None, 9), ("b", "1", None, 9)]), 3)
        got = sorted((r.vacancy_id, r.ts.day, r.type) for r in spark.read.parquet(str(tmp_path / f"e{complete}")).collect())
        assert got == ([("a", 1, "appeared"), ("b", 1, "appeared"), ("b", 8, "closed"), ("b", 9, "appeared")] if complete else [("a", 1, "appeared"), ("b", 1, "appeared")])


def test_daily_counts_drop_second_deliveries(spark, tmp_path):
    events(spark).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id string, ts timestamp, type string").parquet(str(tmp_path / "in"))
    drain(live.daily_counts(stream).writeStream.format("memory").queryName("daily").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")))
    assert sorted((r.start.day, r.type, r.n) for r in spark.table("daily").collect()) == [(2, "appeared", 1), (8, "closed", 1), (9, "appeared", 1)]


def test_large_buckets_are_dealt_with_the_same_result(spark, monkeypatch):
    import random

    rnd = random.Random(4)
    base = [f"w{rnd.randrange(900)}" for _ in range(90)]
    docs = []
    for i in range(40):
        w = list(base)
        w[rnd.randrange(90)] = f"x{i}"
        docs.append((f"{i:02d}", "hh" if i % 2 else "telegram", " ".join(w)))
    df = spark.createDataFrame(docs + [("c1", "hh", docs[0][2]), ("c2", "telegram", docs[0][2]), ("n", None, docs[0][2])], "id string, source string, t string")
    reps, _ = dedup.contents(df, "id", F.col("t"))
    pairs = lambda c: {(r.a, r.b) for r in dedup.verified(c, reps, dedup.SAME).collect()}
    lsh, exact = pairs(dedup.minhash_candidates(reps)), {(r.a, r.b) for r in dedup.alike(reps).collect()}
    monkeypatch.setattr(dedup, "POSTINGS", 3)
    assert pairs(dedup.minhash_candidates(reps)) == lsh and {(r.a, r.b) for r in dedup.alike(reps).collect()} == exact and lsh and exact
    across = {(r.id_a, r.id_b): r.jaccard for r in dedup.cross_source_pairs(df, "id", "source", F.col("t")).collect()}
    assert across["c1", "c2"] == 1.0 and ("00", "c1") in across and ("00", "c2") not in across and not any("n" in p for p in across)


def test_rows_repeated_whole_count_once(spark, tmp_path):
    from workloom.plans.views import adverts

    rows = [("a", "x", None), ("a", "x", None), ("a", None, "x"), ("b", None, None), ("b", None, None)]
    df = spark.createDataFrame(rows, "vacancy_id string, title string, text string")
    df.repartition(3).write.parquet(str(tmp_path / "vacancies.parquet"))
    got = adverts(spark, str(tmp_path))
    assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted({str(r) for r in df.collect()})
