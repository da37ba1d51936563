from datetime import datetime

from pyspark.sql import functions as F

from workloom.operators import snapshots

LAKE = "ingest_seq bigint, vacancy_id string, source string, fetched_at timestamp, content_hash string, raw_json string, type string, _at string"


def pay(lo, hi=None, cur="RUR"):
    return '{"compensation": {"from": %s, "to": %s, "currencyCode": "%s"}}' % (lo, hi or "null", cur)


def lake(spark, rows):
    return spark.createDataFrame([(i, v, s, t and datetime.fromisoformat(t), h, j, "clash", "clash") for i, (v, s, t, h, j) in enumerate(rows)], LAKE)


def changes(spark, rows):
    got = snapshots.lake_changes(lake(spark, rows)).collect()
    return sorted((r.source, r.vacancy_id, str(r.snapshot), r.type) for r in got)


def test_kinds_of_change(spark):
    rows = [
        ("a", "hh", "2026-01-01T10:00:00", "1", pay(100)), ("b", "hh", "2026-01-01T10:00:00", "1", pay(100)), ("c", "hh", "2026-01-01T10:00:00", "1", pay(100)), ("d", "hh", "2026-01-01T10:00:00", "1", pay(100)),
        ("a", "hh", "2026-01-08T10:00:00", "2", pay(150)), ("b", "hh", "2026-01-08T10:00:00", "2", pay(100)), ("c", "hh", "2026-01-08T10:00:00", "1", pay(100)), ("e", "hh", "2026-01-08T10:00:00", "1", pay(100)),
    ]
    d = "2026-01-08"
    assert changes(spark, rows) == [("hh", "a", d, "salary_changed"), ("hh", "b", d, "desc_changed"), ("hh", "d", d, "closed"), ("hh", "e", d, "appeared")]


def test_absent_pay_differs_from_any_and_shapes_mix(spark):
    none, api = '{"salary": null}', '{"salary": {"from": 100, "to": null, "currency": "RUR"}}'
    rows = [("a", "hh", "2026-01-01T10:00:00", "1", none), ("a", "hh", "2026-01-02T10:00:00", "2", pay(100)), ("a", "hh", "2026-01-03T10:00:00", "3", api), ("a", "hh", "2026-01-04T10:00:00", "4", "not json")]
    assert [x[3] for x in changes(spark, rows)] == ["salary_changed", "desc_changed", "salary_changed"]


def test_the_latest_fetch_counts_then_the_highest_sequence(spark):
    rows = [
        ("a", "hh", "2026-01-01T10:00:00", "1", None), ("a", "hh", "2026-01-02T12:00:00", "1", None), ("a", "hh", "2026-01-02T10:00:00", "9", None),
        ("b", "hh", "2026-01-01T10:00:00", "1", None), ("b", "hh", "2026-01-02T10:00:00", "5", None), ("b", "hh", "2026-01-02T10:00:00", "1", None),
    ]
    assert changes(spark, rows) == []


def test_sources_have_their_own_snapshots_and_late_rows_count(spark):
    rows = [("a", "telegram", "2026-01-01T10:00:00", "1", "{}"), ("x", "hh", "2026-01-02T10:00:00", "1", "{}"), ("a", "telegram", "2026-01-15T10:00:00", "2", "{}"), ("a", "telegram", "2026-01-08T10:00:00", "1", "{}")]
    assert changes(spark, rows) == [("telegram", "a", "2026-01-15", "desc_changed")]


def test_nulls_repeats_and_empty(spark):
    row = ("a", "hh", "2026-01-01T10:00:00", None, None)
    rows = [row, row, ("a", "hh", "2026-01-02T10:00:00", None, None), (None, "hh", "2026-01-02T10:00:00", "1", None), ("z", None, "2026-01-02T10:00:00", "1", None), ("q", "hh", None, "1", None)]
    assert changes(spark, rows) == []
    assert changes(spark, rows + [("a", "hh", "2026-01-03T10:00:00", "1", "x" * 200_000)]) == [("hh", "a", "2026-01-03", "desc_changed")]
    assert changes(spark, []) == []


def test_latest_per_key_breaks_ties_alike(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 1, "y"), (None, 2, "z")], "k string, o int, v string")
    a = snapshots.latest_per_key(df, ["k"], ["o"]).collect()
    b = snapshots.latest_per_key(df.orderBy(F.desc("v")).repartition(3), ["k"], ["o"]).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == 2


def test_row_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([("", "a"), (None, "a"), ("a", "")], "x string, y string")
    assert len({r[0] for r in df.select(snapshots.row_hash(["x", "y"])).collect()}) == 3


def test_plan_reads_needed_columns_only(spark, data):
    from workloom.runtime import table

    plan = snapshots.lake_changes(table(spark, data, "raw_lake"))._jdf.queryExecution().executedPlan().toString()
    assert "posted_at" not in plan and "market_scope" not in plan
