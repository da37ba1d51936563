from datetime import date
from fractions import Fraction

import pytest

from workloom.operators import units

PARSES = "parse_id bigint, vacancy_id string, source string, posted_on date, salary_text string, currency string, `min` bigint, `max` bigint, disclosed boolean, code string, day date"
PERIODS = [("month", 1, 1), ("year", 1, 12), ("week", 13, 3), ("shift", 15, 1), ("hour", 164, 1)]
RATES = [(date(2026, 1, 1), "USD", 1, 90.1234), (date(2026, 1, 10), "usd", 1, 80.0), (date(2026, 1, 1), "KZT", 100, 17.0), (date(2026, 1, 1), "KZT", 100, 17.0), (date(2026, 1, 2), "EUR", 0, 5.0), (None, "EUR", 1, 5.0)]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(RATES, "date date, char_code string, nominal int, value double"), spark.createDataFrame(PERIODS, "period string, per_month_num int, per_month_den int")


def convert(spark, tables, rows, **kw):
    df = spark.createDataFrame([(i, f"v{i}", "hh", date(2026, 1, 5), t, c, lo, hi, True, "clash", None) for i, (t, c, lo, hi) in enumerate(rows)], PARSES)
    got = {r.parse_id: r for r in units.monthly_roubles(df, *tables, **kw).collect()}
    return [(got[i].rub_min, got[i].rub_max, got[i].review) if i in got else None for i in range(len(rows))]


def test_scales_periods_and_currencies(spark, tables):
    rows = [
        ("от 200 до 300 тыс. руб.", None, 200, 300), ("от 200 до 300 тыс. руб.", None, 200_000, 300_000), ("1 400 000 - 1'500'000 в год", "RUR", 1_400_000, 1_500_000), ("15-19 млн. KZT годовых", "тг", 15, 19),
        ("22 dollars/час", "USD", 22, None), (None, "бел. руб.", 100, None), ("до 64 т.р. gross", None, None, 64), ("9500 - 14 200 рублей per shift", "RUR", 9500, 14200), ("competitive", None, None, None), ("210 000 per week", "RUB", 210_000, None),
    ]
    usd = Fraction("90.1234")
    half_up = lambda x: int(x + Fraction(1, 2))
    kzt = Fraction(17, 100)
    assert convert(spark, tables, rows) == [
        (200_000, 300_000, None), (200_000, 300_000, None), (half_up(Fraction(1_400_000, 12)), 125_000, None), (half_up(15_000_000 * kzt / 12), half_up(19_000_000 * kzt / 12), None),
        (half_up(22 * usd * 164), None, None), (None, None, "rate"), (None, 64_000, None), (142_500, 213_000, None), None, (910_000, None, None),
    ]


def test_latest_earlier_rate_and_half_up(spark):
    rates = spark.createDataFrame([(date(2026, 1, 1), "USD", 1, 0.5), (date(2026, 1, 6), "USD", 1, 9.0)], "date date, char_code string, nominal int, value double")
    periods = spark.createDataFrame(PERIODS, "period string, per_month_num int, per_month_den int")
    assert convert(spark, (rates, periods), [("3 $", None, 3, 5)]) == [(2, 3, None)]


def test_empty_and_long(spark, tables):
    assert convert(spark, tables, []) == []
    assert convert(spark, tables, [("руб. " + "слово " * 50_000, None, 5, None)]) == [(5, None, None)]


def test_without_conventions_the_ensemble_decides_or_sends_to_review(spark, tables):
    rows = [("%d тыс. руб. в месяц" % n, None, n, None) for n in range(60, 260)] + [("%d руб. в час" % n, None, n, None) for n in range(300, 500)] + [(None, "RUR", 150_000, None)]
    got = convert(spark, tables, rows, conventions=False)
    assert got[0] == (60_000, None, None) and got[200] == (300 * 164, None, None)
    assert got[-1][2] in (None, "period", "scale")


def test_against_fractions_on_the_tables(spark, data):
    import duckdb

    from workloom.plans.general import p3_found

    got = {r.parse_id: (r.rub_min, r.rub_max) for r in p3_found(spark, data).collect()}
    rows = duckdb.sql(f"select distinct parse_id, min, max from '{data}/salary_parses.parquet' where min is not null or max is not null").fetchall()
    assert {r[0] for r in rows} == set(got)
    assert all((lo is None) == (got[i][0] == -1) and (hi is None) == (got[i][1] == -1) for i, lo, hi in rows)


def test_the_ensemble_alone_decides_most_missing_units_and_rarely_errs(spark):
    import os

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    parses, rates, periods = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("salary_parses", "cbr_rates", "pay_periods"))
    rows, days = units.with_units(parses, rates)
    alone = {r.parse_id: r for r in units.settled(rows, days, periods, conventions=False).collect()}
    whole = {r.parse_id: r for r in units.settled(rows, days, periods, conventions=True).collect()}
    used = [i for i, r in alone.items() if r.review is None]
    assert len(used) >= 0.9 * len(whole) and sum((alone[i].rub_min, alone[i].rub_max) == (whole[i].rub_min, whole[i].rub_max) for i in used) >= 0.995 * len(used)
    missing = [r for r in whole.values() if r.period_from != "stated" or r.scale_from != "stated"]
    assert sum("review" not in (r.period_from, r.scale_from) for r in missing) >= 0.75 * len(missing)


def test_a_missing_currency_is_predicted_or_goes_to_review(spark, tables):
    rows = [("%d в месяц" % n, "RUR", n, None) for n in range(90_000, 90_200)] + [("%d в месяц" % n, "USD", n, None) for n in range(2_000, 2_200)] + [("90050 в месяц", None, 90_050, None), ("2050 в месяц", None, 2_050, None)]
    got = convert(spark, tables, rows)
    assert got[-2] in [(90_050, None, None), (None, None, "currency")] and got[-1][2] in (None, "currency")


def test_with_too_few_labels_rows_go_to_review_and_the_rules_settle_them(spark, tables):
    rows = [("100 000 руб.", None, 100_000, None), (None, "RUR", 70_000, None)]
    assert convert(spark, tables, rows) == [(100_000, None, None), (70_000, None, None)]
    assert {g[2] for g in convert(spark, tables, rows, conventions=False)} == {"period"}
