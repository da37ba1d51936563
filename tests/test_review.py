from workloom.plans.general import QUERIES


def test_review_has_one_row_for_each_record(spark, data):
    cases = {r[0] for r in spark.read.parquet(f"{data}/salary_parses.parquet").where("min is not null or max is not null").select("parse_id").collect()}
    rows = QUERIES["p3_review"](spark, data).collect()
    assert sorted(r.parse_id for r in rows) == sorted(cases)
    found = {r.parse_id for r in QUERIES["p3_found"](spark, data).select("parse_id").collect()}
    assert {r.parse_id for r in rows if r.outcome == "converted"} == found
